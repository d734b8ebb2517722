"""End-to-end runs of the job functions on small inputs."""

from strata.operators.audit import audit_columns
from strata.plans import fixtures as FX
from strata.plans import jobs as J
from strata.sinks.files import write_csv_pipe, write_refined
from strata.sources import catalog as CAT
from strata.sources.files import scan_csv_pipe

SF = "/root/testdata/sf0.001"


def test_customer_tables_job_prunes_and_audits(spark, tmp_path):
    refined = tmp_path / "refined"
    dem, base = str(refined / "fig_t_demographic"), str(refined / "fig_t_baseid")
    # two loads: one inside the selected window, one outside it
    for as_of in ("2020-03-10 00:00:00", "2021-03-10 00:00:00"):
        write_refined(audit_columns(FX.fx_demographic(spark, SF), "u", "p", "s", as_of), dem)
        write_refined(audit_columns(FX.fx_baseid(spark, SF), "u", "p", "s", as_of), base)
    match = str(tmp_path / "match")
    FX.fx_match(spark, SF).write.option("header", True).csv(match)
    out = J.customer_tables(spark, dem, base, match, str(tmp_path / "customer"), "u", "cust_job", "db",
                            year=2020, month_from=1, month_to=12, day_from=1, day_to=31,
                            as_of="2024-06-01 00:00:00")
    assert sorted(out) == ["customer", "customer_address", "customer_email", "customer_name",
                           "customer_phone", "fig_baseid_x_customer"]
    cust = spark.read.parquet(out["customer"])
    assert {r.create_process for r in cust.select("create_process").distinct().collect()} == {"cust_job"}
    assert [tuple(r) for r in cust.select("create_year", "create_month", "create_date").distinct().collect()] \
        == [(2024, 6, 1)]
    # the 2021 load is pruned away: same result as building from one load only
    from strata.operators.customer import customer
    direct = customer(FX.fx_match(spark, SF), FX.fx_demographic(spark, SF))
    got = cust.select(*direct.columns)
    assert got.exceptAll(direct).count() == 0 and direct.exceptAll(got).count() == 0


def test_full_load_snapshot_selects_by_pattern(spark, tmp_path):
    CAT.create_zone(spark, "snap_src", str(tmp_path / "db"))
    for t in ("nation", "region", "supplier"):
        CAT.register_table(spark, "snap_src", t, f"{SF}/{t}.parquet")
    out = J.full_load_snapshot(spark, "snap_src", str(tmp_path / "raw"), pattern="%ion")
    assert sorted(out) == ["nation", "region"]
    assert scan_csv_pipe(spark, out["nation"]).count() == 25


def test_verify_snapshot_exchanges_rows_of_differing_tables_only(spark, tmp_path, monkeypatch):
    CAT.create_zone(spark, "snap_sums", str(tmp_path / "db"))
    for t in ("customer", "nation", "region", "supplier"):
        CAT.register_table(spark, "snap_sums", t, f"{SF}/{t}.parquet")
    out = J.full_load_snapshot(spark, "snap_sums", str(tmp_path / "raw"))
    grouped = []
    whole = J.digest_differences
    monkeypatch.setattr(J, "digest_differences", lambda left, *rest: grouped.append(left.columns[0]) or whole(left, *rest))
    assert sorted(map(tuple, J.verify_snapshot(spark, "snap_sums", out).collect())) == [(t, 0, 0) for t in sorted(out)]
    assert grouped == []
    sup = spark.table("snap_sums.supplier")
    short = str(tmp_path / "short")
    write_csv_pipe(sup.selectExpr("s_suppkey", "if(s_suppkey = 3, 'x', s_name) s_name", "s_nationkey", "s_acctbal"), short)
    write_csv_pipe(spark.table("snap_sums.region").where("r_regionkey = 2"), out["region"])
    got = sorted(map(tuple, J.verify_snapshot(spark, "snap_sums", {**out, "supplier": short}).collect()))
    assert got == [("customer", 0, 0), ("nation", 0, 0), ("region", 0, 1), ("supplier", 1, 1)]
    assert grouped == ["r_regionkey", "s_suppkey"]


def test_raw_to_transient_appends(spark, tmp_path):
    raw, tr = str(tmp_path / "raw"), str(tmp_path / "tr")
    FX.read_table(spark, SF, "nation").write.options(header=True, sep="|").csv(raw)
    schema = FX.read_table(spark, SF, "nation").schema
    J.raw_to_transient(spark, raw, tr, schema=schema)
    J.raw_to_transient(spark, raw, tr, schema=schema)  # no bookmark on the plain hop: a rerun doubles rows
    assert spark.read.parquet(tr).count() == 50


def test_raw_to_transient_needs_a_known_table(spark, tmp_path):
    import pytest
    raw = str(tmp_path / "raw")
    FX.read_table(spark, SF, "nation").write.options(header=True, sep="|").csv(raw)
    with pytest.raises(ValueError):
        J.raw_to_transient(spark, raw, str(tmp_path / "tr"))


def test_full_load_and_changes_are_typed_alike(spark, tmp_path):
    import json
    from strata.operators.cdc import apply_changes
    raw, tr = str(tmp_path / "raw/T_Demographic"), str(tmp_path / "tr")
    row = {"bid": "7", "zippost": "01234", "phone": "0501", "gender": "1", "bvemail": "0", "bvphone": "1", "version": "x"}
    spark.createDataFrame([row]).write.options(header=True, sep="|").csv(raw)       # columns in alphabetical order
    J.raw_to_transient(spark, raw, tr + "/t_demographic")
    apply_changes(spark.createDataFrame([(json.dumps(row), json.dumps({"operation": "insert", "table-name": "T_Demographic"}))],
                                        "data string, metadata string"), "insert", tr)
    a, b = spark.read.parquet(tr + "/t_demographic").collect()
    assert a == b and (a.bid, a.zippost, a.phone, a.gender, a.bvemail, a.bvphone, a.version) == (7, "01234", "0501", True, False, "1", None)


def test_update_history_raises_on_a_damaged_folder(spark, tmp_path):
    import pytest
    folder = tmp_path / "tr" / "t_demographic_tag_cdc_update"
    folder.mkdir(parents=True)
    (folder / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        J.update_history_to_refined(spark, str(tmp_path / "tr"), str(tmp_path / "rf"), str(tmp_path / "ck"), "u", "p", "s")


def test_update_history_only_existing_tables(spark, tmp_path):
    import json
    rows = [(json.dumps({"bid": "1", "tagaid": "2", "tagvid": "3", "tagdate": "2024-01-01"}),
             json.dumps({"operation": "update", "table-name": "T_Demographic_Tag"}))]
    from strata.operators.cdc import apply_changes
    tr = str(tmp_path / "transient")
    apply_changes(spark.createDataFrame(rows, "data string, metadata string"), "update", tr)
    out = J.update_history_to_refined(spark, tr, str(tmp_path / "refined"), str(tmp_path / "ck"),
                                      "u", "p", "s", as_of="2024-02-03 00:00:00")
    assert list(out) == ["T_Demographic_Tag"]
    r = spark.read.parquet(out["T_Demographic_Tag"]).collect()[0]
    assert (r.bid, r.create_date) == (1, 3)


def test_refined_keeps_evolved_columns(spark, tmp_path):
    tr, rf = str(tmp_path / "tr"), str(tmp_path / "rf")
    spark.createDataFrame([(1, "a")], "id long, s string").write.parquet(tr)
    spark.createDataFrame([(2, "b", 3.5)], "id long, s string, extra double").write.mode("append").parquet(tr)
    J.transient_to_refined(spark, tr, rf, str(tmp_path / "ck"), "u", "p", "s", as_of="2024-01-01 00:00:00")
    rows = sorted((r.id, r.s, r.extra) for r in spark.read.parquet(rf).collect())
    assert rows == [(1, "a", None), (2, "b", 3.5)]
