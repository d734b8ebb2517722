import pytest

from strata.plans import cli
from strata.plans import fixtures as FX
from strata.sinks.files import write_csv_pipe

SF = "/root/testdata/sf0.001"


def test_cli_raw_to_refined(spark, tmp_path):
    raw, tr, rf = (str(tmp_path / n) for n in ("raw", "tr", "rf"))
    write_csv_pipe(FX.read_table(spark, SF, "nation"), raw, mode="overwrite")
    cli.main(["raw-to-transient", "--raw-path", raw, "--transient-path", tr, "--infer"], spark=spark)
    cli.main(["transient-to-refined", "--transient-path", tr, "--refined-path", rf,
              "--checkpoint", str(tmp_path / "ck"), "--create-user", "u", "--create-process", "p",
              "--first-source", "db", "--as-of", "2021-02-03 00:00:00"], spark=spark)
    out = spark.read.parquet(rf)
    assert out.count() == 25
    assert {tuple(r) for r in out.select("create_year", "create_month", "create_date").distinct().collect()} \
        == {(2021, 2, 3)}


def test_cli_rejects_unknown_operation():
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["cdc-to-transient", "--landing", "x", "--transient-root", "y",
                                 "--operation", "delete", "--checkpoint", "z"])


def test_cli_land_then_cdc(spark, tmp_path):
    import json
    inbox, land, tr = (str(tmp_path / n) for n in ("inbox", "land", "tr"))
    msgs = [json.dumps({"data": {"bid": str(b), "email": "x"},
                        "metadata": {"operation": "insert", "table-name": "T_BaseID"}}) for b in range(4)]
    spark.createDataFrame([(m,) for m in msgs], "value string").write.text(inbox)
    cli.main(["land-stream", "--inbox", inbox, "--landing", land, "--checkpoint",
              str(tmp_path / "ck1"), "--available-now"], spark=spark)
    cli.main(["cdc-to-transient", "--landing", land, "--transient-root", tr, "--operation", "insert",
              "--checkpoint", str(tmp_path / "ck2")], spark=spark)
    assert sorted(r.bid for r in spark.read.parquet(tr + "/t_baseid").collect()) == [0, 1, 2, 3]


def test_cli_customer_tables(spark, tmp_path):
    from strata.operators.audit import audit_columns
    from strata.sinks.files import write_refined
    dem, base, match = (str(tmp_path / n) for n in ("dem", "base", "match"))
    write_refined(audit_columns(FX.fx_demographic(spark, SF), "u", "p", "s", "2022-04-05 00:00:00"), dem)
    write_refined(audit_columns(FX.fx_baseid(spark, SF), "u", "p", "s", "2022-04-05 00:00:00"), base)
    FX.fx_match(spark, SF).write.option("header", True).csv(match)
    out = cli.main(["customer-tables", "--demographic", dem, "--baseid", base, "--match", match,
                    "--output-root", str(tmp_path / "cust"), "--year", "2022", "--month-from", "4",
                    "--month-to", "4", "--create-user", "u", "--create-process", "cust",
                    "--first-source", "db", "--as-of", "2022-04-06 00:00:00"], spark=spark)
    assert len(out) == 6 and spark.read.parquet(out["customer"]).count() > 0


def test_cli_cdc_all_operations(spark, tmp_path):
    land, tr = str(tmp_path / "land"), str(tmp_path / "tr")
    FX.fx_cdc(spark, SF).write.parquet(land)
    cli.main(["cdc-to-transient", "--landing", land, "--transient-root", tr, "--operation", "all",
              "--checkpoint", str(tmp_path / "ck"), "--flat"], spark=spark)
    import os
    got = sorted(f for f in os.listdir(tr) if not f.startswith((".", "_")))
    assert got == sorted(t.lower() + s for t in FX.CDC_TABLES for s in ("", "_cdc_update"))
