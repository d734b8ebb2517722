"""The hops chained as the lake runs them, checked against a direct computation."""
from strata.operators.customer import customer, customer_email
from strata.operators.schema_ops import conform_to_schema
from strata.plans import fixtures as FX
from strata.plans import jobs as J
from strata.schemas import REGISTRY
from strata.sinks.files import write_csv_pipe

SF = "/root/testdata/sf0.001"


def test_raw_to_customer_tables(spark, tmp_path):
    raw, transient, refined = (str(tmp_path / z) for z in ("raw", "transient", "refined"))
    sources = {"t_demographic": (FX.fx_demographic(spark, SF), REGISTRY["T_Demographic"]),
               "t_baseid": (FX.fx_baseid(spark, SF), REGISTRY["T_BaseID"])}
    for name, (df, spec) in sources.items():
        # database snapshot -> raw pipe-CSV, in the source table's column layout
        write_csv_pipe(conform_to_schema(df, spec.typed_schema, keep_new_columns=False),
                       f"{raw}/{name}", mode="overwrite")
        # raw -> transient, typed by the registry (one pass, no inference)
        J.raw_to_transient(spark, f"{raw}/{name}", f"{transient}/{name}", schema=spec.typed_schema)
        # transient -> refined: incremental, audited, partitioned by load date
        J.transient_to_refined(spark, f"{transient}/{name}", f"{refined}/fig_{name}",
                               str(tmp_path / "ck" / name), "etl_role", f"refine_{name}", "db_name",
                               as_of="2020-06-15 04:00:00")
    match = str(tmp_path / "match")
    FX.fx_match(spark, SF).write.option("header", True).csv(match)
    out = J.customer_tables(spark, f"{refined}/fig_t_demographic", f"{refined}/fig_t_baseid", match,
                            str(tmp_path / "customer"), "etl_role", "customer_job", "db_name",
                            year=2020, month_from=6, month_to=6, day_from=1, day_to=31,
                            as_of="2020-06-16 04:00:00")
    m, b, d = FX.fx_match(spark, SF), FX.fx_baseid(spark, SF), FX.fx_demographic(spark, SF)
    for name, direct in (("customer", customer(m, d)), ("customer_email", customer_email(m, b))):
        got = spark.read.parquet(out[name]).select(*direct.columns)
        assert got.count() == direct.count() > 0
        assert got.exceptAll(direct).count() == 0 and direct.exceptAll(got).count() == 0
