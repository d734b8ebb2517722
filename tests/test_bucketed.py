import glob
import os
import re

import pytest

from strata.operators import customer as C
from strata.operators.audit import audit_columns
from strata.plans import fixtures as FX
from strata.plans import jobs as J
from strata.sinks.bucketed import append_bucketed, bucket_spec

SF = "/root/testdata/sf0.001"
DAYS = ("2020-03-01 00:00:00", "2020-03-02 00:00:00")


@pytest.fixture(scope="module")
def zone(spark, tmp_path_factory):
    """Refined inputs of two days and the clusters, bucketed by bid."""
    root = tmp_path_factory.mktemp("bucketed")
    for i, day in enumerate(DAYS):
        for name, df in (("fig_t_demographic", FX.fx_demographic(spark, SF)), ("fig_t_baseid", FX.fx_baseid(spark, SF))):
            part = audit_columns(df.where(f"bid % 2 = {i}"), "u", "p", "s", day)
            append_bucketed(part, "bucket_zone", name, str(root / name), buckets=8)
    append_bucketed(FX.fx_match(spark, SF), "bucket_zone", "matches", str(root / "matches"), buckets=8, partition_by=())
    yield root
    spark.sql("DROP DATABASE bucket_zone CASCADE")


def tables(spark):
    return [spark.table(f"bucket_zone.{t}") for t in ("matches", "fig_t_baseid", "fig_t_demographic")]


def plan_of(df):
    """The final plan, with the join form of large tables."""
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def large(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def exchanges(plan):
    return re.findall(r"Exchange hashpartitioning\(([^,)]*)", plan)


def test_joins_on_bid_need_no_exchange(spark, zone, large):
    m, b, d = tables(spark)
    for df in (C.clustered_demographic(m, b, d), C.present_members(m, d), C.customer_email(m, b)):
        on = exchanges(plan_of(df))
        assert not any(x.startswith("bid#") for x in on), on
    # the customer table: only the small cluster links move, by cluster and back by bid
    plan = plan_of(C.customer(m, d))
    moved = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(bid#", line)]
    assert len(moved) <= 2, plan
    scan = next(line for line in plan.splitlines() if "fig_t_demographic" in line and "firstname" in line)
    above = plan[:plan.index(scan)].splitlines()[-4:]
    assert not any("Exchange" in line for line in above), "demographic rows stay where they are"


def test_same_rows_as_the_plain_layout(spark, zone):
    m, b, d = tables(spark)
    plain = FX.fx_match(spark, SF), FX.fx_baseid(spark, SF), FX.fx_demographic(spark, SF)
    for one, two in ((C.customer(m, d), C.customer(plain[0], plain[2])), (C.customer_email(m, b), C.customer_email(plain[0], plain[1])),
                     (C.customer_address(m, b, d), C.customer_address(*plain))):
        assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_an_append_keeps_the_layout(spark, zone):
    assert bucket_spec(spark, "bucket_zone.fig_t_demographic") == (8, ["bid"])
    for day in (1, 2):
        files = glob.glob(f"{zone}/fig_t_demographic/create_year=2020/create_month=3/create_date={day}/*.parquet")
        names = [re.search(r"_(\d{5})\.c\d+", os.path.basename(f)).group(1) for f in files]
        assert len(names) == len(set(names)) <= 8, "one file per bucket"
    with pytest.raises(ValueError):
        append_bucketed(FX.fx_baseid(spark, SF), "bucket_zone", "fig_t_baseid", key="email")


def test_the_same_day_again_replaces_it(spark, tmp_path):
    rows = spark.range(100).withColumnRenamed("id", "bid")
    for _ in range(2):
        append_bucketed(audit_columns(rows, "u", "p", "s", DAYS[0]), "bucket_again", "t", str(tmp_path / "t"), buckets=4, replace_partitions=True)
    append_bucketed(audit_columns(rows, "u", "p", "s", DAYS[1]), "bucket_again", "t", buckets=99, replace_partitions=True)
    assert spark.table("bucket_again.t").count() == 200
    assert spark.table("bucket_again.t").where("create_date = 1").count() == 100
    spark.sql("DROP DATABASE bucket_again CASCADE")


def test_the_job_reads_bucketed_tables(spark, zone, tmp_path):
    out = J.customer_tables(spark, "bucket_zone.fig_t_demographic", "bucket_zone.fig_t_baseid", "bucket_zone.matches",
                            str(tmp_path / "out"), "u", "p", "s", year=2020, as_of=DAYS[1])
    want = C.customer(FX.fx_match(spark, SF), FX.fx_demographic(spark, SF))
    got = spark.read.parquet(out["customer"]).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
