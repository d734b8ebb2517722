import re

from pyspark.sql import functions as F

from strata.operators import bloom as B


def test_no_key_is_lost_and_few_others_pass(spark):
    keys = spark.range(0, 40_000, 4).withColumnRenamed("id", "k").union(spark.createDataFrame([(None,)], "k long"))
    rows = spark.range(0, 200_000).select(F.col("id").alias("k"), F.lit("x").alias("bloom_like")).union(
        spark.createDataFrame([(None, "n")], "k long, bloom_like string"))
    out = B.prefilter(rows, keys, "k")
    assert out.columns == rows.columns
    passed = {r.k for r in out.collect()}
    assert passed >= set(range(0, 40_000, 4)) and None not in passed
    others = len(passed) - 10_000
    assert others < 0.03 * 190_000, others          # 1.4 % with 16 bits a key and two probes


def test_it_is_left_out_where_it_would_not_pay(spark):
    keys = spark.range(1000).withColumnRenamed("id", "k")
    rows = spark.range(1500).withColumnRenamed("id", "k")
    assert B.prefilter(rows, keys, "k") is rows
    assert B.prefilter(rows, keys, "k", force=False) is rows
    assert B.prefilter(rows, keys, "k", force=True) is not rows
    assert B.prefilter(rows, keys.limit(0), "k").count() == 0


def test_sizes():
    assert [B.filter_blocks(n) for n in (0, 1, 2048, 2049, 1 << 22)] == [1, 1, 1, 2, 1 << 11]
    assert B.filter_blocks((1 << 22) + 1) is None and not B.pays((1 << 22) + 1, 1 << 40)
    assert B.pays(10, 20) and not B.pays(11, 20)


def test_the_plan_filters_before_the_exchange(spark, tmp_path):
    spark.range(50_000).select(F.col("id").alias("bid"), F.lit("v").alias("v")).write.parquet(str(tmp_path / "d"))
    dem, keys = spark.read.parquet(str(tmp_path / "d")), spark.range(100).withColumnRenamed("id", "bid")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = B.prefilter(dem, keys, "bid").join(keys, "bid", "left_semi")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "bitmap_construct_agg" in plan
    assert re.search(r"Exchange hashpartitioning\(bid#.*\n[ :]*\+- Filter .*getbit\(", plan), "filtered below the exchange"


def test_star_is_the_same_with_the_filter(spark, tmp_path):
    from strata.operators.audit import audit_columns
    from strata.plans import fixtures as FX
    from strata.plans import jobs as J
    sf, got = "/root/testdata/sf0.001", {}
    m, b, d = (f(spark, sf) for f in (FX.fx_match, FX.fx_baseid, FX.fx_demographic))
    few = m.where("bid % 5 = 0 or bid is null")
    args = ("u", "p", "s")
    for on in (True, False):
        out = J.customer_tables(spark, audit_columns(d, *args, "2024-01-01 00:00:00"), audit_columns(b, *args, "2024-01-01 00:00:00"), few,
                                str(tmp_path / f"out{on}"), *args, year=2024, as_of="2024-01-02 00:00:00", bloom=on)
        got[on] = {t: sorted(map(tuple, spark.read.parquet(p).collect()), key=repr) for t, p in out.items()}
    assert got[True] == got[False] and len(got[True]["customer"]) > 0
