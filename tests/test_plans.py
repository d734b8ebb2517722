"""Plan-shape checks: the properties the operators rely on at scale."""

from pyspark.sql import functions as F

from strata.operators import cdc as CDC
from strata.operators import customer as C
from strata.plans import fixtures as FX
from strata.sinks.files import write_parquet
from strata.sources import files as SRC

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_customer_has_no_window_and_bounded_broadcast(spark):
    m, d = FX.fx_match(spark, SF), FX.fx_demographic(spark, SF)
    p = plan(C.customer(m, d))
    assert "Window" not in p
    # the hot-cluster branch is a broadcast of a filtered (bounded) lookup
    assert "BroadcastExchange" in p or "BroadcastHashJoin" in p


def test_dimension_dedups_before_bid_shuffle(spark):
    m, b, d = FX.fx_match(spark, SF), FX.fx_baseid(spark, SF), FX.fx_demographic(spark, SF)
    df = C.customer_phone(m, b, d)
    lp = df._jdf.queryExecution().optimizedPlan().toString()
    # an Aggregate (the distinct) sits below the semi join on the demographic side
    semi = lp.index("LeftSemi")
    assert "Aggregate [bid" in lp[semi:] or "Aggregate [bid#" in lp[semi:]


def test_allow_list_is_a_filter_not_a_join(spark):
    e = FX.fx_cdc(spark, SF)
    p = plan(CDC.allowed_tables(CDC.filter_operation(CDC.decode_metadata(e), "insert")))
    assert "Join" not in p


def test_partition_pruning_and_projection_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    o = FX.read_table(spark, SF, "orders").withColumns(
        {"create_year": F.year("o_orderdate"), "create_month": F.month("o_orderdate"),
         "create_date": F.dayofmonth("o_orderdate")})
    write_parquet(o, path, partition_by=("create_year", "create_month", "create_date"))
    df = SRC.scan_partition_pruned(spark, path, 1996, 3, 9, 1, 15).select("o_orderkey")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(create_year" in p
    assert "ReadSchema: struct<o_orderkey:bigint>" in p


def test_metadata_decode_is_single_pass(spark):
    e = FX.fx_cdc(spark, SF)
    p = plan(CDC.table_frequency(CDC.decode_metadata(e)))
    # one scan of the events table, partial + final aggregate around one exchange
    assert p.count("FileScan") == 1 or p.count("Scan parquet") <= 1
    assert "partial_count" in p


def test_hot_bid_join_is_split_by_aqe(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        hot = spark.range(0, 4000).select(F.lit(1).cast("long").alias("bid"),
                                          F.col("id").cast("string").alias("phone"))
        cold = spark.range(2, 8000).select(F.col("id").alias("bid"), F.lit("p").alias("phone"))
        cols = {"email": "e", "firstname": "f", "lastname": "l", "address1": "a", "city": "c",
                "state": "s", "zippost": "z"}
        dem = hot.unionByName(cold).select(
            "bid", *[F.lit(v).alias(k) for k, v in cols.items()],
            F.lit(None).cast("string").alias("address2"), F.lit(1).cast("long").alias("zipplus4"), "phone")
        match = spark.range(1, 8000).select(F.col("id").alias("bid"), (F.col("id") / 3).cast("long").alias("match_id"))
        df = C.customer(match, dem)
        assert len(df.collect()) == 4000 + 7998
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_routed_landing_read_prunes_partitions(spark, tmp_path):
    from strata.schemas import ROUTED_ENVELOPE_SCHEMA
    from strata.streaming.landing import routed_envelope
    land = str(tmp_path / "land")
    env = FX.fx_cdc(spark, SF)
    routed_envelope(env).write.partitionBy("operation", "table_name").parquet(land)
    df = (spark.read.schema(ROUTED_ENVELOPE_SCHEMA).parquet(land)
          .where((F.col("operation") == "insert") & (F.col("table_name") == "T_Demographic_Tag"))
          .select("data"))
    p = plan(df)
    assert "PartitionFilters: [" in p and "table_name" in p.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<data:string>" in p  # metadata column is not read


def test_star_moves_demographic_rows_once_per_key(spark, tmp_path):
    """Broadcasts off: one exchange per input on bid, one on the grouped column."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    paths = {n: str(tmp_path / n) for n in ("m", "b", "d")}
    FX.fx_match(spark, SF).write.parquet(paths["m"])
    FX.fx_baseid(spark, SF).write.parquet(paths["b"])
    FX.fx_demographic(spark, SF).write.parquet(paths["d"])
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        m, b, d = (spark.read.parquet(paths[n]) for n in ("m", "b", "d"))

        def exchanges(df):
            return [line for line in plan(df).splitlines() if "Exchange hashpartitioning" in line]

        phone = exchanges(C.customer_phone(m, b, d))
        assert sum("hashpartitioning(phone" in x for x in phone) == 1
        assert sum("hashpartitioning(bid" in x for x in phone) == 3          # match, base id, demographic
        email = exchanges(C.customer_email(m, b))
        assert sum("hashpartitioning(bid" in x for x in email) == 2 and sum("hashpartitioning(email" in x for x in email) == 1
        # the star is built without running a job
        before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
        C.customer(m, d)
        assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
