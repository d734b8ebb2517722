"""The customer table kept up day by day.

What is kept between runs, below a state folder, is the links table: (bid,
match_id, head_bid) per distinct cluster membership, dealt to ``PARTS`` partitions
by cluster.  A day brings new demographic rows and new memberships:

1. the day's pairs are those memberships that become present with it (a new
   membership of a known bid, or any membership of a new bid);
2. they are merged with the links of the clusters they fall in -- only those
   partitions are read and rewritten -- and the heads of these clusters are taken
   again;
3. touched bids are those of the day's rows and pairs and those whose head has
   changed; their customer rows are built anew from all their links and
   demographic rows, and replace the old ones in the partitions of the customer
   table that hold them.

Inputs only grow, so three daily runs give what one run over everything gives.
The customer table is written before the links, which decide what a run sees as
changed: a run that dies is done again with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.customer import customer_rows, distinct_bids
from strata.session import path_exists, path_join, scratch_path

PARTS = 64
LINKS = "bid long, match_id long, head_bid long, part int"


def _cluster_part(parts: int) -> Column:
    return F.pmod(F.xxhash64(F.coalesce("match_id", F.lit(-1).cast("long"))), F.lit(parts)).cast("int")


def _customer_part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _replace_parts(df: DataFrame, path: str) -> None:
    """Replace the partitions of ``path`` that ``df`` has rows of.  Rows come from
    the same table, so they are set down first."""
    spark = df.sparkSession
    staged = scratch_path(spark, "parts")
    df.write.parquet(staged)
    (spark.read.schema(df.schema).parquet(staged).repartition("part").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path))


def _table(spark, path: str, ddl) -> DataFrame:
    return spark.read.schema(ddl).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], ddl)


def _set_down(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def update_customer(day_demographic: DataFrame, day_match: DataFrame, demographic: DataFrame, match: DataFrame,
                    state: str, output: str, parts: int = PARTS) -> dict[str, int]:
    """Bring the customer table at ``output`` up to date with a day's rows.

    ``demographic`` and ``match`` hold everything so far, the day included.
    Returns how much was touched: ``clusters``, ``bids`` and ``parts`` of the
    customer table that were rewritten."""
    spark = demographic.sparkSession
    links_path = path_join(state, "links")
    links = _table(spark, links_path, LINKS)
    pairs = match.select("bid", "match_id")
    # memberships that are present from this day on
    of_new_bids = pairs.join(distinct_bids(day_demographic), "bid", "left_semi")
    of_known_bids = day_match.select("bid", "match_id").join(distinct_bids(demographic), "bid", "left_semi")
    day_pairs = _set_down(of_new_bids.unionByName(of_known_bids).distinct().withColumn("part", _cluster_part(parts)), "day-pairs")
    # the links of the clusters that the day falls in; the list of partitions is bounded by ``parts``
    touched_parts = [r["part"] for r in day_pairs.select("part").distinct().collect()]
    near = links.where(F.col("part").isin(touched_parts))
    clusters = day_pairs.select(F.col("match_id").alias("m"), "part").distinct()
    same = F.col("match_id").eqNullSafe(F.col("m")) & (near["part"] == clusters["part"])
    old = near.join(clusters, same, "left_semi")
    members = old.select("bid", "match_id", "part").unionByName(day_pairs).distinct()
    heads = members.groupBy(F.col("match_id").alias("m"), F.col("part").alias("p")).agg(F.min("bid").alias("head_bid"))
    merged = _set_down(members.join(heads, F.col("match_id").eqNullSafe(F.col("m")) & (F.col("part") == F.col("p")))
                       .select("bid", "match_id", "head_bid", "part"), "merged-links")
    # bids whose links are new or have another head, and those with new rows
    changed = merged.join(old, ["bid", "part"], "left").where(
        F.coalesce(merged["match_id"].eqNullSafe(old["match_id"]) & (merged["head_bid"] == old["head_bid"]), F.lit(False)) == F.lit(False))
    bids = _set_down(changed.select("bid").unionByName(distinct_bids(day_demographic)).distinct(), "touched-bids")
    untouched = near.join(clusters, same, "left_anti")
    elsewhere = links.where(~F.col("part").isin(touched_parts))
    all_links = merged.unionByName(untouched.select(*merged.columns)).unionByName(elsewhere.select(*merged.columns))
    own = all_links.join(bids, "bid", "left_semi").select("bid", F.nullif(F.col("head_bid"), F.col("bid")).alias("parent_bid"))
    fresh = customer_rows(own, demographic.join(bids, "bid", "left_semi"))
    fresh = _set_down(fresh.withColumn("part", _customer_part(F.col("customer_id"), parts)), "customer-rows")
    written = [r["part"] for r in fresh.select("part").distinct().collect()]          # at most ``parts``
    before = _table(spark, output, fresh.schema).where(F.col("part").isin(written))
    kept = before.join(fresh.select("customer_id").distinct(), "customer_id", "left_anti")
    if written:
        _replace_parts(kept.select(*fresh.columns).unionByName(fresh), output)
    if touched_parts:
        _replace_parts(merged.unionByName(untouched.select(*merged.columns)), links_path)
    return {"clusters": clusters.count(), "bids": bids.count(), "parts": len(written)}
