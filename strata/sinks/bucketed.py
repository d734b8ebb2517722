"""Bucketed, sorted tables: refined inputs laid out for the joins on ``bid``.

Rows are dealt to a fixed number of buckets by the hash of the join key and
sorted in each file, within the date partitions.  Joins and aggregations on the
key read buckets side by side and need no exchange; date pruning works as
before.  A daily append writes its partitions in the same layout, as the bucket
specification belongs to the catalog table.

The number of buckets is fixed for a table's life: choose it by the size of a
full read (about 128 MB a bucket), not of a day.  Each append first brings the
day's rows together by bucket, so that a bucket of a partition is one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import PARTITION_KEYS
from strata.sources.catalog import _ident, create_zone

BUCKETS = 64


def bucket_spec(spark: SparkSession, name: str) -> tuple[int, list[str]] | None:
    """(buckets, columns) of a catalog table ``zone.table``; None if it has none."""
    zone, table = name.split(".")
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {_ident(zone)}.{_ident(table)}").collect()}
    if "Num Buckets" not in rows:
        return None
    return int(rows["Num Buckets"]), [c.strip("` ") for c in rows["Bucket Columns"].strip("[]").split(",")]


def append_bucketed(df: DataFrame, zone: str, table: str, path: str | None = None, key: str = "bid", buckets: int = BUCKETS,
                    partition_by: tuple[str, ...] = PARTITION_KEYS, replace_partitions: bool = False) -> str:
    """Append ``df`` to the bucketed table ``zone.table``, creating it (at ``path``)
    if it is new; returns the name.

    An existing table keeps its own buckets.  ``replace_partitions``: partitions
    that ``df`` holds are replaced, so the same day again adds nothing."""
    spark = df.sparkSession
    create_zone(spark, zone)
    name = f"{zone}.{table}"
    exists = spark.catalog.tableExists(name)
    if exists:
        spec = bucket_spec(spark, name)
        if spec is None or spec[1] != [key]:
            raise ValueError(f"{name} is not bucketed by {key}")
        buckets = spec[0]
        df = df.select(*spark.table(name).columns)
    # the writer's own hash: each task gets whole buckets, so a bucket of a partition is one file
    dealt = df.repartition(buckets, F.col(key))
    if exists and replace_partitions:
        dealt.write.option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True)
    elif exists:
        dealt.write.insertInto(name)
    else:
        ordered = df.select(*[c for c in df.columns if c not in partition_by], *partition_by).repartition(buckets, F.col(key))
        writer = ordered.write.format("parquet").bucketBy(buckets, key).sortBy(key)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        (writer.option("path", path) if path else writer).saveAsTable(name)
    return name


def bucketed_copy(spark: SparkSession, source: str, zone: str, table: str, path: str | None = None, key: str = "bid",
                  buckets: int = BUCKETS) -> str:
    """The bucketed form of a refined table that exists already, in one pass."""
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    return append_bucketed(df, zone, table, path, key, buckets)
