"""Incremental crawl of a zone: what is new, changed or gone since the last one.

A crawl lists the files below a zone's folder, one table per sub-folder, and
compares the listing with the manifest that the last crawl left (a Parquet table
of folder, partition, file, length and time).  Only folders with a difference
are touched:

* a new folder is registered as a table;
* in a changed one, the footers of the new files alone are read, new columns are
  added, and new partition folders are added by name -- not by recovering the
  whole history;
* a vanished folder's table stays registered and is marked as deprecated (or only
  named, as change-capture zones want it).

The listing and the comparison are Spark jobs (a scan without content, one full
outer join on the file's path); what the driver gets is a row per folder and the
new files of the changed ones.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.schema_ops import common_schema, schema_groups
from strata.session import path_exists, path_join
from strata.sources.catalog import _ident, _lit, create_zone, evolve_table, list_subfolders, register_table

FILE_DDL = "folder string, partition string, file string, length long, modified timestamp"


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(folder, partition, file, length, modified) of the data files below ``root``.

    ``folder`` is the sub-folder, ``partition`` its ``a=1/b=2`` path (or '')."""
    folders = list_subfolders(spark, root)
    if not folders:
        return spark.createDataFrame([], FILE_DDL)
    # an absolute form, as the listing spells it
    base = folders[0][1].rsplit("/", 1)[0].split(":", 1)[-1].lstrip("/")
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([p for _, p in folders])
              .select("path", "length", "modificationTime"))
    inside = F.element_at(F.split("path", re.escape(base + "/")), -1)
    parts = F.split(inside, "/")
    return (listed.select(parts[0].alias("folder"), F.array_join(F.slice(parts, 2, F.size(parts) - 2), "/").alias("partition"),
                          F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))
            .where(~F.element_at(F.split("file", "/"), -1).rlike("^[_.]") & ~F.col("partition").rlike("(^|/)[_.]")))


def compare(before: DataFrame, now: DataFrame) -> DataFrame:
    """(folder, partition, file, state): ``new``, ``changed``, ``vanished`` or ``same``."""
    b, n = before.alias("b"), now.alias("n")
    state = (F.when(F.col("b.file").isNull(), "new").when(F.col("n.file").isNull(), "vanished")
             .when((F.col("b.length") == F.col("n.length")) & (F.col("b.modified") == F.col("n.modified")), "same").otherwise("changed"))
    return b.join(n, F.col("b.file") == F.col("n.file"), "full_outer").select(
        *[F.coalesce(f"n.{c}", f"b.{c}").alias(c) for c in ("folder", "partition", "file")], state.alias("state"))


def _partition_spec(partition: str) -> str:
    pairs = (p.split("=", 1) for p in partition.split("/"))
    return ", ".join(f"{_ident(k)}={_lit(v)}" for k, v in pairs)


def crawl(spark: SparkSession, zone: str, root: str, manifest: str, prefix: str = "", deprecate: bool = True) -> list[dict]:
    """Bring the tables of ``zone`` up to date with the folders below ``root``;
    returns a row per folder: folder, state, new, changed and vanished files.

    ``manifest`` is a folder of this crawl alone.  Its next version is written
    after the catalog is up to date, so a crawl that dies is done again."""
    create_zone(spark, zone)
    versions = [int(name) for name, _ in list_subfolders(spark, manifest) if name.isdigit()
                and path_exists(spark, path_join(manifest, name, "_SUCCESS"))]
    last = max(versions, default=-1)
    before = (spark.read.schema(FILE_DDL).parquet(path_join(manifest, str(last))) if last >= 0
              else spark.createDataFrame([], FILE_DDL))
    following = path_join(manifest, str(last + 1))
    list_files(spark, root).write.mode("overwrite").parquet(following + ".listing")
    now = spark.read.schema(FILE_DDL).parquet(following + ".listing")
    files = compare(before, now)
    counts = [F.count_if(F.col("state") == s).alias(s) for s in ("new", "changed", "vanished", "same")]
    folders = {r["folder"]: r.asDict() for r in files.groupBy("folder").agg(*counts).collect()}
    report = []
    for folder, n in sorted(folders.items()):
        table, path = prefix + folder, path_join(root, folder)
        full = f"{_ident(zone)}.{_ident(table)}"
        if not (n["new"] or n["changed"] or n["same"]):
            state = "vanished"
            if deprecate and spark.catalog.tableExists(f"{zone}.{table}"):
                spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ('deprecated' = 'true')")
        elif not (n["same"] or n["changed"] or n["vanished"]):
            state = "new"
            _register(spark, zone, table, path, files.where(F.col("folder") == folder))
        elif n["new"] or n["changed"] or n["vanished"]:
            state = "changed"
            own = files.where(F.col("folder") == folder)
            if not spark.catalog.tableExists(f"{zone}.{table}"):
                _register(spark, zone, table, path, own.where("state <> 'vanished'"))
            elif n["new"] or n["changed"]:
                _grow(spark, zone, table, own)
            if n["vanished"]:
                _drop_empty_partitions(spark, full, own)
            spark.catalog.refreshTable(f"{zone}.{table}")
        else:
            state = "same"
        report.append({"folder": folder, "state": state, **{k: n[k] for k in ("new", "changed", "vanished")}})
    now.write.mode("overwrite").parquet(following)
    return report


def _register(spark: SparkSession, zone: str, table: str, path: str, own: DataFrame) -> None:
    first = own.agg(F.max("partition")).first()[0] or ""
    keys = tuple(p.split("=", 1)[0] for p in first.split("/") if "=" in p)
    register_table(spark, zone, table, path, partition_by=keys or None)


def _grow(spark: SparkSession, zone: str, table: str, own: DataFrame) -> None:
    """Columns and partitions that the new and changed files of a folder bring."""
    fresh = own.where("state in ('new', 'changed')").select("file", "partition").collect()     # the files since the last crawl
    schema = common_schema([s for s, _ in schema_groups(spark, sorted(r["file"] for r in fresh))])
    keys = {p.split("=", 1)[0] for p in fresh[0]["partition"].split("/") if p}
    evolve_table(spark, zone, table, T.StructType([f for f in schema.fields if f.name not in keys]))
    partitions = sorted({r["partition"] for r in fresh if r["partition"]})
    full = f"{_ident(zone)}.{_ident(table)}"
    for lo in range(0, len(partitions), 100):
        specs = " ".join(f"PARTITION ({_partition_spec(p)})" for p in partitions[lo:lo + 100])
        spark.sql(f"ALTER TABLE {full} ADD IF NOT EXISTS {specs}")


def _drop_empty_partitions(spark: SparkSession, full: str, own: DataFrame) -> None:
    """Partitions that have lost all their files leave the catalog."""
    left = own.groupBy("partition").agg(F.count_if(F.col("state") != "vanished").alias("n"))
    for r in left.where("n = 0 and partition <> ''").collect():         # partitions emptied since the last crawl
        spark.sql(f"ALTER TABLE {full} DROP IF EXISTS PARTITION ({_partition_spec(r['partition'])})")
