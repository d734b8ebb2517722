"""Zones as catalog databases; tables as external tables over folders.

* ``create_zone``      -- one database per zone (raw / transient / refined)
* ``register_table``   -- ``CREATE TABLE zone.t USING fmt LOCATION path``;
  Parquet schemas come from footers, CSV schemas are given or inferred;
  partitioned folders get their partitions recovered.
* ``register_folder_tables`` -- one table per sub-folder of a zone prefix
  (what a crawler does), with an optional name prefix.
* ``evolve_table``     -- schema-change policy: append new columns.
* ``select_tables``    -- table-selection rule: database + LIKE pattern.
* ``zone_sql``         -- ad-hoc SQL over registered tables, result
  optionally stored as Parquet.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.session import path_exists
from strata.sources.files import CSV_OPTIONS


def _ident(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return f"`{name}`"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_zone(spark: SparkSession, zone: str, location: str | None = None) -> str:
    sql = f"CREATE DATABASE IF NOT EXISTS {_ident(zone)}"
    if location:
        sql += f" LOCATION {_lit(location)}"
    spark.sql(sql)
    return zone


def register_table(spark: SparkSession, zone: str, name: str, path: str | None,
                   fmt: str = "parquet", schema: T.StructType | None = None,
                   options: dict[str, str] | None = None,
                   partition_by: tuple[str, ...] | None = None,
                   replace: bool = True) -> str:
    """External table over ``path``; dropping it never deletes data.

    ``path=None`` registers a location-less source such as a JDBC table
    (``fmt="jdbc"``, ``options={"url": ..., "dbtable": ..., "partitionColumn":
    ..., "lowerBound": ..., "upperBound": ..., "numPartitions": ...}``), which
    the snapshot job then reads in parallel ranges."""
    full = f"{_ident(zone)}.{_ident(name)}"
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {full}")
    if partition_by and schema is None and path is not None:
        # Footers plus partition discovery; a column list is required with PARTITIONED BY.
        schema = spark.read.format(fmt).options(**(options or {})).load(path).schema
    cols = ""
    if schema is not None:
        cols = "(" + ", ".join(f"{_ident(f.name)} {f.dataType.simpleString()}"
                               for f in schema.fields) + ")"
    opts = dict(options or {})
    if fmt == "csv":
        opts = {**CSV_OPTIONS, **opts}
    opt_sql = ""
    if opts:
        opt_sql = " OPTIONS (" + ", ".join(f"{_lit(k)} {_lit(v)}" for k, v in opts.items()) + ")"
    part_sql = ""
    if partition_by:
        part_sql = " PARTITIONED BY (" + ", ".join(_ident(c) for c in partition_by) + ")"
    loc_sql = f" LOCATION {_lit(path)}" if path is not None else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} {cols} USING {fmt}{opt_sql}{part_sql}{loc_sql}")
    if partition_by and path is not None and not has_sink_log(spark, path):
        spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
    return f"{zone}.{name}"


def evolve_table(spark: SparkSession, zone: str, name: str, batch_schema: T.StructType) -> list[str]:
    """Schema-change policy for a registered table: columns the batch brings
    that the table lacks are appended (``ALTER TABLE ... ADD COLUMNS``);
    existing columns keep their registered type (batches are conformed to it
    with ``operators.schema_ops.conform_to_schema``).  Returns the added names."""
    full = f"{_ident(zone)}.{_ident(name)}"
    known = {f.name.lower() for f in spark.table(full).schema.fields}
    new = [f for f in batch_schema.fields if f.name.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {full} ADD COLUMNS (" + ", ".join(
            f"{_ident(f.name)} {f.dataType.simpleString()}" for f in new) + ")")
    return [f.name for f in new]


def has_sink_log(spark: SparkSession, path: str) -> bool:
    """Whether a stream's file sink keeps the folder: Spark then takes files and
    partitions from the sink's log, and the catalog keeps no partitions."""
    return path_exists(spark, f"{path.rstrip('/')}/_spark_metadata")


def refresh_table(spark: SparkSession, zone: str, folder: str, path: str, schema: T.StructType,
                  prefix: str = "", partition_by: tuple[str, ...] | None = None) -> str:
    """Catalog upkeep after a write to ``path``: register the folder as
    ``zone.<prefix><folder>`` if it is new, else append the columns it lacks and
    pick up new partitions."""
    create_zone(spark, zone)
    name = prefix + folder
    if not spark.catalog.tableExists(f"{zone}.{name}"):
        return register_table(spark, zone, name, path, schema=schema, partition_by=partition_by)
    evolve_table(spark, zone, name, T.StructType([f for f in schema.fields if f.name not in (partition_by or ())]))
    if partition_by and not has_sink_log(spark, path):
        spark.sql(f"ALTER TABLE {_ident(zone)}.{_ident(name)} RECOVER PARTITIONS")
    spark.catalog.refreshTable(f"{zone}.{name}")
    return f"{zone}.{name}"


def table_location(spark: SparkSession, name: str) -> str:
    """Folder of a catalog table (``zone.table``)."""
    zone, table = name.split(".")
    rows = spark.sql(f"DESCRIBE FORMATTED {_ident(zone)}.{_ident(table)}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def vanished_tables(spark: SparkSession, zone: str, deprecate: bool = True) -> list[str]:
    """Tables of ``zone`` whose folder is gone.  They stay registered;
    ``deprecate`` marks them with a table property, else they are only named
    (change-capture zones)."""
    gone = []
    for t in spark.catalog.listTables(zone):
        if not t.isTemporary and not path_exists(spark, table_location(spark, f"{zone}.{t.name}")):
            gone.append(t.name)
            if deprecate:
                spark.sql(f"ALTER TABLE {_ident(zone)}.{_ident(t.name)} SET TBLPROPERTIES ('deprecated' = 'true')")
    return sorted(gone)


def is_table_name(source: str) -> bool:
    """``zone.table`` rather than a path."""
    return re.fullmatch(r"[A-Za-z_]\w*\.[A-Za-z_]\w*", source) is not None


def resolve_input(spark: SparkSession, source: str) -> tuple[str, T.StructType | None]:
    """(folder, schema) of a catalog table, or (path, None)."""
    if is_table_name(source):
        return table_location(spark, source), spark.table(source).schema
    return source, None


def scan_catalog_table(spark: SparkSession, zone: str, name: str) -> DataFrame:
    """All columns of a named catalog table."""
    return spark.table(f"{_ident(zone)}.{_ident(name)}")


def _jvm_fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(sc._jsc.hadoopConfiguration()), jpath


def list_subfolders(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(name, path) of the immediate sub-folders of ``root`` (a metadata listing)."""
    fs, jroot = _jvm_fs(spark, root)
    if not fs.exists(jroot):
        return []
    out = []
    for st in fs.listStatus(jroot):
        name = st.getPath().getName()
        if st.isDirectory() and not name.startswith(("_", ".")):
            out.append((name, st.getPath().toString()))
    return sorted(out)


def list_partitions(spark: SparkSession, root: str, column: str | None = None) -> list[tuple[str, str]]:
    """(value, path) of the ``column=value`` folders of ``root`` (of any column by default)."""
    found = [(name.split("=", 1), path) for name, path in list_subfolders(spark, root) if "=" in name]
    return [(value, path) for (key, value), path in found if column in (None, key)]


def register_folder_tables(spark: SparkSession, zone: str, root: str, fmt: str = "parquet",
                           prefix: str = "", partition_by: tuple[str, ...] | None = None,
                           options: dict[str, str] | None = None) -> list[str]:
    """One table per sub-folder of ``root``, named ``prefix + folder``."""
    create_zone(spark, zone)
    names = []
    for folder, path in list_subfolders(spark, root):
        names.append(register_table(spark, zone, prefix + folder, path, fmt=fmt,
                                    options=options, partition_by=partition_by))
    return names


def select_tables(spark: SparkSession, database: str, pattern: str = "%") -> list[str]:
    """Table-selection rule: tables of ``database`` whose name matches the SQL
    ``LIKE`` pattern (case-insensitive, ``%`` and ``_`` wildcards)."""
    rx = re.compile("^" + "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch)
                                  for ch in pattern) + "$", re.IGNORECASE)
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    return sorted(n for n in names if rx.match(n))


def zone_sql(spark: SparkSession, sql: str, output: str | None = None,
             mode: str = "overwrite") -> DataFrame:
    """Run SQL over registered zone tables; with ``output`` the result is also
    written as Parquet and the stored copy is returned."""
    df = spark.sql(sql)
    if output is None:
        return df
    df.write.mode(mode).parquet(output)
    return spark.read.parquet(output)
