"""Change-event decoding, filtering, typing and routing.

A change event is an envelope of two JSON texts, ``data`` (the row) and
``metadata`` (operation, table name, timestamp, ...).  Everything here is
built-in Spark expressions: ``from_json`` with a fixed schema, filters on the
decoded struct, ``try_cast`` typing, and a routed multi-table write.

Scale notes:

* The landing is partitioned by operation and table name (see
  ``streaming.landing``).  The change job runs one stream per route
  (``route_rows``), which reads only the route's files.  The batch form
  (``apply_changes``) first writes an envelope in that layout below the shared
  checkpoint folder, decoding its metadata once.
* The list of tables to write is the registered tables present in the batch,
  a bounded list (at most the registry size) -- never the data itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import CHANGE_TS_PATTERN, parse_change_ts, to_second
from strata.schemas import METADATA_SCHEMA, REGISTRY, ROUTE_COLUMNS, UPDATE_SUFFIX, TableSpec
from strata.session import path_join, scratch_path

META = "meta"


def meta(field: str) -> Column:
    """Field of the decoded metadata struct (hyphenated names are back-ticked)."""
    return F.col(f"{META}.`{field}`")


def decode_metadata(envelope: DataFrame) -> DataFrame:
    """(data, metadata) -> (data, meta struct).  Malformed metadata decodes to a
    struct of NULLs; empty or NULL text to a NULL struct."""
    return envelope.select("data", F.from_json("metadata", METADATA_SCHEMA).alias(META))


def metadata_columns(decoded: DataFrame) -> DataFrame:
    """Flat view of the decoded metadata, with SQL-friendly names."""
    return decoded.select(
        meta("operation").alias("operation"),
        meta("record-type").alias("record_type"),
        meta("schema-name").alias("schema_name"),
        meta("table-name").alias("table_name"),
        meta("timestamp").alias("change_ts"),
        meta("transaction-id").alias("transaction_id"),
        meta("partition-key-type").alias("partition_key_type"),
    )


def filter_operation(decoded: DataFrame, operation: str) -> DataFrame:
    """Keep one operation (``insert`` / ``update``); deletes and control
    records never match, nor do rows with undecodable metadata."""
    return decoded.where(meta("operation") == F.lit(operation))


def table_frequency(decoded: DataFrame) -> DataFrame:
    """Records per table name, ascending by count (ties by name)."""
    return (decoded.groupBy(meta("table-name").alias("table_name"))
            .agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy("cnt", "table_name"))


def registered(decoded: DataFrame, registry: dict[str, TableSpec] | None = None) -> DataFrame:
    """Drop records of tables without a registered schema.

    The registry is a fixed handful of names, so this is an ``IN`` list
    evaluated in the scan stage, no join."""
    names = sorted((registry or REGISTRY).keys())
    return decoded.where(meta("table-name").isin(names))


def allowed_tables(decoded: DataFrame, registry: dict[str, TableSpec] | None = None) -> DataFrame:
    """Distinct registered table names present in the batch."""
    return (registered(decoded, registry)
            .select(meta("table-name").alias("table_name")).distinct())


def decode_payload(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Payload (``data``) of rows already known to be ``spec``'s table, decoded
    with every field as text."""
    return rows.select(F.from_json("data", spec.json_schema).alias("row")).select("row.*")


def decode_table(decoded: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of one table, payload decoded with every field as text."""
    return decode_payload(decoded.where(meta("table-name") == F.lit(spec.name)), spec)


def typed_cast(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Apply the table's cast map in one projection; malformed values -> NULL.

    Note: ``try_cast('12.5' as bigint)`` is NULL (no truncation)."""
    cols = []
    for f in rows.columns:
        t = spec.cast_type(f)
        cols.append(F.col(f).try_cast(t).alias(f) if t is not None else F.col(f))
    return rows.select(*cols)


def decode_typed(decoded: DataFrame, spec: TableSpec) -> DataFrame:
    return typed_cast(decode_table(decoded, spec), spec)


def route_target(table_name: Column | str, operation: Column | str) -> Column:
    """Target folder name: lower(table) for inserts, lower(table)_cdc_update for updates."""
    t = F.col(table_name) if isinstance(table_name, str) else table_name
    op = F.col(operation) if isinstance(operation, str) else operation
    return F.concat(F.lower(t), F.when(op == F.lit("update"), F.lit(UPDATE_SUFFIX))
                    .otherwise(F.lit("")))


def route_name(table_name: str, operation: str) -> str:
    """Driver-side twin of :func:`route_target` for building output paths."""
    return table_name.lower() + (UPDATE_SUFFIX if operation == "update" else "")


def cutover_condition(timestamp: Column, notice_ts: str) -> Column:
    """Whether a change is at or after the snapshot cut-over.

    ``notice_ts`` is the full-load completion notice time
    (``yyyy-MM-ddTHH:mm:ss[.fraction]Z``, an error in any other form); the change
    stream starts at that time truncated to whole seconds.  A record without a
    readable time cannot be told to be older, so it is kept."""
    if not re.match(CHANGE_TS_PATTERN, notice_ts):
        raise ValueError(f"unreadable cut-over notice time: {notice_ts!r}")
    at = parse_change_ts(timestamp)
    return at.isNull() | (at >= to_second(parse_change_ts(F.lit(notice_ts))))


def cutover_filter(decoded: DataFrame, notice_ts: str) -> DataFrame:
    """Keep changes at or after the snapshot cut-over."""
    return decoded.where(cutover_condition(meta("timestamp"), notice_ts))


def run_concurrently(fn, items, parallelism: int = 1) -> None:
    """Call ``fn(item)`` for every item, as up to ``parallelism`` concurrent
    Spark jobs (threads submitting jobs to the one SparkContext)."""
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        for it in items:
            fn(it)
        return
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as pool:
        for f in [pool.submit(fn, it) for it in items]:
            f.result()  # re-raise the first failure


def route_rows(envelope: DataFrame, operation: str, spec: TableSpec, cutover_notice: str | None = None) -> DataFrame:
    """Typed rows of one operation and table from a routed envelope (data,
    metadata, operation, table_name), batch or streaming.

    The route is a filter on partition columns, so only the route's files are
    read, and the metadata text only where the cut-over asks for its time.
    ``__rejects`` holds what typing made NULL: (field, value) of every value that
    its type rejects, or (NULL, payload) where the payload gave no field at all."""
    rows = envelope.where((F.col("operation") == operation) & (F.col("table_name") == spec.name))
    if cutover_notice is not None:
        rows = rows.where(cutover_condition(F.from_json("metadata", METADATA_SCHEMA)["timestamp"], cutover_notice))
    decoded = rows.select(F.from_json("data", spec.json_schema).alias("row"), F.col("data").alias("payload"))
    values = {f.name: F.col(f"row.`{f.name}`") for f in spec.json_schema.fields}
    typed = {f: v.try_cast(spec.cast_type(f)) if spec.cast_type(f) is not None else v for f, v in values.items()}
    lost = [F.when(v.isNotNull() & typed[f].isNull(), F.struct(F.lit(f).alias("field"), v.alias("value")))
            for f, v in values.items() if spec.cast_type(f) is not None]
    empty = F.coalesce(*values.values()).isNull()
    lost.append(F.when(empty, F.struct(F.lit(None).cast("string").alias("field"), F.col("payload").alias("value"))))
    return decoded.select(*[c.alias(f) for f, c in typed.items()], F.array_compact(F.array(*lost)).alias("__rejects"))


def route_metrics() -> dict[str, Column]:
    """Aggregates over what :func:`route_rows` returns: payloads that gave no
    field, and values that their type rejected."""
    undecoded = F.exists("__rejects", lambda r: r["field"].isNull())
    return {"undecoded": F.count_if(undecoded),
            "rejected": F.coalesce(F.sum(F.when(~undecoded, F.size("__rejects"))), F.lit(0))}


def rejected_values(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """(table_name, field, value) of what typing made NULL in :func:`route_rows`."""
    return rows.select(F.lit(spec.name).alias("table_name"), F.inline("__rejects"))


def routed_rows(envelope: DataFrame, operations: tuple[str, ...], registry: dict[str, TableSpec],
                cutover_notice: str | None = None) -> DataFrame:
    """(data, operation, table_name) of registered tables, so laid out that a
    filter on the last two prunes files."""
    names = sorted(registry)
    if all(c in envelope.columns for c in ROUTE_COLUMNS):
        rows = envelope
        if cutover_notice is not None:
            at = F.from_json("metadata", METADATA_SCHEMA)["timestamp"]
            rows = rows.where(cutover_condition(at, cutover_notice))
        return rows.where(F.col("operation").isin(*operations) & F.col("table_name").isin(names)).select("data", *ROUTE_COLUMNS)
    decoded = registered(decode_metadata(envelope.select("data", "metadata")), registry)
    if cutover_notice is not None:
        decoded = cutover_filter(decoded, cutover_notice)
    rows = decoded.where(meta("operation").isin(*operations)).select(
        "data", meta("operation").alias("operation"), meta("table-name").alias("table_name"))
    path = scratch_path(envelope.sparkSession, "routed")
    rows.write.partitionBy(*ROUTE_COLUMNS).parquet(path)
    return envelope.sparkSession.read.schema(rows.schema).parquet(path)


def append_parquet(df: DataFrame, path: str, route: str) -> None:
    df.write.mode("append").parquet(path)


def apply_changes(envelope: DataFrame, operations: str | tuple[str, ...], output_root: str,
                  registry: dict[str, TableSpec] | None = None,
                  sink: Callable[[DataFrame, str, str], None] = append_parquet,
                  cutover_notice: str | None = None, parallelism: int = 4) -> dict[str, str]:
    """Routed multi-table sink for one or several operations.

    Writes each present registered table's typed rows under
    ``output_root/<route>`` (inserts ``<t>``, updates ``<t>_cdc_update``) with
    ``sink(df, path, route)``; returns ``{route: path}``.  Up to ``parallelism``
    tables are written as concurrent Spark jobs."""
    registry = registry or REGISTRY
    operations = (operations,) if isinstance(operations, str) else tuple(operations)
    rows = routed_rows(envelope, operations, registry, cutover_notice)
    present = rows.select(*ROUTE_COLUMNS).distinct().collect()   # bounded: registry size x operations
    routes = {route_name(r["table_name"], r["operation"]): (r["table_name"], r["operation"]) for r in present}
    paths = {route: path_join(output_root, route) for route in sorted(routes)}

    def write(route: str) -> None:
        table, operation = routes[route]
        spec = registry[table]
        part = rows.where((F.col("operation") == operation) & (F.col("table_name") == table)).select("data")
        sink(typed_cast(decode_payload(part, spec), spec), paths[route], route)

    run_concurrently(write, list(paths), parallelism)
    return paths
