"""The data products of the layered lake, as parameterised Spark jobs.

One function per hop, shared by all tables (the per-table jobs differ only in
table name and cluster size):

* ``full_load_snapshot``      database tables -> raw zone, pipe-CSV
* ``raw_to_transient``        raw pipe-CSV    -> transient Parquet
* ``cdc_to_transient``        landed change events -> transient, routed per
                              table (inserts) or ``*_cdc_update`` (updates)
* ``transient_to_refined``    transient -> refined (+ audit, date partitions)
* ``update_history_to_refined`` the same over the update-history tables
* ``customer_tables``         refined demographic/base-id + match clusters ->
                              the six customer tables
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.digests import differing_slots, digest_differences
from strata.operators.audit import audit_columns
from strata.operators.bloom import prefilter
from strata.operators.cdc import rejected_values, route_metrics, route_name, route_rows, run_concurrently
from strata.operators.customer import customer_star, distinct_bids
from strata.schemas import (ENVELOPE_SCHEMA, PARTITION_KEYS, REGISTRY, ROUTE_COLUMNS, ROUTED_ENVELOPE_SCHEMA,
                            UPDATE_HISTORY_TABLES, TableSpec, spec_of_folder)
from strata.session import ensure_checkpoint_dir, path_exists, path_join
from strata.sinks.files import write_csv_pipe, write_parquet, write_refined
from strata.sources import catalog as CAT
from strata.sources.files import (match_columns, scan_csv_named, scan_csv_pipe, scan_match_clusters,
                                  scan_partition_pruned, union_all)
from strata.streaming.incremental import LOAD_COLUMN, incremental_copy, incremental_source, run_routes
from strata.streaming.landing import routed_envelope


def _folder(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def full_load_snapshot(spark: SparkSession, database: str, raw_root: str,
                       pattern: str = "%", mode: str = "overwrite",
                       parallelism: int = 4) -> dict[str, str]:
    """Write every table of ``database`` matching ``pattern`` as pipe-CSV under
    ``raw_root/<database>/<table>``.

    The source can be any catalog database -- including JDBC tables
    registered with ``CREATE TABLE t USING jdbc OPTIONS (url ...,
    partitionColumn ..., numPartitions ...)`` so the read is parallel.
    Each table is one distributed read and write; nothing passes the driver.
    Up to ``parallelism`` tables are written as concurrent Spark jobs, so
    small tables do not leave the cluster idle.
    """
    names = CAT.select_tables(spark, database, pattern)
    paths = {name: path_join(raw_root, database, name) for name in names}

    def write(name: str) -> None:
        write_csv_pipe(spark.table(f"`{database}`.`{name}`"), paths[name], mode=mode)

    run_concurrently(write, names, parallelism)
    return paths


def verify_snapshot(spark: SparkSession, database: str, paths: dict[str, str]) -> DataFrame:
    """(table_name, n_missing, n_extra): rows of the database that a written
    snapshot (``full_load_snapshot``'s result) lacks, and rows that it has too
    many, by digests of whole rows.  A row per table, zeros if all is well.

    First the digests of all tables are summed by slot, which exchanges sums
    alone; only tables in which sums differ are read again, and only their rows
    in the slots that differ are exchanged and counted one by one."""
    sides = {}
    for name, path in sorted(paths.items()):
        source = spark.table(f"`{database}`.`{name}`")
        sides[name] = source, scan_csv_named(spark, path, source.schema, escaped_breaks=True)
    if not sides:
        raise ValueError("no tables to verify")
    slots = union_all([differing_slots(*both).select(F.lit(name).alias("table_name"), "slot") for name, both in sides.items()])
    differ = {r["table_name"]: r["slots"] for r in
              slots.groupBy("table_name").agg(F.collect_list("slot").alias("slots")).collect()}     # SLOTS numbers a table at most
    checks = []
    for name, both in sides.items():
        if name not in differ:
            continue
        found = digest_differences(*both, differ[name])
        lost, more = F.col("n_left") - F.col("n_right"), F.col("n_right") - F.col("n_left")
        checks.append(found.agg(F.coalesce(F.sum(F.greatest(lost, F.lit(0))), F.lit(0)).alias("n_missing"),
                                F.coalesce(F.sum(F.greatest(more, F.lit(0))), F.lit(0)).alias("n_extra"))
                      .select(F.lit(name).alias("table_name"), "n_missing", "n_extra"))
    same = [name for name in sides if name not in differ]
    if same:
        zero = F.lit(0).cast("long")
        checks.append(spark.range(1).select(F.explode(F.array(*map(F.lit, same))).alias("table_name"), zero.alias("n_missing"), zero.alias("n_extra")))
    return union_all(checks)


def raw_to_transient(spark: SparkSession, raw: str, transient_path: str,
                     table: str | None = None, schema: T.StructType | None = None,
                     infer: bool = False, mode: str = "append", escaped_breaks: bool = False,
                     zone: str | None = None, prefix: str = "", load: str | None = None) -> DataFrame:
    """Pipe-CSV (a folder or ``zone.table``) -> Parquet.  Returns the frame that
    was written.

    Columns are found by header name and typed like the change path: by
    ``schema``, else by the registered table that ``table`` or the folder name
    says.  Types are inferred (an extra pass; leading zeros are lost) only with
    ``infer``.  Appends by default: re-running a load doubles its rows, as the
    plain full-load hop has no bookmark.  With ``load`` the rows are that load's
    partition of the table: the same load again replaces it, and change rows
    (other partitions) stay.  ``zone``: keep the catalog up to date."""
    path, _ = CAT.resolve_input(spark, raw)
    if infer:
        df = scan_csv_pipe(spark, path, infer=True)
    else:
        if schema is None:
            spec = spec_of_folder(table or path)
            if spec is None:
                raise ValueError(f"no registered table for {table or path!r}: pass schema, or infer=True")
            schema = spec.typed_schema
        df = scan_csv_named(spark, path, schema, escaped_breaks)
    write_parquet(df, transient_path if load is None else path_join(transient_path, f"{LOAD_COLUMN}={load}"),
                  mode=mode if load is None else "overwrite")
    if zone:
        keys = None if load is None else (LOAD_COLUMN,)
        schema = df.schema if load is None else T.StructType([*df.schema.fields, T.StructField(LOAD_COLUMN, T.StringType())])
        CAT.refresh_table(spark, zone, _folder(transient_path), transient_path, schema, prefix, keys)
    return df


def cdc_to_transient(spark: SparkSession, landing_path: str, transient_root: str,
                     operations: str | tuple[str, ...], checkpoint: str,
                     registry: dict[str, TableSpec] | None = None,
                     max_files_per_trigger: int | None = None, routed: bool = True,
                     max_bytes_per_trigger: int | None = None, cutover_notice: str | None = None,
                     zone: str | None = None, prefix: str = "", parallelism: int = 4,
                     rejects_root: str | None = None) -> dict[str, dict[str, int]]:
    """Incremental run over newly landed change events for one operation or
    several (inserts go to ``<t>``, updates to ``<t>_cdc_update``).

    One stream per operation and registered table that the landing holds: it
    finds new files through the landing's own log and reads those of its route
    only.  Every micro-batch is one ``load=`` partition of the route's table, so
    a batch that runs again adds nothing.  ``routed=False``: a landing that is
    not partitioned by operation and table is first landed again so, below the
    checkpoint, decoding its metadata once.  ``cutover_notice``: leave out
    changes before that snapshot.  ``rejects_root``: keep what typing made NULL,
    one table (table_name, field, value) per route.  ``zone``: keep the catalog
    up to date.

    Returns per route the counts of this run, observed in the writes: ``rows``,
    ``undecoded`` payloads and ``rejected`` values."""
    registry = registry or REGISTRY
    operations = (operations,) if isinstance(operations, str) else tuple(operations)
    if not routed:
        flat, landing_path = landing_path, path_join(checkpoint, "routed")
        known = F.col("operation").isin(*operations) & F.col("table_name").isin(*sorted(registry))
        incremental_copy(spark, flat, ENVELOPE_SCHEMA, landing_path, path_join(checkpoint, "routing"),
                         transform=lambda df: routed_envelope(df).where(known), partition_by=ROUTE_COLUMNS,
                         max_files_per_trigger=max_files_per_trigger, max_bytes_per_trigger=max_bytes_per_trigger)
    present = {(op, t) for op in operations for t, _ in CAT.list_partitions(spark, path_join(landing_path, f"operation={op}"))}
    routes, targets, also = {}, {}, {}
    for op in operations:
        for spec in registry.values():
            if (op, spec.name) in present:
                name = route_name(spec.name, op)
                targets[name] = path_join(transient_root, name)
                also[name] = (lambda batch, spec=spec: rejected_values(batch, spec), path_join(rejects_root or "", name))
                routes[name] = lambda op=op, spec=spec: route_rows(
                    incremental_source(spark, landing_path, ROUTED_ENVELOPE_SCHEMA, "parquet", max_files_per_trigger,
                                       max_bytes_per_trigger=max_bytes_per_trigger), op, spec, cutover_notice)
    counts = run_routes(spark, routes, targets, path_join(checkpoint, "routes"), {n: route_metrics() for n in routes},
                        parallelism, also if rejects_root else None)
    if zone:
        for name, count in counts.items():
            if count.get("rows"):
                table = spark.read.parquet(targets[name])
                CAT.refresh_table(spark, zone, name, targets[name], table.schema, prefix, (LOAD_COLUMN,))
    return counts


def transient_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of a transient folder: that of its registered table.  Only for
    other folders are the footers of all files merged."""
    spec = spec_of_folder(path)
    if spec is not None:
        return spec.typed_schema
    merged = spark.read.option("mergeSchema", "true").parquet(path).schema
    return T.StructType([f for f in merged.fields if f.name != LOAD_COLUMN])


def transient_to_refined(spark: SparkSession, transient: str, refined_path: str,
                         checkpoint: str, create_user: str, create_process: str,
                         first_source: str, as_of: dt.datetime | str | None = None,
                         schema: T.StructType | None = None,
                         max_files_per_trigger: int | None = None,
                         max_bytes_per_trigger: int | None = None,
                         zone: str | None = None, prefix: str = "") -> None:
    """Incremental run: new files of a transient table (a folder or
    ``zone.table``, plain or with ``load=`` partitions) + audit columns -> refined,
    partitioned by create_year/create_month/create_date.

    Spark's own file sink: its log makes every batch count once, for readers of
    the folder and of the catalog table alike.  Without ``as_of`` the load time
    is the micro-batch's, which a replay takes over from the stream's log."""
    path, known = CAT.resolve_input(spark, transient)
    schema = schema or known or transient_schema(spark, path)
    if CAT.list_partitions(spark, path, LOAD_COLUMN) and LOAD_COLUMN not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(LOAD_COLUMN, T.StringType())])
    loads = LOAD_COLUMN in schema.fieldNames() and bool(CAT.list_partitions(spark, path, LOAD_COLUMN))

    def audited(df: DataFrame) -> DataFrame:
        return audit_columns(df.drop(LOAD_COLUMN) if loads else df, create_user, create_process, first_source, as_of)

    incremental_copy(spark, path, schema, refined_path, path_join(checkpoint, "stream"), transform=audited,
                     partition_by=PARTITION_KEYS, max_files_per_trigger=max_files_per_trigger,
                     max_bytes_per_trigger=max_bytes_per_trigger)
    if zone and path_exists(spark, refined_path):
        table = audited(spark.createDataFrame([], schema))
        CAT.refresh_table(spark, zone, _folder(refined_path), refined_path, table.schema, prefix, PARTITION_KEYS)


def update_history_to_refined(spark: SparkSession, transient_root: str, refined_root: str,
                              checkpoint_root: str, create_user: str, create_process: str,
                              first_source: str, as_of: dt.datetime | str | None = None,
                              tables: tuple[str, ...] = UPDATE_HISTORY_TABLES) -> dict[str, str]:
    """Refine the ``*_cdc_update`` history folders that exist (a table without
    updates has none); any other failure is raised."""
    out = {}
    for table in tables:
        folder = route_name(table, "update")
        src = path_join(transient_root, folder)
        if not path_exists(spark, src):
            continue
        dst = path_join(refined_root, folder)
        transient_to_refined(spark, src, dst, path_join(checkpoint_root, folder),
                             create_user, create_process, first_source, as_of)
        out[table] = dst
    return out


def customer_tables(spark: SparkSession, demographic: str | DataFrame, baseid: str | DataFrame,
                    match: str | DataFrame, output_root: str, create_user: str,
                    create_process: str, first_source: str,
                    year: int, month_from: int = 1, month_to: int = 12,
                    day_from: int = 1, day_to: int = 31,
                    as_of: dt.datetime | str | None = None, zone: str | None = None,
                    prefix: str = "", bloom: bool | None = None) -> dict[str, str]:
    """Build and write the six customer tables from date-pruned refined inputs
    (paths, ``zone.table`` names or frames; the clusters as CSV, table or frame).

    Each output is one Spark job reading only the Parquet columns it needs.
    What several outputs share -- the match table, the bid lists, members, heads
    and the clustered demographic rows -- is checkpointed once into
    ``spark.checkpoint.dir``, a reliable checkpoint, so a lost executor does not
    force recomputing it.  Demographic rows of bids in no cluster leave before
    they move where a Bloom filter pays (``operators.bloom``; ``bloom`` decides
    instead).  ``zone``: keep the catalog up to date."""
    ensure_checkpoint_dir(spark)
    # A bid with many distinct versions makes the final join on bid skewed;
    # let AQE split it even though the distinct after it then needs a shuffle.
    if spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin", "false") != "true":
        spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    dem = scan_partition_pruned(spark, demographic, year, month_from, month_to, day_from, day_to)
    bid = scan_partition_pruned(spark, baseid, year, month_from, month_to, day_from, day_to)
    if isinstance(match, str):
        m = match_columns(spark.table(match)) if CAT.is_table_name(match) else scan_match_clusters(spark, match)
    else:
        m = match_columns(match)
    m = m.checkpoint(eager=True)
    dem = prefilter(dem, distinct_bids(m), "bid", bloom)
    out = {}
    star = customer_star(m, bid, dem, reuse=lambda df: df.checkpoint(eager=True))
    for name, df in star.items():
        path = path_join(output_root, name.lower())
        audited = audit_columns(df, create_user, create_process, first_source, as_of)
        write_refined(audited, path)
        if zone:
            CAT.refresh_table(spark, zone, _folder(path), path, audited.schema, prefix, PARTITION_KEYS)
        out[name] = path
    return out
