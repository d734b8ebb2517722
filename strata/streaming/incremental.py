"""Incremental (bookmarked) processing of a growing folder.

A file-source stream with a checkpoint remembers which files it has
processed; ``trigger(availableNow=True)`` processes everything new and
stops.  One call = one scheduled run (e.g. the daily batch).  The bookmark
advances only when a micro-batch commits, and a run that finds no new
files does nothing (the emptiness guard).

Three sinks:

* ``incremental_copy`` -- Spark's file sink (exactly-once via its log), for a
  table that one stream alone writes.
* ``run_routes`` -- a stream per target table, each micro-batch written as its
  own ``load=`` partition, for tables that other loads append to as well.  A
  replayed batch has the same load name, so it adds nothing.
* ``incremental_foreach`` -- any other ``foreachBatch`` function; it gets the
  micro-batch DataFrame and its id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import delete_path, path_exists, path_join

# Partition column of tables that several loads append to.
LOAD_COLUMN = "load"

# Spark's file source leaves out files older than this, seen from the newest
# one (7 days by default); restored and backfilled files must be read too.
MAX_FILE_AGE = "36500d"


def incremental_source(spark: SparkSession, path: str, schema: T.StructType,
                       fmt: str = "parquet", max_files_per_trigger: int | None = None,
                       options: dict[str, str] | None = None,
                       max_bytes_per_trigger: int | None = None) -> DataFrame:
    """File-source stream over files of any age; the per-batch file or byte cap
    bounds the size of each micro-batch of a catch-up run (the run still
    processes everything)."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    elif max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)


def run_available_now(stream_writer, timeout_s: float | None = None):
    """Start an availableNow query, wait for it, surface its error if any."""
    q = stream_writer.trigger(availableNow=True).start()
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - awaitTermination raises first
        raise RuntimeError(str(q.exception()))
    return q


def incremental_copy(spark: SparkSession, source: str, schema: T.StructType, target: str,
                     checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                     fmt: str = "parquet", partition_by: tuple[str, ...] | None = None,
                     max_files_per_trigger: int | None = None,
                     max_bytes_per_trigger: int | None = None) -> None:
    """Process the files added since the last run into ``target`` (append)."""
    df = incremental_source(spark, source, schema, fmt, max_files_per_trigger,
                            max_bytes_per_trigger=max_bytes_per_trigger)
    if transform is not None:
        df = transform(df)
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", target))
    if partition_by:
        w = w.partitionBy(*partition_by)
    run_available_now(w)


def incremental_foreach(spark: SparkSession, source: str, schema: T.StructType,
                        checkpoint: str, batch_fn: Callable[[DataFrame, int], None],
                        fmt: str = "parquet", max_files_per_trigger: int | None = None,
                        max_bytes_per_trigger: int | None = None) -> None:
    """Run ``batch_fn(df, batch_id)`` on every non-empty micro-batch of new files."""
    df = incremental_source(spark, source, schema, fmt, max_files_per_trigger,
                            max_bytes_per_trigger=max_bytes_per_trigger)

    def guarded(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():  # nothing new: skip all work
            return
        batch_fn(batch, batch_id)

    run_available_now(df.writeStream.foreachBatch(guarded)
                      .option("checkpointLocation", checkpoint))


def load_name(checkpoint: str, batch_id: int) -> str:
    """Name of a micro-batch's load: the same for every attempt at it, another
    for every other stream and batch."""
    return f"{hashlib.md5(checkpoint.rstrip('/').encode()).hexdigest()[:10]}-{int(batch_id)}"


def write_load(df: DataFrame, table_path: str, load: str, metrics: dict[str, Column] | None = None) -> dict[str, int]:
    """Write ``df`` as the partition ``load=<load>`` of a table, replacing what an
    earlier attempt at the same load may have left there.

    Spark's committer ends a complete write with ``_SUCCESS``; a load that has
    it is left as it is, so files that others may have read already are not
    replaced.  Returns ``metrics`` (aggregates observed in the write itself) and
    ``rows``; a load without rows leaves nothing behind."""
    spark = df.sparkSession
    path = path_join(table_path, f"{LOAD_COLUMN}={load}")
    if path_exists(spark, path_join(path, "_SUCCESS")):
        return {}
    seen = Observation()
    aggregates = [F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in (metrics or {}).items())]
    written = df.observe(seen, *aggregates)
    written.drop(*[c for c in df.columns if c.startswith("__")]).write.mode("overwrite").parquet(path)
    counts = seen.get
    if counts["rows"] == 0:
        delete_path(spark, path)
    return counts


def run_routes(spark: SparkSession, routes: dict[str, Callable[[], DataFrame]], targets: dict[str, str], checkpoint: str,
               metrics: dict[str, dict[str, Column]] | None = None, parallelism: int = 4,
               also: dict[str, tuple[Callable[[DataFrame], DataFrame], str]] | None = None) -> dict[str, dict[str, int]]:
    """One ``availableNow`` stream per route, up to ``parallelism`` at a time.

    ``routes[name]()`` is a streaming frame; each micro-batch of it becomes a load
    of ``targets[name]``.  A stream has its own checkpoint, so a route that fails
    holds nothing else back; the first error is raised after all have ended.
    ``also[name]`` is a second output of a route (a function of the batch, and
    the table it goes to), written unless the metrics say that only ``rows`` is
    not zero.  Columns that begin with ``__`` are for metrics and second outputs.
    Returns the summed metrics of this run's batches per route."""
    totals: dict[str, dict[str, int]] = {}

    def run(name: str) -> None:
        own = path_join(checkpoint, name)
        total = totals.setdefault(name, {})

        def write(batch: DataFrame, batch_id: int) -> None:
            load = load_name(own, batch_id)
            counts = write_load(batch, targets[name], load, (metrics or {}).get(name))
            for key, n in counts.items():
                total[key] = total.get(key, 0) + n
            # no counts: an earlier attempt wrote the rows, but maybe not this
            if also and (not counts or any(n for key, n in counts.items() if key != "rows")):
                second, path = also[name]
                write_load(second(batch), path, load)

        run_available_now(routes[name]().writeStream.foreachBatch(write).option("checkpointLocation", own))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        runs = [pool.submit(run, name) for name in routes]
    for done in runs:
        done.result()
    return totals
