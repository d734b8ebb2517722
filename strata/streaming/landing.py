"""Change-stream landing: JSON messages -> Parquet with two text columns.

Each message is a JSON object ``{"data": {...}, "metadata": {...}}``.  The
landing keeps both parts as JSON *text* (``data string, metadata string``):
decoding an object into a string field yields its raw JSON text.  The
writer is Spark's file sink, which is exactly-once through its checkpoint
and commit log.

The source is any streaming DataFrame with a ``value`` text column -- Kafka
(``CAST(value AS STRING)``), a socket-free file source in tests, etc.
Open-source Spark ships no source for managed stream services, so the function does not pick
one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.schemas import ENVELOPE_SCHEMA, METADATA_SCHEMA, ROUTE_COLUMNS
from strata.streaming.incremental import MAX_FILE_AGE

# Fixed value: the delivery stream flushes its buffer at least every 900 s.  Its
# other limit (128 MB) sizes files there; here a micro-batch takes all that has
# arrived and its tasks size the files, so the intake is never held back.
LANDING_TRIGGER = "900 seconds"


def envelope_from_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """Message text -> (data, metadata) JSON texts."""
    return (messages.select(F.from_json(F.col(column).cast("string"), ENVELOPE_SCHEMA).alias("m"))
            .select("m.data", "m.metadata"))


def routed_envelope(envelope: DataFrame) -> DataFrame:
    """Envelope plus ``operation`` / ``table_name`` taken from the metadata,
    for landing partitioned by them.  Undecodable metadata gives NULLs, which
    land in the default partition and never match an operation."""
    meta = F.from_json("metadata", METADATA_SCHEMA)
    return envelope.withColumns({"operation": meta["operation"], "table_name": meta["table-name"]})


def message_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                        max_bytes_per_trigger: int | None = None,
                        max_file_age: str = MAX_FILE_AGE) -> DataFrame:
    """JSON-lines files as a message stream (column ``value``).

    Without a limit a micro-batch takes everything new.  A limit bounds the
    size of a micro-batch only: use it with ``available_now``, which goes on
    until nothing is left, not with a timed trigger, which would wait between
    batches while a backlog grows.  Files of any age are read."""
    reader = spark.readStream.format("text").option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    elif max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return reader.load(path)


def message_stream(spark: SparkSession, fmt: str, options: dict[str, str]) -> DataFrame:
    """Messages of any streaming source that Spark has a reader for (e.g.
    ``kafka`` with its broker and topic options), as a text column ``value``."""
    return spark.readStream.format(fmt).options(**options).load().select(F.col("value").cast("string").alias("value"))


def cdc_land_stream(messages: DataFrame, landing_path: str, checkpoint: str,
                    available_now: bool = False, processing_time: str = LANDING_TRIGGER,
                    column: str = "value", routed: bool = True) -> StreamingQuery:
    """Start the landing query (append mode, Parquet file sink).

    The landing is partitioned by operation and table name, so the
    change-capture jobs read only their operation's and table's files
    (partition pruning) instead of decoding every record's metadata;
    ``routed=False`` writes one flat folder."""
    env = envelope_from_messages(messages, column)
    if routed:
        env = routed_envelope(env)
    writer = (env.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    if routed:
        writer = writer.partitionBy(*ROUTE_COLUMNS)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(landing_path)
