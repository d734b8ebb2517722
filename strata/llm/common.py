"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

# ASCII white space, the word separators of every operator here.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: cuts the lineage in a way that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_hot(rows: DataFrame, found: DataFrame, keys: list[str], slot: str, how: str = "left",
             hot_keys: int = 10_000, hot_rows: int = 1000, fan: int = 64) -> DataFrame:
    """``rows`` joined with ``found`` on ``keys``, hot keys dealt over ``fan`` tasks.

    The ``hot_keys`` most frequent keys of over ``hot_rows`` rows are looked up
    (a top-k, so what is broadcast is bounded); rows of those keys take their
    sub-key from ``slot`` (a non-negative integer column, fixed per row) and the
    rows of ``found`` of those keys are repeated per sub-key.  Any other key has
    at most 1 / ``hot_keys`` of the rows.  ``slot`` is dropped."""
    hot = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_rows)
           .orderBy(F.desc("__n"), *keys).limit(hot_keys).select(*keys, F.lit(True).alias("__hot")))
    hot = F.broadcast(materialise(hot, "hot-keys"))
    left = (rows.join(hot, keys, "left")
            .withColumn("__sub", F.when(F.col("__hot"), F.pmod(slot, F.lit(fan))).otherwise(0).cast("int")).drop("__hot", slot))
    right = (found.join(hot, keys, "left")
             .withColumn("__sub", F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(fan - 1)))
                                            .otherwise(F.array(F.lit(0))))).drop("__hot"))
    return left.join(right, [*keys, "__sub"], how).drop("__sub")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses
    it several times or inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(col: Column) -> Column:
    """A-Z to lower case, all other characters as they are."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ascii_words(col: Column) -> Column:
    """Lower-cased (A-Z) words between ASCII white space, with empty strings
    where separators meet: callers filter those."""
    return F.split(F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz     "), " ")


FILTER_LOG2_BITS = 26           # a bit table has 8 MB at most


def bit_table(hashes: DataFrame, column: str) -> np.ndarray:
    """A table of bits, set where a 64-bit hash falls: about 256 bits for each, at
    most 2 ** FILTER_LOG2_BITS however many there are.  A full one lets more
    through, but never holds anything back."""
    n = hashes.select(F.approx_count_distinct(column)).first()[0]
    log2 = min(FILTER_LOG2_BITS, max(16, int(256 * n).bit_length()))
    place = F.shiftrightunsigned(column, 64 - log2)
    words = (hashes.select(F.shiftright(place, 6).alias("w"), F.pmod(place, F.lit(64)).cast("int").alias("b"))
             .groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits")).toArrow())
    table = np.zeros(1 << (log2 - 6), np.uint64)
    table[words.column("w").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return table


def bit_held(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    place = hashes >> np.uint64(64 - (len(table).bit_length() + 5))
    return (table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def text_slices(batches: Iterator[pa.RecordBatch], text_column: str = "text",
                max_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``max_bytes`` of text (one
    row at least): Python objects are made for one slice at a time."""
    for batch in batches:
        rows = batch.num_rows
        if rows == 0:
            continue
        per_row = max(1, batch.nbytes // rows)
        step = max(1, max_bytes // per_row)
        for lo in range(0, rows, step):
            yield batch.slice(lo, step)
