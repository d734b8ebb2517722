"""Row digests: one comparable value per row of any table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TEXT = "\\N"
LARGEST_SCALED = 9e12          # times 10 ** 6 still inside 64 bits
SLOTS = 1 << 12                # a power of two


def canonical_text(col: Column, kind: T.DataType) -> Column:
    """Text of a value that does not depend on a writer's formatting: numbers
    with a fraction in whole millionths (rounded down), times with
    microseconds, arrays element by element (each with its length), NULL as ``\\N`` (a text's own
    backslashes are doubled, so nothing else reads like that)."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        wide = col.cast("double")
        text = (F.when(F.abs(wide) < LARGEST_SCALED, F.floor(wide * 1e6).cast("string"))
                .otherwise(wide.cast("string")))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(kind, T.StringType):
        text = F.replace(col, F.lit("\\"), F.lit("\\\\"))
    elif isinstance(kind, T.ArrayType):
        text = F.array_join(F.transform(col, lambda x: _measured(canonical_text(x, kind.elementType))), ",")
    elif isinstance(kind, (T.StructType, T.MapType)):
        text = F.to_json(col)
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit(NULL_TEXT))


def _measured(text: Column) -> Column:
    return F.concat(F.length(text).cast("string"), F.lit(":"), text)


def row_digests(df: DataFrame, name: str = "row_md5") -> DataFrame:
    """(``name``): md5 of every row's values in column order, each with its
    length, so that values cannot run into each other."""
    parts = []
    for f in df.schema.fields:
        parts.append(_measured(canonical_text(F.col(f"`{f.name}`"), f.dataType)))
    return df.select(F.md5(F.concat_ws("|", *parts).cast("binary")).alias(name))


def digest_counts(df: DataFrame) -> DataFrame:
    """(row_md5, n): the table as a multiset of rows."""
    return row_digests(df).groupBy("row_md5").agg(F.count(F.lit(1)).alias("n"))


def _slot(digest: Column) -> Column:
    return F.xxhash64(digest).bitwiseAND(F.lit(SLOTS - 1)).cast("int")


def differing_slots(left: DataFrame, right: DataFrame) -> DataFrame:
    """(slot): the slots, of ``SLOTS`` by a hash of the row digest, in which two
    tables do not hold equal rows equally often.  Per slot the number of rows
    and the sums of 128 hash bits (in four parts, which 64 bits hold for 2 ** 31
    rows of a slot) of one side are taken from the other's, so every row is
    read and digested but only sums are exchanged."""
    def side(df: DataFrame, sign: int) -> DataFrame:
        one, two = F.xxhash64("row_md5"), F.xxhash64(F.lit(0), "row_md5")
        low = F.lit((1 << 32) - 1)
        parts = (F.lit(1), F.shiftright(one, 32), one.bitwiseAND(low), F.shiftright(two, 32), two.bitwiseAND(low))
        return row_digests(df).select(_slot(F.col("row_md5")).alias("slot"),
                                      *[(F.lit(sign).cast("long") * x).alias(f"s{i}") for i, x in enumerate(parts)])

    sums = [f"s{i}" for i in range(5)]
    both = side(left, 1).unionByName(side(right, -1)).groupBy("slot").agg(*[F.sum(c).alias(c) for c in sums])
    return both.where(" or ".join(f"{c} <> 0" for c in sums)).select("slot")


def digest_differences(left: DataFrame, right: DataFrame, slots: list[int] | None = None) -> DataFrame:
    """(row_md5, n_left, n_right) of the rows that two tables do not hold
    equally often; empty if they are the same multiset.  One aggregation of the
    union: no join, and equal rows are counted where they are read.  With
    ``slots``, all of ``differing_slots``, only rows of those are exchanged."""
    none = F.lit(0).cast("long")
    both = (row_digests(left).select("row_md5", F.lit(1).cast("long").alias("a"), none.alias("b"))
            .unionByName(row_digests(right).select("row_md5", none.alias("a"), F.lit(1).cast("long").alias("b"))))
    if slots is not None and len(slots) < SLOTS:
        both = both.where(_slot(F.col("row_md5")).isin(slots))
    return (both.groupBy("row_md5").agg(F.sum("a").alias("n_left"), F.sum("b").alias("n_right"))
            .where("n_left <> n_right"))
