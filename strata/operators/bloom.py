"""A Bloom filter before a join: rows that cannot match leave before they move.

The filter is an array of bit blocks, built with the bitmap aggregate from the
keys of the small side: one value of bounded size, a scalar subquery of the large
side's scan (a join would change places with the one it is meant for).  A row
stays if all its bits are set.  Every row with
a key of the small side stays, of the others about 1 in 70.  It goes in front of
a shuffle join or semi join on the key, which decides as before.

It pays only where most rows cannot match: it is sized by the number of keys, and
left out where more than ``MAX_SHARE`` of the large side's keys are among them or
where the filter would not fit its bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32768              # fixed value: the size of the bitmap aggregate's result
BITS_PER_KEY = 16
PROBES = 2
MAX_BLOCKS = 1 << 11            # 8 MB of filter at most: four million keys
MAX_SHARE = 0.5


def filter_blocks(keys: int) -> int | None:
    """Blocks for so many keys (a power of two); None beyond the bound."""
    need = max(1, -(-keys * BITS_PER_KEY // BLOCK_BITS))
    blocks = 1 << (need - 1).bit_length()
    return blocks if blocks <= MAX_BLOCKS else None


def pays(keys: int, others: int) -> bool:
    """Whether a filter of ``keys`` keys helps against ``others`` keys of the large side."""
    return filter_blocks(keys) is not None and keys <= MAX_SHARE * others


def _places(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    h = F.xxhash64(key)
    return (F.shiftrightunsigned(h, 15 * PROBES).bitwiseAND(F.lit(blocks - 1)).cast("int"),
            [F.shiftrightunsigned(h, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(PROBES)])


def bloom_value(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row, one column: the blocks of the filter of the non-NULL keys, in order."""
    block, places = _places(F.col(key), blocks)
    parts = (keys.where(F.col(key).isNotNull()).select(block.alias("block"), F.explode(F.array(*places)).alias("place"))
             .groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits")))
    held = parts.agg(F.map_from_entries(F.collect_list(F.struct("block", "bits"))).alias("held"))      # at most MAX_BLOCKS entries
    none = F.unhex(F.lit("00")).cast("binary")
    return held.select(F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)),
                                   lambda i: F.coalesce(F.try_element_at("held", i), none)).alias("blocks"))


def bloom_filter(rows: DataFrame, key: str, value: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key may be in the filter; NULL keys are in none."""
    block, places = _places(F.col(key), blocks)
    bits = F.element_at(value.scalar(), block + 1)
    kept = F.col(key).isNotNull()
    for place in places:
        # past the end of an empty block there is no byte
        byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        kept = kept & (F.getbit(F.coalesce(byte, F.lit(0)), place.bitwiseAND(F.lit(7)).cast("int")) == 1)
    return rows.where(kept)


def prefilter(rows: DataFrame, keys: DataFrame, key: str, force: bool | None = None) -> DataFrame:
    """``rows`` without most rows whose ``key`` is not among ``keys`` (distinct).

    Counts the keys of either side first (one column each; the large side's by a
    sketch) and returns ``rows`` as they are where it would not pay.  ``force``
    decides instead of the counts, within the size bound."""
    n = keys.where(F.col(key).isNotNull()).count()
    blocks = filter_blocks(n)
    if blocks is None or force is False:
        return rows
    if force is None and not pays(n, rows.select(F.approx_count_distinct(key)).first()[0]):
        return rows
    return bloom_filter(rows, key, bloom_value(keys, key, blocks), blocks)
