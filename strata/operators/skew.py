"""Skew-safe lookup join: split hot keys off to a size-bounded broadcast.

For an inner join of a large table with a lookup that has one row per key,
one key may carry a large share of the large table's rows (a giant match
cluster, or all rows with a NULL key).  A shuffle join would send all of
those rows to one task.  Here:

* ``hot`` keys are the ``max_hot_keys`` largest, if they carry more than
  ``min_hot_rows`` rows.  A top-k, so broadcasting them is bounded by
  construction, whatever the data size.  Their rows join map-side against
  that broadcast -- no shuffle.
* The remaining rows drop the hot keys with a broadcast anti join (also
  map-side) and then take the ordinary shuffle join, which now has no hot
  key.

The lookup must carry the per-key row count (``rows_col``), which callers
usually get for free from the aggregation that built the lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(lookup: DataFrame, rows_col: str, max_hot_keys: int, min_hot_rows: int) -> DataFrame:
    """The ``max_hot_keys`` keys with the most rows, of those with more than
    ``min_hot_rows``: a top-k, so its size is bounded whatever the data."""
    keys = [F.col(c) for c in lookup.columns if c != rows_col]
    return lookup.where(F.col(rows_col) > min_hot_rows).orderBy(F.desc(rows_col), *keys).limit(max_hot_keys)


def lookup_join_split_hot(big: DataFrame, lookup: DataFrame, big_key: str | list[str],
                          lookup_key: str | list[str], rows_col: str, max_hot_keys: int = 1000,
                          min_hot_rows: int = 1_000_000, null_safe: bool = True) -> DataFrame:
    """Inner join ``big`` x ``lookup`` on ``big_key`` = ``lookup_key`` (one
    column or a list; null-safe by default), result columns of both sides
    minus ``rows_col``.  No job runs while the plan is built."""
    big_keys = [big_key] if isinstance(big_key, str) else list(big_key)
    lookup_keys = [lookup_key] if isinstance(lookup_key, str) else list(lookup_key)
    hot = hot_keys(lookup, rows_col, max_hot_keys, min_hot_rows).drop(rows_col)  # <= max_hot_keys rows
    cold = lookup.drop(rows_col)

    def cond():
        out = None
        for lk, rk in zip(big_keys, lookup_keys):
            left, right = F.col(lk), F.col(rk)
            c = left.eqNullSafe(right) if null_safe else left == right
            out = c if out is None else out & c
        return out

    hot_part = big.join(F.broadcast(hot), cond(), "inner")
    # rows of hot keys leave map-side, so the shuffle join never meets them
    cold_big = big.join(F.broadcast(hot.select(*lookup_keys)), cond(), "left_anti")
    cold_part = cold_big.join(cold, cond(), "inner")
    return hot_part.unionByName(cold_part)
