"""Typed casts and timestamp parsing that tolerate malformed input.

ANSI mode is on by default in Spark 4, where a plain ``cast('abc' as
bigint)`` fails the query; ``try_cast`` returns NULL instead, which is the
behaviour the pipeline relies on for text-encoded numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: layout of change-event and notification timestamps, e.g.
# 2024-01-05T10:11:12.123456Z; the fraction has 0 to 9 digits.
CHANGE_TS_PATTERN = r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})(?:\.(\d{1,9}))?Z$"


def parse_change_ts(c: str | Column) -> Column:
    """Parse a change-event timestamp text (UTC, microseconds kept); text of any
    other layout gives NULL."""
    col = F.col(c) if isinstance(c, str) else c
    seconds = F.regexp_extract(col, CHANGE_TS_PATTERN, 1)
    micros = F.rpad(F.substring(F.regexp_extract(col, CHANGE_TS_PATTERN, 2), 1, 6), 6, "0")
    return F.try_to_timestamp(F.concat(seconds, F.lit("."), micros), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def to_second(ts: Column) -> Column:
    """Truncate to whole seconds."""
    return F.date_trunc("second", ts)
