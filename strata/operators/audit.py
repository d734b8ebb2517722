"""Audit columns of the refined zone (one projection, no shuffle)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def audit_columns(df: DataFrame, create_user: str, create_process: str, first_source: str,
                  as_of: dt.datetime | str | None = None) -> DataFrame:
    """Append ``created_date, created_timestamp, create_user, create_process,
    first_source, create_year, create_month, create_date``.

    ``as_of`` pins the load time (a UTC datetime or ``'YYYY-MM-DD HH:MM:SS'``
    text) for reproducible runs; by default it is the query's current time,
    which Spark evaluates once per query so every row gets the same value.
    """
    if as_of is None:
        ts = F.current_timestamp()
    else:
        text = as_of.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(as_of, dt.datetime) else as_of
        ts = F.to_timestamp(F.lit(text))
    created_date = F.to_date(ts)
    return df.withColumns({
        "created_date": created_date,
        "created_timestamp": ts,
        "create_user": F.lit(create_user),
        "create_process": F.lit(create_process),
        "first_source": F.lit(first_source),
        "create_year": F.year(created_date),
        "create_month": F.month(created_date),
        "create_date": F.dayofmonth(created_date),
    })
