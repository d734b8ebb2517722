"""Integrity of hashed keys: facts without a dimension row, colliding composites.

A foreign key of the customer table is a hash of the *demographic* row's values,
while the email dimension is built from the *base-id* table's, so an email key
may dangle by design; the others must not.  Composite keys join their parts
without a separator, so unequal parts can give one key ('ab' + 'c', 'a' + 'bc').
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Foreign keys of the customer table and the dimension of each.
CUSTOMER_KEYS = {"customer_email_id": "customer_email", "customer_name_id": "customer_name",
                 "customer_address_id": "customer_address", "customer_phone_id": "customer_phone"}


def dangling_keys(facts: DataFrame, key: str, dimension: DataFrame, dimension_key: str | None = None) -> DataFrame:
    """(key, n_rows): keys of ``facts`` without a row in ``dimension``; NULL keys
    refer to nothing and are left out.

    Facts are counted per key first (partially where they are read), so a hot
    key is one row in the join."""
    counted = facts.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
    held = dimension.select(F.col(dimension_key or key).alias("key")).distinct()
    return counted.join(held, "key", "left_anti")


def star_dangling(star: dict[str, DataFrame], facts: str = "customer") -> DataFrame:
    """(foreign_key, dimension, key, n_rows) over all foreign keys of the customer table."""
    frames = [dangling_keys(star[facts], column, star[dimension])
              .select(F.lit(column).alias("foreign_key"), F.lit(dimension).alias("dimension"), "key", "n_rows")
              for column, dimension in CUSTOMER_KEYS.items()]
    return reduce(DataFrame.unionByName, frames)


def key_collisions(rows: DataFrame, key: Column, parts: list[str], shown: int = 10) -> DataFrame:
    """(key, n_sources, sources): keys that stand for several unequal sources.

    Sources are compared as the key reads them: lower case, NULL as ''.  Each is
    counted once (partial aggregation), then by key; ``sources`` shows the first
    ``shown`` of them, joined by bars, ``n_sources`` counts all."""
    read = [F.coalesce(F.lower(F.col(p).cast("string")), F.lit("")).alias(f"__p{i}") for i, p in enumerate(parts)]
    names = [f"__p{i}" for i in range(len(parts))]
    # unequal sources stay unequal: they are told apart before they are spelled
    spelled = F.concat_ws("|", *names)
    sources = rows.select(key.alias("key"), *read).distinct().select("key", spelled.alias("source"))
    many = sources.groupBy("key").agg(F.count(F.lit(1)).alias("n_sources")).where("n_sources > 1")
    # of a key's sources at most ``shown`` are brought together
    salted = sources.join(many, "key", "left_semi").groupBy("key", F.pmod(F.xxhash64("source"), F.lit(16)).alias("slot")).agg(
        F.slice(F.sort_array(F.collect_list("source")), 1, shown).alias("some"))
    first = salted.groupBy("key").agg(F.slice(F.sort_array(F.flatten(F.collect_list("some"))), 1, shown).alias("sources"))
    return many.join(first, "key").select("key", "n_sources", F.array_join("sources", ", ").alias("sources"))
