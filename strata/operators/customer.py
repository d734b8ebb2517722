"""Customer star: attribute dimensions, base-id cross reference, customer table.

Inputs are three DataFrames:

* ``match``       (bid, match_id)  -- output of an external fuzzy matcher
* ``baseid``      (bid, email, ...) -- refined base-id table
* ``demographic`` (bid, email, firstname, lastname, address1, address2, city,
  state, zippost, zipplus4, phone, ...) -- refined demographic table

Plan shape, chosen for very large inputs where one bid or one cluster may
hold a third of all rows:

* Joins whose only purpose is to restrict rows ("is this bid clustered?") are
  left-semi joins against a *distinct* bid list (partial aggregation, map-side).
  The large side moves once, on ``bid``; grouping comes after the join.
* Attribute dimensions are a ``distinct`` over the attribute columns with
  the key computed afterwards, so md5 runs once per distinct value.  A value
  held by a huge share of rows collapses in the partial aggregate.
* The cluster head (smallest clustered bid per ``match_id``) is a grouped
  ``min`` -- partial aggregation again -- joined back on an explicit
  (value, is-null) cluster key instead of a window over each cluster, which
  would put a whole (possibly giant) cluster into one task.  All NULL
  ``match_id`` rows form one cluster, as in the original window.  Giant
  clusters are split off and joined through a broadcast that holds at most
  ``max_hot_clusters`` rows; the others take a shuffle join.
* A bid whose rows stay many after de-duplication (many distinct versions)
  is split by AQE's skew-join handling; the session sets
  ``spark.sql.adaptive.forceOptimizeSkewedJoin`` so the split also happens
  where the following distinct reuses the join's partitioning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import (address_key, email_key, entity_key, name_key,
                                   phone_key)
from strata.operators.skew import lookup_join_split_hot

ADDRESS_COLUMNS = ("address1", "address2", "city", "state", "zippost", "zipplus4")
NAME_COLUMNS = ("firstname", "lastname")


def distinct_bids(df: DataFrame) -> DataFrame:
    """Non-NULL bids of a table, de-duplicated map-side."""
    return df.select("bid").where(F.col("bid").isNotNull()).distinct()


def clustered_baseid_bids(match: DataFrame, baseid: DataFrame) -> DataFrame:
    """Bids present in both the match clusters and the base-id table."""
    return distinct_bids(match).join(distinct_bids(baseid), "bid", "left_semi")


def clustered_demographic(match: DataFrame, baseid: DataFrame, demographic: DataFrame,
                          columns: tuple[str, ...] = (*ADDRESS_COLUMNS, *NAME_COLUMNS, "phone"),
                          eligible: DataFrame | None = None) -> DataFrame:
    """Demographic rows (projected) whose bid is clustered and has a base id.

    Equivalent to ``match JOIN baseid JOIN demographic`` followed by a
    grouping on demographic columns only: the inner joins can only drop or
    repeat demographic rows, and the grouping removes the repeats.  One
    exchange on ``bid``; a hot bid is split by AQE, as only the left side of a
    left-semi join is large."""
    if eligible is None:
        eligible = clustered_baseid_bids(match, baseid)
    return demographic.select("bid", *columns).join(eligible, "bid", "left_semi").select(*columns)


def customer_email(match: DataFrame, baseid: DataFrame) -> DataFrame:
    """``customer_email(customer_email_id, email)`` from base-id emails of clustered bids."""
    emails = (baseid.select("bid", "email")
              .join(distinct_bids(match), "bid", "left_semi")
              .select("email").distinct())
    return emails.select(email_key("email").alias("customer_email_id"), "email")


def customer_address(match: DataFrame, baseid: DataFrame, demographic: DataFrame,
                     clustered: DataFrame | None = None) -> DataFrame:
    rows = clustered if clustered is not None else clustered_demographic(match, baseid, demographic, ADDRESS_COLUMNS)
    addrs = rows.select(*ADDRESS_COLUMNS).distinct()
    return addrs.select(address_key().alias("customer_address_id"), *ADDRESS_COLUMNS)


def customer_name(match: DataFrame, baseid: DataFrame, demographic: DataFrame,
                  clustered: DataFrame | None = None) -> DataFrame:
    rows = clustered if clustered is not None else clustered_demographic(match, baseid, demographic, NAME_COLUMNS)
    names = rows.select(*NAME_COLUMNS).distinct()
    return names.select(name_key().alias("customer_name_id"), *NAME_COLUMNS)


def customer_phone(match: DataFrame, baseid: DataFrame, demographic: DataFrame,
                   clustered: DataFrame | None = None) -> DataFrame:
    rows = clustered if clustered is not None else clustered_demographic(match, baseid, demographic, ("phone",))
    phones = rows.select("phone").distinct()
    return phones.select(phone_key().alias("customer_phone_id"), "phone")


def present_members(match: DataFrame, demographic: DataFrame,
                    dem_bids: DataFrame | None = None) -> DataFrame:
    """Distinct cluster memberships (bid, match_id) whose bid has a demographic row.

    The semi join leaves the rows partitioned on ``bid``, which the distinct
    reuses; a hot bid is split by AQE before it."""
    if dem_bids is None:
        dem_bids = distinct_bids(demographic)
    return match.select("bid", "match_id").join(dem_bids, "bid", "left_semi").distinct()


def customer_xref(match: DataFrame, demographic: DataFrame,
                  members: DataFrame | None = None) -> DataFrame:
    """``fig_baseid_x_customer(customer_id, bid)``: one row per (bid, match_id).
    A bid that sits in two clusters appears twice."""
    members = present_members(match, demographic) if members is None else members
    return members.select(entity_key("bid").alias("customer_id"), "bid")


def cluster_heads(members: DataFrame) -> DataFrame:
    """(h_mkey, h_mnull, head_bid, members): smallest bid per cluster.

    NULL match_id is one cluster.  An explicit (value, is-null) key makes the
    aggregate partitioned exactly like the join needs, so the head side is not
    shuffled a second time for a null-safe comparison."""
    return (_keyed(members).groupBy(F.col("mkey").alias("h_mkey"), F.col("mnull").alias("h_mnull"))
            .agg(F.min("bid").alias("head_bid"), F.count(F.lit(1)).alias("members")))


def _keyed(members: DataFrame) -> DataFrame:
    return members.withColumns({"mkey": F.coalesce(F.col("match_id"), F.lit(0).cast("long")),
                                "mnull": F.col("match_id").isNull()})


def parent_link(match: DataFrame, demographic: DataFrame, max_hot_clusters: int = 1000,
                min_hot_rows: int = 1_000_000, members: DataFrame | None = None,
                heads: DataFrame | None = None) -> DataFrame:
    """(bid, match_id, parent_bid): parent_bid is the cluster's smallest present bid,
    NULL for the head itself.  All NULL ``match_id`` rows form one cluster.

    Clusters holding very many members (see ``operators.skew``) are joined back
    through a size-bounded broadcast, the rest by shuffle."""
    members = present_members(match, demographic) if members is None else members
    heads = cluster_heads(members) if heads is None else heads
    linked = lookup_join_split_hot(_keyed(members), heads, ["mkey", "mnull"], ["h_mkey", "h_mnull"],
                                   "members", max_hot_keys=max_hot_clusters,
                                   min_hot_rows=min_hot_rows, null_safe=False)
    # members are distinct per (bid, match_id), so the result needs no distinct
    return linked.select("bid", "match_id",
                         F.nullif(F.col("head_bid"), F.col("bid")).alias("parent_bid"))


def customer(match: DataFrame, demographic: DataFrame, max_hot_clusters: int = 1000,
             min_hot_rows: int = 1_000_000, members: DataFrame | None = None,
             heads: DataFrame | None = None) -> DataFrame:
    """``customer(customer_id, customer_email_id, customer_name_id,
    customer_address_id, customer_phone_id, parent_customer_id)``.

    The email key comes from the *demographic* email (the email dimension is
    built from base-id emails, so this foreign key may dangle by design).
    Several distinct demographic versions of one bid give several rows.

    Demographic rows move once, on ``bid``, with their plain columns; the keys
    are hashed after the join, and the distinct reuses its partitioning.
    """
    links = parent_link(match, demographic, max_hot_clusters, min_hot_rows, members,
                        heads).select("bid", "parent_bid")
    return customer_rows(links, demographic)


def customer_rows(links: DataFrame, demographic: DataFrame) -> DataFrame:
    """Customer rows of ``links`` (bid, parent_bid) from their demographic rows."""
    attributes = demographic.select("bid", "email", *NAME_COLUMNS, *ADDRESS_COLUMNS, "phone")
    dedup = links.join(attributes, "bid").select(
        "bid", email_key("email").alias("customer_email_id"), name_key().alias("customer_name_id"),
        address_key().alias("customer_address_id"), phone_key().alias("customer_phone_id"),
        "parent_bid").distinct()
    # bid -> customer_id is one-to-one, so hashing it after the distinct equals grouping on the hashed ids
    return dedup.select(
        entity_key("bid").alias("customer_id"),
        "customer_email_id", "customer_name_id", "customer_address_id", "customer_phone_id",
        _nullable_key("parent_bid").alias("parent_customer_id"),
    )


def _nullable_key(c: str) -> Column:
    return F.when(F.col(c).isNull(), F.lit(None)).otherwise(entity_key(c))


def customer_star(match: DataFrame, baseid: DataFrame, demographic: DataFrame,
                  reuse: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """All six customer tables, keyed by their output table name.

    What several outputs share is built once; ``reuse`` (e.g. ``lambda df:
    df.checkpoint()``) materialises it so the six writes do not recompute it."""
    keep = reuse or (lambda df: df)
    match = keep(match.select("bid", "match_id"))
    members = keep(present_members(match, demographic))
    heads = keep(cluster_heads(members))
    clustered = keep(clustered_demographic(match, baseid, demographic).distinct())
    return {
        "customer_email": customer_email(match, baseid),
        "customer_address": customer_address(match, baseid, demographic, clustered),
        "customer_name": customer_name(match, baseid, demographic, clustered),
        "customer_phone": customer_phone(match, baseid, demographic, clustered),
        "fig_baseid_x_customer": customer_xref(match, demographic, members),
        "customer": customer(match, demographic, members=members, heads=heads),
    }
