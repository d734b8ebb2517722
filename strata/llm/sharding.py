"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard levels.  At each level every child of
the node reached so far draws ``-ln(u) / weight`` with ``u`` a hash of the row
key and the child's name; the smallest draw wins, so a child gets a share of
the node's rows in proportion to its weight.  A draw depends on nothing but
the key and that child, hence:

* raising one child's weight moves rows only from its siblings into it;
* subtrees whose weights (and whose ancestors' weights) stay put keep every
  row they do not lose to the changed one; rows never move between two
  unchanged siblings.

``default_tree(n)`` lays the first ``base`` shards out in regions and racks.
Every further shard opens a region of its own, so no existing weight changes
and one more shard takes rows only into itself (law ``key``).

Results: a NULL key is a key of its own; repeated rows share a shard and get
different slots; a NULL text counts as no bytes; an empty table gives an empty
result; further columns of the input are not looked at.

Slots number the rows of a shard from 0 without gaps in the order of a hash of
key, size and text checksum.  Rows equal in all three cannot be told apart, so
they are counted where they are read (partial aggregation, a count per input
partition group); the hash range is cut in buckets, whose starts are a running
sum over the small count table; running sums within a bucket give each count
its first slot, and only then are the rows made again, dealt by count.  No task
sees a whole shard, nor all rows of a key or of a text, even if a third of the
table has no key or is one text.

Draws and the slot order are 52 bits of an md5, so that any system with md5 can
recompute a placement.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import let, materialise

ROW_OVERHEAD_BYTES = 16
SPREAD = 256                     # counts that the rows of one kind are kept in at most


@dataclass(frozen=True)
class Node:
    """A subtree (``children``) or, without children, the shard ``shard``."""

    name: str
    weight: float
    children: tuple["Node", ...] = ()
    shard: int | None = None


def default_tree(n_shards: int, base: int = 40, shards_per_rack: int = 5,
                 racks_per_region: int = 2) -> Node:
    """Regions of racks of equally weighted shards; shards from ``base`` on
    are regions of one rack with one shard."""
    if n_shards < 1:
        raise ValueError("at least one shard is needed")

    def rack(name: str, shards: range) -> Node:
        leaves = tuple(Node(f"shard-{s}", 1.0, shard=s) for s in shards)
        return Node(name, float(len(leaves)), leaves)

    regions = []
    first = min(base, n_shards)
    per_region = shards_per_rack * racks_per_region
    for lo in range(0, first, per_region):
        racks = tuple(rack(f"rack-{s // shards_per_rack}", range(s, min(s + shards_per_rack, first)))
                      for s in range(lo, min(lo + per_region, first), shards_per_rack))
        regions.append(Node(f"region-{lo // per_region}", sum(r.weight for r in racks), racks))
    for s in range(first, n_shards):
        regions.append(Node(f"region-of-{s}", 1.0, (rack(f"rack-of-{s}", range(s, s + 1)),)))
    return Node("root", sum(r.weight for r in regions), tuple(regions))


def _tree_value(tree: Node) -> Column:
    """The tree as a constant: array<region> of array<rack> of array<shard>.
    Subtrees of weight 0 are left out: they get no rows."""
    def node(n: Node, inner: Column) -> Column:
        return F.struct(F.lit(n.name).alias("name"), F.lit(float(n.weight)).alias("weight"), inner.alias("inner"))

    def level(nodes: tuple[Node, ...], inner) -> Column:
        live = [n for n in nodes if n.weight > 0]
        if not live:
            raise ValueError("a node needs a child with a weight above 0")
        return F.array(*[node(n, inner(n)) for n in live])

    return level(tree.children, lambda region: level(region.children, lambda rack: level(
        rack.children, lambda shard: F.lit(int(shard.shard)))))


def md5_bits(*parts: Column) -> Column:
    """52 bits of the md5 of ``parts`` joined by colons; NULL parts are left out."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 13), 16, 10).cast("long")


def _descend(key: Column, children: Column, seed: str) -> Column:
    """The child with the smallest draw."""
    def draw(c: Column) -> Column:
        u = (md5_bits(F.concat(F.lit(f"{seed}/"), c["name"]), key).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
        return -F.log(u) / c["weight"]

    draws = F.transform(children, lambda c, i: F.struct(draw(c).alias("d"), i.alias("i")))
    return F.element_at(children, F.array_min(draws)["i"] + 1)


def place(df: DataFrame, key: Column, tree: Node, out: str, seed: str = "place") -> DataFrame:
    """Add ``out``: struct(region, rack, shard) that the key descends to."""
    k = key.cast("string")
    shard = let(_descend(k, _tree_value(tree), seed), lambda region: let(
        _descend(k, region["inner"], seed), lambda rack: let(
            _descend(k, rack["inner"], seed), lambda shard: F.struct(
                region["name"].alias("region"), rack["name"].alias("rack"), shard["inner"].alias("shard")))))
    return df.withColumn(out, shard)


def shard_rows(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id",
               text_col: str = "text", tree: Node | None = None, grown: Node | None = None,
               buckets: int | None = None) -> DataFrame:
    """One row per row of ``docs``: its shard, its slot there, and the shard
    it would have with one shard more."""
    spark = docs.sparkSession
    tree = tree or default_tree(n_shards)
    grown = grown or default_tree(n_shards + 1)
    if buckets is None:
        # even a shard with a third of all rows is cut finer than the partitions
        buckets = max(1, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    if buckets > 1 << 20:
        raise ValueError("at most 2**20 buckets a shard")

    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + ROW_OVERHEAD_BYTES).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("crc"),
        F.pmod(F.spark_partition_id(), F.lit(SPREAD)).alias("part"))
    kinds = rows.groupBy("id", "size", "crc", "part").agg(F.count(F.lit(1)).alias("n"))
    kinds = place(place(kinds, F.col("id"), tree, "at"), F.col("id"), grown, "grown")
    order = md5_bits(F.lit("slot"), F.col("size").cast("string"), F.col("crc").cast("string"), F.col("id").cast("string"))
    kinds = kinds.withColumn("order", order).withColumn(
        "bucket", F.shiftright(F.shiftright("order", 21) * F.lit(buckets), 31).cast("int"))
    kinds = materialise(kinds.select("id", "size", "crc", "part", "n", "order", "bucket", F.col("at.shard").alias("shard"),
                                     F.col("at.region").alias("region"), F.col("at.rack").alias("rack"),
                                     F.col("grown.shard").alias("grown_shard")), "shard-kinds")

    # n_shards * buckets rows: bounded by parameters, not by the data
    counts = kinds.groupBy("shard", "bucket").agg(F.sum("n").alias("m"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start"))
    within = (Window.partitionBy("shard", "bucket").orderBy("order", "id", "size", "crc", "part")
              .rowsBetween(Window.unboundedPreceding, -1))
    numbered = kinds.withColumn("first", F.coalesce(F.sum("n").over(within), F.lit(0)))
    numbered = numbered.join(F.broadcast(starts), ["shard", "bucket"]).withColumn("first", F.col("start") + F.col("first"))
    # counts above 1 are dealt out before they become rows again
    single, several = numbered.where("n = 1"), numbered.where("n > 1").repartition("order", "part")
    slots = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1))

    def out(df: DataFrame, slot: Column) -> DataFrame:
        return df.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("key").alias("law"),
                         F.col("shard").cast("int").alias("shard"), slot.alias("slot"),
                         F.col("grown_shard").cast("int").alias("grown_shard"), "region", "rack")

    return out(single, F.col("first")).unionByName(out(several, slots))
