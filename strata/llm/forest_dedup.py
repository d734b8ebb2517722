"""Near-duplicate documents by a MinHash LSH forest.

Documents are linked if their sets of five-word shingles have a Jaccard
similarity of 0.75 or more; components of links are groups of near copies.

1. *Signatures.*  128 minimum hashes per document.  Documents with equal sets
   are one class; only its smallest id goes on.
2. *Forest.*  32 orders of the signature: order ``t`` starts at value ``4 t`` and
   wraps around.  Documents sorted by an order are neighbours by their longest
   common prefix; a region is a maximal run with a common prefix of a given
   depth.  The depth adapts to the region: it starts at 4, where a pair at 0.75
   is missed by all orders with probability 6e-6, and grows only inside regions
   of more than ``region_size`` documents.  Regions are found by counting prefix
   keys and joining the counts back, so no task meets a whole region.
3. *Candidates.*  All pairs of a small region.  In a large one every document
   is paired with the region's hubs -- the members whose large regions hold the
   most documents, which are nearest to the text the others were copied from --
   and the region is split further.  The number of candidates stays linear.
4. *Confirmation* on the full shingle sets, in rounds: every document tries its
   best candidates (sharing the most regions) first, confirmed links join
   components, and candidates inside one component are dropped, as they cannot
   change it.  The last round tries all that is left.
5. *Crowds.*  Sub-regions and hubs may leave the members of a split region of
   depth 4 in several components.  Such regions that overlap make a crowd, and
   in a crowd every pair across components is judged, in blocks of bounded size:
   by length, then by a lower bound of the sets' difference, then on the full
   sets.  A block gives only the links that join components in it.

So every pair that shares a region of depth 4 in some order is judged or lies in
one component already; a link is lost only if no order brings its two texts, or
texts that chain them, together.

Defined cases: a NULL or empty text has an empty set and is linked with nothing;
rows of one id are one document, whatever their texts: they stay or go
together, and its texts' groups are one; a NULL id is linked
only by equal sets, and stays if its whole class has no id; an empty table gives
an empty result; further columns are passed through by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import join_hot, materialise, text_slices
from strata.llm.components import components
from strata.llm.shingles import ShingleHasher

VALUES = 128
ORDERS = 32
FIRST_DEPTH = VALUES // ORDERS
DEPTHS = (4, 8, 16, 40, 128)
REGION_SIZE = 4
HUBS = 8
SIMILARITY_PERCENT = 75
TRIES = (3,)
BLOCK_DOCS, BLOCK_BYTES = 2048, 8 << 20      # of a crowd that are compared at a time

_RNG = np.random.default_rng(20240607)
_A = (_RNG.integers(0, 1 << 63, VALUES, dtype=np.uint64) << np.uint64(1) | np.uint64(1))[:, None]
_B = _RNG.integers(0, 1 << 63, VALUES, dtype=np.uint64)[:, None]


def minhash(hashes: np.ndarray) -> np.ndarray:
    """128 32-bit minimum hashes of a set of 64-bit hashes."""
    best = np.full(VALUES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for lo in range(0, len(hashes), 1024):
        np.minimum(best, (_A * hashes[None, lo:lo + 1024] + _B).min(axis=1), out=best)
    return (best >> np.uint64(32)).astype("<u4")


def _set_hash(hashes: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


def with_set_hash(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """``docs`` and the hash of each text's set, NULL for empty sets."""
    at, schema = docs.columns.index(text_col), docs.withColumn(name, F.lit(None).cast("binary")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher()
        for batch in text_slices(batches):
            sets = pa.array([_set_hash(hasher(text)) for text in batch.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, sets], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, n_shingles, set_hash, signature); the last two NULL for empty
    sets; ``mark`` tells texts of one id apart."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher()
        for batch in text_slices(batches):
            counts, classes, signs = [], [], []
            for text in batch.column(1).to_pylist():
                hashes = hasher(text)
                counts.append(len(hashes))
                classes.append(_set_hash(hashes))
                signs.append(minhash(hashes).tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(classes, pa.binary()),
                 pa.array(signs, pa.binary())], ["id", "mark", "n_shingles", "set_hash", "signature"])

    return docs.select(id_col, text_col, F.xxhash64(text_col).alias("mark")).mapInArrow(
        run, f"id {id_type}, mark long, n_shingles long, set_hash binary, signature binary")


def _prefix_key(values: np.ndarray, order: int, depth: int) -> np.ndarray:
    """Hash of the first ``depth`` values of an order, for rows of signatures."""
    key = np.full(len(values), np.uint64(order * 1000 + depth + 1))
    for j in range(depth):
        key = (key ^ values[:, (FIRST_DEPTH * order + j) % VALUES]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _regions(signed: DataFrame, depth: int, orders_col: str | None = None) -> DataFrame:
    """(key, ord, id): a row per order (all of them, or those in ``orders_col``)."""
    id_type = signed.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.stack([np.frombuffer(c.as_buffer(), "<u4") for c in batch.column(1)]).astype(np.uint64)
            wanted = None
            if orders_col:
                wanted = np.zeros((batch.num_rows, ORDERS), bool)
                for r, cell in enumerate(batch.column(2).to_pylist()):
                    wanted[r, cell] = True
            for order in range(ORDERS):
                rows = np.arange(batch.num_rows) if wanted is None else np.flatnonzero(wanted[:, order])
                if len(rows):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_prefix_key(values[rows], order, depth)),
                         pa.array(np.full(len(rows), order, np.int16)), batch.column(0).take(pa.array(rows))],
                        ["key", "ord", "id"])

    columns = ["id", "signature", *([orders_col] if orders_col else [])]
    return signed.select(*columns).mapInArrow(run, f"key long, ord short, id {id_type}")


def candidates(signed: DataFrame, region_size: int = REGION_SIZE) -> tuple[DataFrame, DataFrame]:
    """(child, parent, score): pairs worth a full comparison.  A child has a
    bounded number of them; a parent may have very many.  And (key, id): the
    members of the regions of the first depth that were split."""
    found, split, todo = None, None, signed
    for depth in DEPTHS:
        regions = _regions(todo, depth, None if todo is signed else "orders")
        sizes = regions.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        members = materialise(regions.join(sizes, "key"), "regions")
        small = (members.where(F.col("n") <= region_size).groupBy("key")
                 .agg(F.sort_array(F.collect_list("id")).alias("ids")))           # at most region_size ids
        pairs = F.flatten(F.transform("ids", lambda a, i: F.transform(
            F.slice("ids", i + 2, F.lit(region_size)), lambda b: F.struct(b.alias("child"), a.alias("parent")))))
        pairs = small.select(F.explode(pairs).alias("p")).select("p.child", "p.parent")
        large = members.where(F.col("n") > region_size)
        split = large.select("key", "id") if split is None else split
        # at most ORDERS entries; the sum is largest for the text that shares most with the crowd
        crowded = materialise(large.groupBy("id").agg(F.collect_list("ord").alias("orders"), F.sum("n").alias("s")), "crowded")
        score = crowded.select("id", "s")
        # the best of each of a few hash classes of the region: all by partial aggregation
        part = F.pmod(F.xxhash64("id"), F.lit(HUBS if depth == FIRST_DEPTH else 1))
        hubs = (large.join(score, "id").groupBy("key", part.alias("part"))
                .agg(F.max(F.struct("s", "id")).alias("h")).select("key", F.col("h.id").alias("parent")))
        stars = large.select("key", F.col("id").alias("child")).join(hubs, "key").where("child <> parent").select("child", "parent")
        level = pairs.unionByName(stars)
        found = level if found is None else found.unionByName(level)
        if crowded.isEmpty():
            break
        todo = signed.select("id", "signature").join(crowded.select("id", "orders"), "id")
    return found.groupBy("child", "parent").agg(F.count(F.lit(1)).alias("score")), split


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs`` (child, parent, ...) whose full sets are similar enough."""
    rest = [c for c in pairs.columns if c not in ("child", "parent")]
    children = texts.select(F.col("id").alias("child"), F.col("text").alias("a"))
    parents = texts.select(F.col("id").alias("parent"), F.col("text").alias("b"))
    both = pairs.join(children, "child").join(parents, "parent").select("child", "parent", *rest, "a", "b")
    at = len(rest) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, last, held = ShingleHasher(), None, None
        for batch in text_slices(batches):
            good = []
            for a, b in zip(batch.column(at).to_pylist(), batch.column(at + 1).to_pylist()):
                if b != last:
                    last, held = b, hasher(b)
                x = hasher(a)
                common = len(np.intersect1d(x, held, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(held) - common))
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns[:at], kept.schema.names[:at])

    schema = both.drop("a", "b").schema
    return both.mapInArrow(run, schema)


def crowd_members(split: DataFrame, roots: DataFrame) -> DataFrame:
    """(id, root, crowd): the members of split regions that hold several
    components; regions with a common member are one crowd."""
    rooted = materialise(split.join(roots.select(F.col("node").alias("id"), "root"), "id", "left")
                         .select("key", "id", F.coalesce("root", "id").alias("root")), "split-regions")
    mixed = (rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("id").alias("least"))
             .where("low <> high").select("key", "least"))
    held = materialise(rooted.join(mixed, "key"), "mixed-regions")
    crowds = components(held.select(F.col("id").alias("u"), F.col("least").alias("v")))
    return (held.select("id", "root").distinct()
            .join(crowds.select(F.col("node").alias("id"), F.col("root").alias("crowd")), "id"))


def _sets(members: DataFrame, texts: DataFrame) -> DataFrame:
    """``members`` with ``n`` and ``hashes``, the sorted set of the text."""
    rows = members.join(texts, "id").select("crowd", "root", "text")
    head = rows.drop("text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher()
        for batch in text_slices(batches):
            sets = [hasher(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(x) for x in sets], pa.int64()),
                 pa.array([x.tobytes() for x in sets], pa.binary())], ["crowd", "root", "n", "hashes"])

    return rows.mapInArrow(run, head.add("n", "long").add("hashes", "binary"))


def _parity(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """Per set, the parity of its members in each of ``bits`` classes: two sets
    differ in at least as many members as their parities differ in bits."""
    out = np.empty((len(sets), bits // 64), np.uint64)
    for row, x in zip(out, sets):
        odd = np.bincount((x & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
        row[:] = np.packbits(odd).view(np.uint64)
    return out


def block_links(left: list[np.ndarray], right: list[np.ndarray], names: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs (position in left, position in right) of links that join the
    components ``names`` (of left, then right; changed) with as few pairs as do."""
    counts = np.array([len(x) for x in right])
    top = max(max(len(x) for x in left), int(counts.max()))
    bits = 1 << min(15, max(10, (4 * top - 1).bit_length()))
    a, b, out = _parity(left, bits), _parity(right, bits), []
    mine = names[len(left):]
    for i, x in enumerate(left):
        fit = (100 * np.minimum(counts, len(x)) >= percent * np.maximum(counts, len(x))) & (mine != names[i])
        near = np.flatnonzero(fit)
        apart = np.bitwise_count(b[near] ^ a[i]).sum(axis=1, dtype=np.int64)
        near = near[(100 + percent) * apart <= (100 - percent) * (counts[near] + len(x))]
        for j in near:
            if mine[j] != names[i]:
                common = len(np.intersect1d(x, right[j], assume_unique=True))
                if 100 * common >= percent * (len(x) + len(right[j]) - common):
                    names[names == mine[j]] = names[i]
                    out.append((i, int(j)))
    return out


def crowd_links(sets: DataFrame, percent: int, block_docs: int = BLOCK_DOCS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(u, v): links between roots of one crowd, from all pairs of ``sets``
    (crowd, root, n, hashes) across roots.  A crowd is cut into blocks; those of
    its largest component are not compared with each other."""
    per = sets.groupBy("crowd", "root").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("size"))
    total = (per.groupBy("crowd").agg(F.max(F.struct("docs", "root", "size")).alias("main"),
                                      F.sum("docs").alias("docs"), F.sum("size").alias("size")))

    def blocks(docs, size):
        return F.greatest(F.lit(1), F.ceil(docs / block_docs), F.ceil(size * 8 / block_bytes)).cast("int")

    # blocks 0 .. rest - 1 hold the smaller components, rest .. last the largest one
    plan = total.select("crowd", F.col("main.root").alias("main"),
                        blocks(F.col("docs") - F.col("main.docs"), F.col("size") - F.col("main.size")).alias("rest"),
                        blocks(F.col("main.docs"), F.col("main.size")).alias("most"))
    spot, count = F.xxhash64("hashes"), F.col("rest") + F.col("most")
    own = F.when(F.col("root") == F.col("main"), F.col("rest") + F.pmod(spot, F.col("most"))).otherwise(F.pmod(spot, F.col("rest")))
    rows = sets.join(plan, "crowd").withColumn("own", own.cast("int")).withColumn("last", (count - 1).cast("int"))
    with_lower = F.transform(F.sequence(F.lit(0), F.least("own", F.col("rest") - 1)),
                             lambda x: F.struct(x.alias("a"), F.col("own").alias("b")))
    with_higher = F.when((F.col("own") < F.col("rest")) & (F.col("own") < F.col("last")), F.transform(
        F.sequence(F.col("own") + 1, F.col("last")), lambda x: F.struct(F.col("own").alias("a"), x.alias("b"))))
    meets = F.concat(with_lower, F.coalesce(with_higher, F.array().cast("array<struct<a:int,b:int>>")))
    rows = rows.select("crowd", "root", "hashes", "own", F.explode(meets).alias("m")).select(
        "crowd", "m.a", "m.b", "own", "root", "hashes")

    def run(table: pa.Table) -> pa.Table:
        own, sides = table.column("own").to_numpy(), []
        for block in (table.column("a")[0].as_py(), table.column("b")[0].as_py()):
            sides.append(np.flatnonzero(own == block))
        hashes, roots = table.column("hashes"), table.column("root").combine_chunks()
        found: list[tuple[int, int]] = []
        if len(sides[0]) and len(sides[1]):
            names = roots.dictionary_encode().indices.to_numpy()[np.concatenate(sides)]
            left, right = ([np.frombuffer(hashes[int(r)].as_buffer(), np.uint64) for r in side] for side in sides)
            found = block_links(left, right, names.copy(), percent)
        return pa.table({"u": roots.take(pa.array([sides[0][i] for i, _ in found], pa.int64())),
                         "v": roots.take(pa.array([sides[1][j] for _, j in found], pa.int64()))})

    kind = sets.schema["root"].dataType.simpleString()
    return rows.groupBy("crowd", "a", "b").applyInArrow(run, f"u {kind}, v {kind}")


def _joined(roots: DataFrame, moved: DataFrame) -> DataFrame:
    """``roots`` after the components ``moved`` (node, root) of its roots."""
    return materialise(
        roots.join(moved.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
        .select("node", F.coalesce("top", "root").alias("root"))
        .unionByName(moved.join(roots.select("node"), "node", "left_anti")), "roots")


def links(docs: DataFrame, reps: DataFrame, pairs: DataFrame, split: DataFrame, id_col: str, text_col: str,
          percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """(node, root) of the components that the confirmed candidates and the
    links across the components of a crowd make.  ``reps`` (id, doc, mark) says
    which row of ``docs`` holds a node's text."""
    open_ = materialise(pairs.withColumns({"cc": F.col("child"), "cp": F.col("parent")}), "candidates")
    nodes = open_.select(F.col("child").alias("id")).unionByName(open_.select(F.col("parent").alias("id"))).distinct()
    # only texts in some candidate pair are compared; one row per node.  The same join at every size: the
    # node list grows with the corpus, so broadcasting it where it happens to be small would tell nothing
    wanted = nodes.join(reps.select("id", "doc", "mark"), "id")
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("mark"))
    texts = materialise(rows.join(wanted.hint("shuffle_merge"), ["doc", "mark"])
                        .groupBy("id").agg(F.min("text").alias("text")), "candidate-texts")
    roots = None
    for tries in (*TRIES, None):
        if open_.isEmpty():
            break
        # a child's candidates are few: bounded by orders, depths and region size
        tried = open_
        if tries is not None:
            order = F.row_number().over(_by_child())
            open_ = open_.withColumn("r", order)
            tried = open_.where(F.col("r") <= tries).drop("r")
            later = open_.where(F.col("r") > tries).drop("r")
        else:
            later = open_.limit(0)
        good = materialise(_confirmed(tried, texts, percent).select(F.col("cc").alias("u"), F.col("cp").alias("v")), "confirmed")
        moved = materialise(components(good), "roots")
        roots = moved if roots is None else _joined(roots, moved)
        here, there = (moved.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("cc", "cp"))
        open_ = materialise(later.join(here, "cc", "left").join(there, "cp", "left")
                            .select("child", "parent", "score", F.coalesce("cc_root", "cc").alias("cc"),
                                    F.coalesce("cp_root", "cp").alias("cp")).where("cc <> cp"), "candidates")
    if roots is None:
        return nodes.select(F.col("id").alias("node"), F.col("id").alias("root")).limit(0)
    crowd = materialise(crowd_members(split, roots), "crowds")
    if crowd.isEmpty():
        return roots
    sets = materialise(_sets(crowd, texts), "crowd-sets")          # a member of a split region has a hub
    return _joined(roots, materialise(components(materialise(crowd_links(sets, percent), "crowd-links")), "roots"))


def _by_child():
    from pyspark.sql import Window

    return Window.partitionBy("child").orderBy(F.desc("score"), "parent")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept."""
    return _judged(docs, id_col, text_col, percent).select(F.col("id").alias(id_col), "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(id, set_hash, n_shingles, component_id, kept), a row per row of ``docs``."""
    signed = materialise(signatures(docs, id_col, text_col), "signatures")
    # nodes are classes of equal sets, named by a hash: one id may hold several
    node = F.xxhash64("set_hash")
    held = F.when(F.col("id").isNotNull(), F.struct(F.col("id").alias("doc"), "mark"))
    classes = (signed.where("set_hash is not null").groupBy("set_hash")
               .agg(F.min(held).alias("rep"), F.min_by("signature", held).alias("signature")))
    reps = materialise(classes.where("rep is not null").select("set_hash", node.alias("id"), "rep.doc", "rep.mark", "signature"),
                       "representatives")
    roots = links(docs, reps, *candidates(reps.select("id", "signature")), id_col, text_col, percent)
    # rows of one id are one document: its classes go together
    own = signed.where("id is not null and set_hash is not null").select("id", node.alias("node")).distinct()
    several = own.groupBy("id").agg(F.min("node").alias("u"), F.count(F.lit(1)).alias("n")).where("n > 1").select("id", "u")
    together = materialise(own.join(several, "id").where("u <> node").select("u", F.col("node").alias("v")).distinct(), "shared-ids")
    if not together.isEmpty():
        roots = materialise(components(together.unionByName(roots.select(F.col("node").alias("u"), F.col("root").alias("v")))), "roots")
    named = reps.select("set_hash", "doc", "id").join(roots, F.col("id") == F.col("node"), "left").select(
        "set_hash", "doc", F.coalesce("root", "id").alias("root"))
    least = named.groupBy("root").agg(F.min("doc").alias("component"))
    named = materialise(named.join(least, "root").select("set_hash", "component"), "named-classes")
    rows = signed.select("id", "n_shingles", "set_hash", F.pmod(F.xxhash64("id"), F.lit(4096)).alias("slot"))
    rows = join_hot(rows, named, ["set_hash"], "slot")
    component = F.when(F.col("set_hash").isNull(), F.col("id")).otherwise(F.col("component"))
    return (rows.select("id", "set_hash", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """The rows of ``docs`` whose id leads its group, all columns as they are;
    of the rows without an id, those whose text is in no group that has one."""
    gone = materialise(_judged(docs, id_col, text_col, percent).where(~F.col("kept"))
                       .select("id", F.when(F.col("id").isNull(), F.col("set_hash")).alias("__gone_set")).distinct(), "near-copies")
    ids = gone.where("id is not null").select(F.col("id").alias("__gone"))
    named = docs.where(docs[id_col].isNotNull())
    named = named.join(ids, named[id_col] == ids["__gone"], "left_anti")
    # rows without an id are no document in common: each goes or stays by its own text
    unnamed = with_set_hash(docs.where(docs[id_col].isNull()), text_col, "__set")
    sets = gone.where("id is null").select("__gone_set")
    unnamed = unnamed.join(sets, unnamed["__set"] == sets["__gone_set"], "left_anti").select(*docs.columns)
    return named.unionByName(unnamed)
