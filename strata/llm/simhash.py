"""SimHash fingerprints and their neighbours in permuted block tables.

Every term (word, A-Z lower-cased) has a 64-bit hash and a weight (its length
up to ``MAX_WEIGHT``: long words say more than short ones).  Bit ``i`` of a
fingerprint is set if terms with that hash bit set hold more than half of the
text's total weight.  Votes are 32 sums of two 31-bit lanes each, so a text of
up to 2 ** 27 words of any length fits.  Terms are counted where the text is
read (partial aggregation), each row of the table by itself: copies are never
summed, however many there are.

Neighbours: the 64 bits are cut in ``m > radius`` blocks.  Two fingerprints
within ``radius`` bits agree in ``m - radius`` blocks at least, so a table per
choice of that many blocks, keyed by their values, finds every pair; candidates
are then compared in full and found in exactly one table (that of the first
blocks they share).  ``m`` grows with the number of fingerprints, so that keys
stay long enough to tell unlike ones apart; it changes the work, not the result.

Defined cases: a NULL text counts as empty; a text without words has the
fingerprint of 64 zero bits; repeated rows give repeated rows; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ascii_words, materialise

BITS = 64
MAX_WEIGHT = 16
RADIUS = 3
KEY_ROWS = 16                   # unlike fingerprints per key of a block table
MORE_BLOCKS = 4                 # blocks beyond the radius at most: 35 tables for a radius of 3
HOT_PARTS = 1024                # ranges of one id at most
_LANES = 0x100000001


def fingerprints(texts: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, fingerprint long): one row per ``key``, which must be unique.  Keys
    whose text has no word are left out."""
    terms = texts.select(key, F.explode(ascii_words(F.col(text_col))).alias("__term")).where(F.col("__term") != "")
    terms = terms.select(key, F.xxhash64("__term").alias("__h"),
                         F.least(F.length("__term"), F.lit(MAX_WEIGHT)).cast("long").alias("__w"))
    lanes = [F.sum(F.shiftrightunsigned("__h", i).bitwiseAND(F.lit(_LANES)) * F.col("__w")).alias(f"__v{i}")
             for i in range(BITS // 2)]
    votes = terms.groupBy(key).agg(F.sum("__w").alias("__total"), *lanes)
    value = F.lit(0).cast("long")
    for i in range(BITS // 2):
        low = F.col(f"__v{i}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"__v{i}", 32)
        for bit, count in ((i, low), (i + 32, high)):
            value = value.bitwiseOR(F.when(2 * count > F.col("__total"), F.shiftleft(F.lit(1).cast("long"), bit))
                                    .otherwise(F.lit(0).cast("long")))
    return votes.select(key, value.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 for opposite ones."""
    return 1 - F.bit_count(a.bitwiseXOR(b)).cast("double") / BITS


def block_count(n: int, radius: int = RADIUS) -> int:
    """Blocks for which a key of ``m - radius`` of them has, for each of its
    values, ``KEY_ROWS`` of ``n`` unlike fingerprints at most."""
    most = radius + MORE_BLOCKS
    return next((m for m in range(radius + 1, most) if (BITS // m) * (m - radius) + math.log2(KEY_ROWS) >= math.log2(max(n, 1))), most)


def near_fingerprints(queries: DataFrame, corpus: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """(fingerprint, near, distance) for all pairs of a query fingerprint and a
    corpus fingerprint within ``radius`` bits.  Both inputs hold a column
    ``fingerprint``; equal ones are looked up once."""
    if blocks is None:
        blocks = block_count(corpus.select(F.approx_count_distinct("fingerprint")).first()[0], radius)
    if not radius < blocks <= BITS:
        raise ValueError("more blocks than the radius are needed")
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    choices = list(itertools.combinations(range(blocks), blocks - radius))

    def masks(chosen: tuple[int, ...]) -> int:
        bits = sum((1 << edges[i + 1]) - (1 << edges[i]) for i in chosen)
        return bits - (1 << BITS) if bits >> (BITS - 1) else bits

    def tables(df: DataFrame, name: str) -> DataFrame:
        f = F.col("fingerprint")
        keys = F.array(*[F.struct(F.lit(sum(1 << i for i in c)).cast("long").alias("t"), f.bitwiseAND(F.lit(masks(c)).cast("long")).alias("v"))
                         for c in choices])
        return (df.select("fingerprint").where(f.isNotNull()).distinct()
                .select(f.alias(name), F.explode(keys).alias("k")).select(name, "k.t", "k.v"))

    pairs = tables(queries, "fingerprint").join(tables(corpus, "near"), ["t", "v"])
    differ = F.col("fingerprint").bitwiseXOR(F.col("near"))
    distance = F.bit_count(differ)
    near = pairs.where(distance <= radius).withColumn("distance", distance)
    return near.where(F.col("t") == _first_shared(differ, [masks((i,)) for i in range(blocks)], blocks - radius)).select(
        "fingerprint", "near", "distance")


def _first_shared(differ: Column, masks: list[int], need: int) -> Column:
    """Bits of the first ``need`` blocks in which nothing differs."""
    same = F.filter(F.array(*[F.when(differ.bitwiseAND(F.lit(m).cast("long")) == 0, F.lit(1 << i).cast("long"))
                              for i, m in enumerate(masks)]), lambda x: x.isNotNull())
    return F.aggregate(F.slice(same, 1, need), F.lit(0).cast("long"), lambda a, x: a + x)


def replace_tail(text: Column, other: Column) -> Column:
    """``text`` with its last third (code points) replaced by as many of ``other``."""
    size = F.length(text)
    cut = F.floor(size / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), size - cut), F.substring(other, F.lit(1), cut))


def with_edits(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, rid, next_rid, text, edited, edited_sha) per row; ``rid`` numbers the
    rows of ``docs``, a table scan.  ``edited`` takes
    its new tail from the next row in descending id order (ties: by a hash of
    the text, then by text); after the last row comes the first.

    Rows are dealt to ranges of ids cut at quantiles of their count; ids that
    fill a range alone, and rows without an id, are cut further by the hash of
    the text.  Within a range the next row is a window's lead, and the last row
    of a range takes the first of the following range from a table of one row
    per range."""
    spark = docs.sparkSession
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = docs.select(F.percentile_approx(id_col, [i / n for i in range(1, n)], 10_000).alias("q")).first()["q"] or []
    hot = sorted({q for q, r in zip(cuts, cuts[1:]) if q == r})      # fewer than the partitions, as the cuts
    cuts = sorted(set(cuts))
    parts, key, text = min(n, HOT_PARTS), F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    mark = F.shiftrightunsigned(F.xxhash64(text), 1)
    alone = key.isNull() | (key.isin(hot) if hot else F.lit(False))
    # descending: a hot id is the last of its range of ids, its own ranges follow the hash; NULL ids come last
    own = parts - 1 - F.shiftright(F.shiftright(mark, 32) * F.lit(parts), 31)
    number = 2 * F.coalesce(_bucket(key, cuts, 0, len(cuts)), F.lit(-1))
    bucket = F.when(alone, (number + 1) * parts + own).otherwise(number * parts).cast("long")
    rows = docs.select(key, text.alias("text"), mark.alias("mark"), bucket.alias("bucket"),
                       F.monotonically_increasing_id().alias("rid"))
    within = Window.partitionBy("bucket").orderBy(F.col(id_col).desc_nulls_last(), "mark", "text", "rid")
    rows = rows.withColumns({"next": F.lead("text").over(within), "next_rid": F.lead("rid").over(within),
                             "first": F.row_number().over(within) == 1})
    rows = rows.select(id_col, "rid", "next_rid", "text", "bucket", "first", F.col("next").isNull().alias("last"),
                       F.substring(F.col("next"), F.lit(1), F.floor(F.length("text") / 3).cast("int")).alias("tail"))
    rows = materialise(rows, "next-texts", "last")
    # one row per range: bounded by the partitions and HOT_PARTS
    ranges = rows.where("last").select("bucket")
    order = Window.orderBy(F.desc("bucket"))
    follow = ranges.select("bucket", F.coalesce(F.lead("bucket").over(order), F.max("bucket").over(Window.partitionBy()))
                           .alias("following"))
    heads = rows.where("first").select(F.col("bucket").alias("following"), F.col("text").alias("head"), F.col("rid").alias("head_rid"))
    ends = (rows.where("last").drop("next_rid", "tail").join(follow.join(heads, "following"), "bucket")
            .withColumnsRenamed({"head_rid": "next_rid", "head": "tail"}))
    columns = [id_col, "rid", "next_rid", "text", "tail"]
    both = rows.where(~F.col("last")).select(*columns).unionByName(ends.select(*columns))
    both = both.withColumn("edited", replace_tail(F.col("text"), F.col("tail")))
    return both.withColumn("edited_sha", F.sha2("edited", 256)).drop("tail")


def edit_likeness(docs: DataFrame, queries: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                  radius: int = RADIUS) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and how alike they
    are.  For rows where ``queries`` holds, ``n_near`` counts the other rows
    whose fingerprint is within ``radius`` bits (NULL elsewhere)."""
    edits = with_edits(docs, id_col, text_col)
    # a text and its edit have even and odd numbers
    texts = edits.select(F.explode(F.array(F.struct((2 * F.col("rid")).alias("no"), F.col("text").alias("text")),
                                           F.struct((2 * F.col("rid") + 1).alias("no"), F.col("edited").alias("text")))).alias("t"))
    prints = materialise(fingerprints(texts.select("t.no", "t.text"), "no", "text"), "fingerprints")
    rows = edits.select(id_col, F.length("text").cast("long").alias("n_chars"), "rid", "edited_sha", "next_rid")
    none = F.lit(0).cast("long")

    def own(odd: int, name: str) -> DataFrame:
        return prints.where(F.col("no") % 2 == odd).select(F.shiftright("no", 1).alias("rid"), F.col("fingerprint").alias(name))

    rows = rows.join(own(0, "own"), "rid", "left").join(own(1, "edited"), "rid", "left")
    rows = rows.join(own(0, "following").withColumnRenamed("rid", "next_rid"), "next_rid", "left")
    rows = materialise(rows.withColumns({c: F.coalesce(c, none) for c in ("own", "edited", "following")})
                       .drop("rid", "next_rid"), "likeness")

    def text(name: str) -> Column:
        return F.lpad(F.lower(F.hex(name)), 16, "0")

    out = rows.select(id_col, "n_chars", F.col("edited_sha").alias("edited_sha256"),
                      text("own").alias("fingerprint"), text("edited").alias("edited_fingerprint"),
                      likeness(F.col("own"), F.col("edited")).alias("near_edited"),
                      likeness(F.col("own"), F.col("following")).alias("near_next"), F.col("own").alias("__own"))
    if queries is None:
        return out.drop("__own")
    held = rows.groupBy(F.col("own").alias("near")).agg(F.count(F.lit(1)).alias("n"))
    wanted = rows.where(queries).select(F.col("own").alias("fingerprint"))
    found = (near_fingerprints(wanted, held.select(F.col("near").alias("fingerprint")), radius).join(held, "near")
             .groupBy(F.col("fingerprint").alias("__own")).agg((F.sum("n") - 1).alias("__n")))
    return (out.join(found, "__own", "left")
            .withColumn("n_near", F.when(queries, F.col("__n"))).drop("__own", "__n"))


def _bucket(value: Column, cuts: list, lo: int, hi: int) -> Column:
    """Number of ``cuts`` below ``value``, as a balanced tree of comparisons."""
    if lo == hi:
        return F.when(value.isNotNull(), F.lit(lo))
    mid = (lo + hi) // 2
    return F.when(value <= F.lit(cuts[mid]), _bucket(value, cuts, lo, mid)).otherwise(_bucket(value, cuts, mid + 1, hi))
