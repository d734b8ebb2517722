import collections
import hashlib
import itertools

import xxhash
from pyspark.sql import functions as F

from strata.llm import simhash as S


def edited_of(rows):
    """(id, text) rows -> edited texts, by the same order."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), xxhash.xxh64_intdigest(r[1].encode(), 42) >> 1, r[1]))
    out = []
    for i, (doc, text) in enumerate(order):
        other = order[(i + 1) % len(order)][1]
        k = len(text) // 3
        out.append((doc, text, text[:len(text) - k] + other[:k], other))
    return out


def check(spark, df):
    rows = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    want = edited_of(rows)
    texts = sorted({t for _, *ts in want for t in ts})
    words = spark.createDataFrame([(t, w) for t in texts for w in lower(t).encode().split() for w in [w.decode()]], "t string, w string")
    votes = {}
    for t, h, w in words.select("t", F.xxhash64("w"), F.least(F.length("w"), F.lit(16))).collect():
        v = votes.setdefault(t, [0] * 65)
        v[64] += w
        for i in range(64):
            v[i] += w * (h >> i & 1)
    prints = {t: sum(1 << i for i in range(64) if 2 * v[i] > v[64]) for t, v in votes.items()}

    def like(a, b):
        return 1 - bin(prints.get(a, 0) ^ prints.get(b, 0)).count("1") / 64

    want = sorted(((d, len(t), hashlib.sha256(e.encode()).hexdigest(), f"{prints.get(t, 0):016x}", f"{prints.get(e, 0):016x}", like(t, e), like(t, n))
                   for d, t, e, n in want), key=repr)
    got = S.edit_likeness(df).collect()
    assert sorted((tuple(r) for r in got), key=repr) == want


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def test_fingerprints_and_edits_match_brute_force(spark, docs):
    check(spark, docs)


def test_null_ids_and_repeated_rows(spark, odd_docs):
    check(spark, odd_docs)


def test_small_tables(spark, no_docs):
    assert S.edit_likeness(no_docs).count() == 0
    check(spark, spark.createDataFrame([(7, "only one row here")], "doc_id long, text string"))


def test_block_tables_find_every_pair_within_the_radius(spark):
    import random
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(12)]
    values = set(base)
    for b in base:
        for n in range(1, 6):
            for _ in range(4):
                v = b
                for bit in rng.sample(range(64), n):
                    v ^= 1 << bit
                values.add(v)
    values = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    for radius, blocks in ((0, None), (2, None), (3, None), (3, 4), (3, 5), (3, 6), (3, 7), (2, 5), (0, 2)):
        got = sorted((r["fingerprint"], r["near"], r["distance"]) for r in S.near_fingerprints(df, df, radius, blocks).collect())
        want = sorted((a, b, bin((a ^ b) & (1 << 64) - 1).count("1")) for a, b in itertools.product(values, values)
                      if bin((a ^ b) & (1 << 64) - 1).count("1") <= radius)
        assert got == want


def test_neighbour_counts(docs):
    rows = S.edit_likeness(docs, F.col("doc_id") % 4 == 0).collect()
    prints = [int(r["fingerprint"], 16) for r in rows]
    for r, p in zip(rows, prints):
        near = sum(bin(p ^ q).count("1") <= S.RADIUS for q in prints) - 1
        assert r["n_near"] == (near if r["doc_id"] % 4 == 0 else None)


def test_votes_of_very_many_copies_do_not_run_over(spark):
    """2 ** 31 votes in one lane, if copies were summed."""
    text = " ".join(["abcdefghijklmnopqrst"] * 4_000)
    copies = spark.range(36_000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text")).repartition(4)
    alone = spark.createDataFrame([(0, text)], "doc_id long, text string")
    (want,) = S.fingerprints(alone, "doc_id", "text").collect()
    assert {r["fingerprint"] for r in S.fingerprints(copies, "doc_id", "text").select("fingerprint").distinct().collect()} == {want["fingerprint"]}
    rows = S.edit_likeness(spark.createDataFrame([(i, "w v u " * 50) for i in range(500)], "doc_id long, text string")).collect()
    assert len(rows) == 500 and len({r["fingerprint"] for r in rows}) == 1 and all(r["near_next"] == 1.0 for r in rows)


def test_blocks_grow_with_the_corpus():
    assert [S.block_count(n) for n in (0, 1, 1 << 20, 1 << 24, 1 << 29, 10 ** 10, 10 ** 12)] == [4, 4, 4, 5, 6, 6, 7]


def test_hot_ids_match_brute_force_in_even_ranges(spark, monkeypatch):
    """A third without an id, a third of one id, the rest apart; texts repeat."""
    rows = [((None, 77, i)[i % 3], f"text {i % 50} with words {i % 7} and more of them {i}"[:20 + i % 30]) for i in range(360)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(spark, df)
    held = []
    monkeypatch.setattr(S, "materialise", lambda d, *a, f=S.materialise: held.append(f(d, *a)) or held[-1])
    S.with_edits(df, "doc_id", "text").count()
    sizes = collections.Counter(r["bucket"] for r in held[0].select("bucket").collect())
    assert sum(sizes.values()) == 360 and max(sizes.values()) < 360 / 5
