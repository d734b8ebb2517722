import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm import common
from strata.llm import winnowing as W

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items):
    """(n_words, hit positions, item ids) per text."""
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(W.WINDOW, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                key = tuple(w[i:i + size])
                if key in windows:
                    hit.update(range(i, i + size))
                    found |= windows[key]
        out.append((len(w), frozenset(hit), tuple(sorted(str(i) for i in found if i is not None))))
    return out


def check(spark, texts, items, docs=None):
    if docs is None:
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = collections.Counter()
    for r in W.find_overlaps(docs, bench).collect():
        hit = [i for a, b in r["spans"] for i in range(a, b)]
        assert len(hit) == len(set(hit))
        assert all(a[1] < b[0] for a, b in zip(r["spans"], r["spans"][1:])), "spans are maximal"
        got[r["n_words"], frozenset(hit), tuple(r["items"])] += 1
    assert got == collections.Counter(brute(texts, items))


def made(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(rng.choice([3, 40, 400]))]

    def prose(n):
        return [rng.choice(vocab) for _ in range(n)]

    items = [prose(rng.choice([4, 9, 10, 11, 30])) for _ in range(12)]
    texts = []
    for _ in range(40):
        t = prose(rng.randint(0, 40))
        for _ in range(rng.randint(0, 2)):
            part = rng.choice(items)
            lo = rng.randrange(len(part))
            t += part[lo:lo + rng.randint(5, 30)] + prose(rng.randint(0, 20))
        texts.append(rng.choice([" ", ", ", "-"]).join(t))
    texts += [texts[0]] * 5
    return texts, [(i, " ".join(t)) for i, t in enumerate(items)]


@pytest.mark.parametrize("seed", range(4))
def test_matches_brute_force(spark, seed):
    check(spark, *made(seed))


def test_odd_rows_and_items(spark, texts, odd_docs):
    rng = random.Random(1)
    whole = words(texts[0])
    items = [(1, " ".join(whole[5:40])), (1, " ".join(whole[5:40])), (2, None), (3, ""), (4, "!!"), (5, "one two three"),
             (None, " ".join(words(texts[1])[:12])), (6, "same words here same words here same words here same"),
             (10, "Äöü ß"), (7, " ".join(rng.choice(whole) for _ in range(10))), (8, "x" * 5000)]
    rows = [r["text"] for r in odd_docs.select("text").collect()]
    check(spark, rows, items, odd_docs)


def test_empty_tables(spark, docs, no_docs, texts):
    check(spark, texts, [], docs)
    assert W.find_overlaps(no_docs, spark.createDataFrame([(1, "a b c")], "item_id long, text string")).count() == 0


def test_every_shared_window_shares_a_fingerprint():
    rng = random.Random(3)
    hasher = W.WordHashes()
    shared = " ".join(rng.choice("abcdefg") for _ in range(W.WINDOW))
    for _ in range(200):
        a, b = (" ".join([*(rng.choice("abcdefg") for _ in range(rng.randint(0, 9))), shared,
                          *(rng.choice("abcdefg") for _ in range(rng.randint(0, 9)))]) for _ in range(2))
        one, two = (W.winnow(*hasher([t])) for t in (a, b))
        assert set(one[1].tolist()) & set(two[1].tolist())


def test_a_full_bit_table_loses_nothing(spark, monkeypatch):
    """With every bit set the joins alone decide."""
    monkeypatch.setattr(W, "bit_table", lambda items, column: ~W.np.zeros(1 << 10, W.np.uint64))
    check(spark, *made(1))


def test_hot_texts_and_windows_are_dealt_out(spark, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(14))
    texts = [passage + " the same"] * 1500 + [f"a{i} {passage} b{i}" for i in range(1500)]
    check(spark, texts, [(1, passage), (2, passage + " end")])
    rows = spark.createDataFrame([(1, i) for i in range(4000)] + [(2, 0)], "k int, slot int")
    out = common.join_hot(rows, spark.createDataFrame([(1, "x"), (3, "y")], "k int, v string"), ["k"], "slot")
    assert sorted((r["k"], r["n"]) for r in out.groupBy("k", "v").agg(F.count("*").alias("n")).collect()) == [(1, 4000), (2, 1)]


def test_drop_contaminated_keeps_columns(spark, docs, texts):
    bench = spark.createDataFrame([(1, " ".join(words(texts[0])[:20]))], "item_id long, text string")
    kept = W.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    gone = {i for i, (_, hit, _) in enumerate(brute(texts, [(1, " ".join(words(texts[0])[:20]))])) if hit}
    assert 0 in gone
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(len(texts)) if i not in gone]
