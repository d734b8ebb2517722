import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from strata.llm import suffix_dedup as S


def brute(texts):
    """Removed-byte masks of the texts."""
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(d[p:p + 400] for d in data for p in range(len(d) - 399))
    out = []
    for d in data:
        mask = bytearray(len(d))
        for p in range(len(d) - 399):
            if count[d[p:p + 400]] > 1:
                mask[p:p + 400] = b"\1" * 400
        out.append((d, bytes(mask)))
    return out


def check(df, texts_by_row):
    rows = collections.Counter()
    for r in S.remove_repeats(df).collect():
        rows[r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()] += 1
    want = collections.Counter()
    masks = brute([t for _, t in texts_by_row])
    for (i, _), (d, m) in zip(texts_by_row, masks):
        kept = bytes(b for b, gone in zip(d, m) if not gone)
        want[i, len(d), sum(m), sum(1 for x in m.split(b"\0") if x), hashlib.sha256(kept).hexdigest()] += 1
    assert rows == want


def made(seed):
    rng = random.Random(seed)
    alphabet = rng.choice(["ab", "abcdefghijklmnop ", "é a"])

    def rnd(n):
        return "".join(rng.choice(alphabet) for _ in range(n))

    base = [rnd(rng.randint(300, 1500)) for _ in range(4)]
    texts = []
    for _ in range(30):
        t = rnd(rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            b = rng.choice(base)
            s = rng.randrange(len(b))
            t += b[s:rng.choice([len(b), s + rng.randint(380, 430)])] + rnd(rng.randint(0, 100))
        texts.append(t)
    return texts


def test_fixture_matches_brute_force(docs, texts):
    check(docs, list(enumerate(texts)))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pieces_of_common_passages(spark, seed):
    rows = list(enumerate(made(seed)))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows)


@pytest.mark.parametrize("seed", [4, 5])
def test_large_groups_are_split_without_loss(spark, seed, monkeypatch):
    monkeypatch.setattr(S, "GROUP_LIMIT", 3)
    monkeypatch.setattr(S, "BUCKET_RECORDS", 8)
    rows = list(enumerate(made(seed)))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows)


def test_odd_and_empty_tables(odd_docs, no_docs):
    check(odd_docs, [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()])
    assert S.remove_repeats(no_docs).count() == 0


def test_loser_tree_merges_and_counts_prefixes():
    rng = random.Random(3)
    for k in (1, 2, 3, 7):
        runs, everything = [], []
        for r in range(k):
            part = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 30)))
            everything += part
            runs.append(S._Run(*S.encode_run(part), list(range(len(part)))))
        out = list(S.merge_runs(runs))
        assert [t for t, _, _ in out] == sorted(everything)
        last = b""
        for text, shared, _ in out:
            assert shared == S.common_prefix(last, text)
            last = text


def test_a_passage_in_more_texts_than_the_group_limit(spark):
    """The limit as it is: over ``GROUP_LIMIT`` texts around one passage, whole or cut."""
    rng = random.Random(11)

    def rnd(n):
        return "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))

    passage = rnd(547)
    texts = []
    for i in range(S.GROUP_LIMIT + 1100):
        part = passage if i % 3 else passage[rng.randint(0, 100):rng.randint(440, 547)]
        texts.append(rnd(rng.randint(0, 60)) + part + rnd(rng.randint(0, 60)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    check(df, list(enumerate(texts)))
