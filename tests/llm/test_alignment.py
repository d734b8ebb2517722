import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from strata.llm import alignment as A

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def brute_groups(text, libraries):
    """Token groups, cut where both sides end, from the two libraries alone."""
    if not text:
        return None
    a = libraries[0].encode(" " + text, add_special_tokens=False).ids
    b = libraries[1].encode(text)
    sides = A.load_sides(BYTES, PIECES)
    data = (" " + text).encode()
    ends = []
    for ids, side in ((a, sides[0]), (b, sides[1])):
        if b"".join(side.bytes[i] for i in ids) != data:
            return None
        ends.append(np.cumsum([len(side.bytes[i]) for i in ids]).tolist())
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        x, y = i, j
        while i < len(a) and ends[0][i] <= cut:
            i += 1
        while j < len(b) and ends[1][j] <= cut:
            j += 1
        groups.append((cut, a[x:i], b[y:j]))
    return groups


def brute(texts, libraries):
    aligned = [brute_groups(t, libraries) for t in texts]
    links = [collections.Counter((i, j) for _, a, b in g or [] for i in a for j in b) for g in aligned]
    count = collections.Counter(p for m in links for p in m)
    best = collections.Counter()
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for g, m in zip(aligned, links):
        if g is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        line = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for _, a, b in g)
        out.append((sum(len(a) for _, a, _ in g), sum(len(b) for _, _, b in g), len(g), sum(m.values()),
                    sum(c for p, c in m.items() if count[p] == best[p[0]]), sum(c * count[p] for p, c in m.items()),
                    hashlib.sha256(line.encode()).hexdigest()))
    return out


EXTRA = ["<|endoftext|> <s></s><unk> plain", "▁ already", "double  space", " lead", "trail ", "日本語のテキスト", "😀😀‍",
         "ﬁ ligature", "é combining é", "\x00\x01", "a b", "ab" * 3000, "The quick brown fox's 12345"]


@pytest.mark.parametrize("hot_pairs", [A.HOT_PAIRS, 40, 0])
def test_matches_the_libraries(spark, odd_docs, texts, libraries, hot_pairs):
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(EXTRA)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(extra)
    rows = [r["text"] for r in docs.collect()]
    got = collections.Counter((r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"])
                              for r in A.align(docs, BYTES, PIECES, hot_pairs=hot_pairs).collect())
    assert got == collections.Counter(brute(rows, libraries))


def test_groups(spark, docs, texts, libraries):
    out = A.token_groups(docs, BYTES, PIECES)
    for r in out.collect():
        want = brute_groups(texts[r["doc_id"]], libraries) or []
        assert [(g["end"], g["a"], g["b"]) for g in r["groups"]] == want


def test_empty_table(spark, no_docs):
    assert A.align(no_docs, BYTES, PIECES).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_pointer_jumping_finds_the_common_ends(seed):
    rng = random.Random(seed)
    n = rng.choice([1, 50, 5000])
    a, b = (sorted({n, *rng.sample(range(1, n + 1), rng.randint(1, n) // rng.choice([1, 30]) or 1)}) for _ in range(2))
    last = A.last_tokens(np.asarray(a), np.asarray(b))
    common = sorted(set(a) & set(b))
    for end, label in zip([*a, *b], last):
        assert b[label - len(a)] == next(c for c in common if c >= end)


def test_wide_groups_are_paired_by_distinct_ids(monkeypatch, texts):
    whole = [t for t in texts if t] + EXTRA
    plain = A.Aligned(whole, BYTES, PIECES).pairs()
    monkeypatch.setattr(A, "OUTER_PAIRS", 1)
    for x, y in zip(plain, A.Aligned(whole, BYTES, PIECES).pairs()):
        assert np.array_equal(x, y)
