import collections
import random
import re

import numpy as np
import pytest

from strata.llm import phrases as P

ORDER = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, min_count, top=P.TOP, cover=P.COVER_PERCENT, max_words=P.MAX_WORDS):
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for i in range(len(w)):
                for m in range(1, min(max_words, len(w) - i) + 1):
                    counts[lang][tuple(w[i:i + m])] += 1
    out = []
    for lang, c in counts.items():
        candidates = {g: a for g, a in c.items() if len(g) > 1 and a >= min_count}
        covered = {g[i:j] for g, a in candidates.items() for i in range(len(g)) for j in range(i + 2, len(g) + 1)
                   if j - i < len(g) and 100 * a >= cover * candidates[g[i:j]]}
        found = []
        for g, a in candidates.items():
            if g not in covered:
                score, k = min((1000 * a * total[lang] // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, total[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def check(df, rows, min_count, top=P.TOP, cover=P.COVER_PERCENT):
    out = P.collocations(df, min_count=min_count, top=top, cover_percent=cover)
    assert sorted(tuple(r[c] for c in ORDER) for r in out.collect()) == brute(rows, min_count, top, cover)


def made(seed, n=60):
    rng = random.Random(seed)
    vocab = ["w%d" % (i % 30) if i % 7 else "Ünï%d" % i for i in range(rng.choice([8, 60]))] + ["a\x00b", "<x>", "x" * 300]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(vocab) + rng.choice([" ", " ", " ", "\t", ", ", "\n", ". "]) for _ in range(rng.randint(0, 90)))
        rows.append((rng.choice(["en", "de", None, "und"]), text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = made(seed)
    check(spark.createDataFrame(rows, "lang string, text string").repartition(3), rows, 4)


def test_small_shards_blocks_and_ranges(spark, monkeypatch):
    """Shards, blocks and ranges of a few n-grams only."""
    rows = made(3, 80)
    sources = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    monkeypatch.setattr(P, "RANGE_GRAMS", 200)
    monkeypatch.setattr(P, "COMPOSE_GRAMS", 20)
    check(sources, rows, 3, top=25)


def test_ties_and_cover(spark):
    rows = [("en", f"alpha{i} beta{i} gamma{i}. " * 5) for i in range(40)] + [("en", "alpha1 beta1, beta1 gamma1")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    check(df, rows, 5, top=7)
    check(df, rows, 5, cover=60)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in odd_docs.select("lang", "text").collect()]
    check(odd_docs, rows, 5)
    assert P.collocations(no_docs).count() == 0


def test_transducers_hold_sum_and_compose():
    rng = random.Random(4)
    grams = collections.Counter(tuple(rng.choice([3, 5, 2 ** 63, 2 ** 64 - 1]) for _ in range(rng.randint(1, 4))) for _ in range(400))
    rows = list(grams.items()) + [((3, 5), 7), ((3, 5), 2 ** 40)]
    grams[3, 5] += 7 + 2 ** 40
    columns = [np.asarray([g[k] if k < len(g) else 0 for g, _ in rows], np.uint64) for k in range(4)]
    sizes, weights = np.asarray([len(g) for g, _ in rows]), np.asarray([w for _, w in rows])
    machine, tree = P.transducer_of(columns, sizes, weights)
    again = P.CountTransducer.load(machine.dump())
    cols, size, weight, order = again.to_levels().grams()
    listed = [(tuple(int(cols[k][i]) for k in range(size[i])), int(weight[i])) for i in order if weight[i]]
    assert listed == sorted(grams.items())
    asked = [*grams, (4,), (3, 4), (3, 3, 3, 4)]
    got = again.compose([np.asarray([g[k] if k < len(g) else 0 for g in asked], np.uint64) for k in range(4)],
                        np.asarray([len(g) for g in asked]))
    assert got.tolist() == [grams.get(g, 0) for g in asked]
    # equal states are stored once
    assert sum(len(level[0]) - 1 for level in machine.levels) <= 1 + sum(len(s) for s in tree.symbols[:-1])


def test_equal_states_are_shared():
    rows = [(a, 9, b) for a in range(1, 50) for b in (1, 2, 3)]
    columns = [np.asarray([r[k] for r in rows], np.uint64) for k in range(3)]
    machine, _ = P.transducer_of(columns, np.full(len(rows), 3), np.ones(len(rows), np.int64))
    assert [len(level[0]) - 1 for level in machine.levels] == [1, 1, 1]
    assert len(machine.levels[1][1]) == 1 and len(machine.levels[2][1]) == 3
