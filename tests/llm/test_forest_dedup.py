import itertools
import random

import pytest

from strata.llm import forest_dedup as D
from strata.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    """id -> (size, smallest id reachable)."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def check(df, rows):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in D.groups(df).collect()}
    assert got == brute(rows)


def test_groups_match_brute_force(docs, texts):
    check(docs, list(enumerate(texts)))


def test_a_star_of_many_near_copies(spark):
    """Copies that are near one text but mostly not near each other."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 250):
        w = list(base)
        for at in rng.sample(range(150), rng.randint(1, 5)):
            w[at] = rng.choice(words)
        rows.append((i, " ".join(w)))
    rows += [(i, " ".join(rng.choice(words) for _ in range(100))) for i in range(250, 300)]
    rows += [(300 + i, t) for i, (_, t) in enumerate(rows[:40])]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)


def centreless(n, seed=3):
    """Texts around 0.735 to each other, neighbours (2k, 2k + 1) at 0.766."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    template = [rng.choice(words) for _ in range(170)]
    rows = []
    for i in range(0, n, 2):
        shared = [rng.choice(words) for _ in range(4)]
        rows += [(i + j, " ".join(template + shared + [f"own{i + j}"] + [rng.choice(words) for _ in range(25)])) for j in (0, 1)]
    rng.shuffle(rows)
    return rows


def test_a_crowd_without_a_centre(spark):
    """No text is near enough to many others to be their hub."""
    rows = centreless(400)
    want = brute(rows)
    assert [want[i][1] for i in range(400)] == [i - i % 2 for i in range(400)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)


def test_crowd_links_in_small_blocks(spark):
    """Every pair of blocks meets, also where one component is the largest."""
    rows = centreless(60)
    hasher = D.ShingleHasher()
    # 0 .. 19 are one component already: only links outside it, or into it, are left
    sets = [(c, min(i, 1) if i < 20 else i, *(lambda x: (len(x), x.tobytes()))(hasher(t))) for i, t in rows for c in (1, 2)]
    table = spark.createDataFrame(sets, "crowd long, root long, n long, hashes binary").repartition(4)
    for docs, size in ((7, 1 << 20), (2048, 8000), (2048, 8 << 20)):
        links = {tuple(sorted((r["u"], r["v"]))) for r in D.crowd_links(table, 75, docs, size).collect()}
        assert links == {(0, 1)} | {(i, i + 1) for i in range(20, 60, 2)}


def test_keep_one_and_odd_tables(docs, odd_docs, no_docs, texts):
    kept = D.keep_one(docs)
    lead = {i for i, (_, root) in brute(list(enumerate(texts))).items() if i == root}
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == lead
    rows = D.groups(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert D.keep_one(odd_docs).where("doc_id is not null").select("doc_id").distinct().count() == len(lead)
    assert D.groups(no_docs).count() == 0 and D.keep_one(no_docs).count() == 0


def test_rows_without_an_id_go_by_their_own_text(spark, odd_docs):
    """odd_docs: a NULL id with the text of doc 3 goes, one without a text stays."""
    rows = D.keep_one(odd_docs).where("doc_id is null").collect()
    assert [r["text"] for r in rows] == [None]
    table = [(1, "a b c d e f g"), (None, "a b c d e f g"), (None, "A  b c d e f g"), (None, "one of a kind, no id"),
             (None, "twice without an id"), (None, "twice without an id"), (None, ""), (2, "some other text of that table")]
    kept = D.keep_one(spark.createDataFrame(table, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted((i or 0, t) for i, t in table[:1] + table[3:])


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(110)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for u, v in edges:
        if u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: find(i) for i in root}


def test_links_of_an_id_with_several_texts(spark):
    rng = random.Random(9)
    a, b = ([f"w{rng.randrange(5000)}" for _ in range(200)] for _ in range(2))
    near = [" ".join([*w[:-2], "x", "y"]) for w in (a, b)]
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near[0]), (3, near[1]), (4, "alone in the world it is"), (1, " ".join(a)),
            (5, "alone in the world it is"), (4, "another text of the id four here")]
    got = sorted({(r["doc_id"], r["component_id"], r["kept"]) for r in
                  D.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()})
    assert got == [(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 4, False)]
