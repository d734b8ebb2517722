import itertools
import re

import numpy as np
from pyspark.sql import functions as F

from strata.llm import quality_crf as Q

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines, seen, dups = text.split("\n"), set(), 0
    for line in lines:
        if WORDS.search(line):
            dups += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def test_statistics_match_brute_force(docs, texts):
    rows = {r["doc_id"]: r for r in Q.judge_documents(docs, Q.DEFAULT_WEIGHTS, Q.DEFAULT_TRANSITIONS).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        got = tuple(rows[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == brute(text), text
        assert not (rows[i]["kept"] and rows[i]["base_failed"])


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 8):
        scores, transitions = rng.normal(size=(n, 2)), rng.normal(size=(2, 2))

        def total(path):
            return sum(scores[k, y] for k, y in enumerate(path)) + sum(transitions[a, b] for a, b in itertools.pairwise(path))

        best = max(itertools.product((0, 1), repeat=n), key=total)
        assert tuple(Q.viterbi(scores, transitions)) == best


def test_training_separates_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    field = Q.fit_field(docs, labels, train_docs=150)
    judged = Q.judge_documents(docs.join(labels.select("doc_id", "quality"), "doc_id"), *field)
    rows = judged.join(labels.select("doc_id", "quality"), "doc_id").select("quality", "kept", "base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) > 0.98 * len(good) and sum(bad) < 0.3 * len(bad)


def test_keep_good_passes_rows_through(odd_docs, no_docs):
    field = Q.DEFAULT_WEIGHTS, Q.DEFAULT_TRANSITIONS
    kept = Q.keep_good(odd_docs, *field)
    verdict = [r["kept"] for r in Q.judge_documents(odd_docs, *field).collect()]
    assert kept.columns == odd_docs.columns and kept.count() == sum(verdict)
    assert Q.keep_good(no_docs, *field).count() == 0 and Q.judge_documents(no_docs, *field).count() == 0


def test_without_labels_defaults_are_used(docs, spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    weights, transitions = Q.fit_field(docs, empty)
    assert weights is Q.DEFAULT_WEIGHTS and transitions is Q.DEFAULT_TRANSITIONS


def _labelled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    rows = docs.join(labels, "doc_id").orderBy(F.xxhash64("doc_id")).collect()
    return [r["text"] for r in rows if r["quality"] == 1], [r["text"] for r in rows if r["quality"] == 0]


def _lines(text):
    return [x for x in text.encode().split(b"\n") if x.split()]


def test_a_spliced_block_is_cut_out_of_held_out_documents(spark):
    good, bad = _labelled(spark)
    weights, transitions = Q.train([(t, 1) for t in good[:300]] + [(t, 0) for t in bad[:300]])
    rng = np.random.default_rng(3)
    # blocks of held-out bad documents, their plain lines left out
    blocks = [[x for x in _lines(t) if Q._share(x, Q.SYMBOLS) > 0.05 or Q._share(x, Q._UPPER) > 0.4
               or 2 * len(set(x.split())) < len(x.split())][:6] for t in bad[300:]]
    blocks = [b for b in blocks if b]
    right = total = cut = tried = 0
    for text in good[300:900]:
        lines = _lines(text)
        if len(lines) < 4:
            continue
        block, at = blocks[rng.integers(len(blocks))], int(rng.integers(len(lines) + 1))
        mixed, want = Q.splice(lines, np.zeros(len(lines), int), block, at)
        got = np.asarray(Q.viterbi(np.asarray(Q.text_lines(b"\n".join(mixed))[0]) @ weights, transitions))
        on = np.flatnonzero(got == Q.BOILERPLATE)
        right, total, tried = right + (got == want).sum(), total + len(want), tried + 1
        cut += len(on) > 0 and abs(on[0] - at) <= 1 and abs(on[-1] - (at + len(block) - 1)) <= 1
    assert tried > 300 and right >= 0.95 * total and cut >= 0.9 * tried
    # bad documents have lines of either kind
    judged = [Q.judge_text(t, weights, transitions) for t in bad[300:]]
    assert sum(0 < j[8] < j[7] for j in judged) > 0.3 * len(judged)


def test_line_labels_keep_to_the_document():
    x = np.zeros((4, len(Q.FEATURES)))
    x[:, 0] = 1
    weights, counts = np.zeros((len(Q.FEATURES), 2)), np.asarray([5, 5, 5, 5])
    weights[0] = [0, 1]                                     # every line leans to boilerplate
    assert Q.line_labels(x, counts, 0, weights).tolist() == [1, 1, 1, 1]
    assert Q.line_labels(x, counts, 1, weights).sum() == 1
    assert Q.line_labels(x, counts, 0, -weights).sum() == 2 and Q.line_labels(x, counts, 1, -weights).sum() == 0
