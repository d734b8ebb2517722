"""Quality rules by line labelling with a linear-chain conditional random field.

The lines of a text (split at ``\\n``, those without a word left out) are
labelled content or boilerplate by Viterbi decoding; the share of words in
content lines decides.  Word and repetition statistics (fixed rules) come on
top: a text that fails them goes whatever its lines say.

The field has line features (symbols, capitals, digits, repetition, sentence
ends ...) and label-to-label weights.  It is trained here on a bounded sample of
labelled documents (``train_docs`` of either label, the smallest by a hash of the
id).  Only whole documents are labelled, so line labels come in two steps:

1. line weights alone are fitted, at first with every line labelled as its
   document; lines are then labelled again by these weights, a bad document
   keeping boilerplate for half its words at least and a good one content for
   two thirds, and the weights are fitted again;
2. the field is fitted by stochastic gradient steps on the log-likelihood of
   these sequences and of good documents into which a block of boilerplate lines
   of bad ones is spliced, so that labels change within a training sequence and
   the label-to-label weights say how often.

Without labelled documents fixed default weights are used.

Defined cases: a NULL or empty text has no words and fails the base rules;
repeated rows give repeated rows; texts of any length are read whole; an empty
table gives an empty result; other columns are not looked at (``keep_good``
passes them through, whatever they are called).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_slices

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
MIN_CONTENT_SHARE = 0.4
TRAIN_DOCS = 400
TRAIN_EPOCHS = 6

CONTENT, BOILERPLATE = 0, 1
FEATURES = ("bias", "symbols", "capitals", "digits", "exclamations", "bars", "seen_before",
            "repeated_words", "one_word", "ends_sentence", "long_words")
# Used when no labelled documents are at hand: [content, boilerplate] per feature.
DEFAULT_WEIGHTS = np.array([[1.0, -1.0], [-6.0, 6.0], [-4.0, 4.0], [-2.0, 2.0], [-4.0, 4.0], [-4.0, 4.0],
                            [-2.0, 2.0], [-3.0, 3.0], [-0.5, 0.5], [1.0, -1.0], [-1.0, 1.0]])
DEFAULT_TRANSITIONS = np.array([[0.5, -0.5], [-0.5, 0.5]])

_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"


def _share(line: bytes, chars: bytes) -> float:
    return (len(line) - len(line.translate(None, chars))) / len(line)


def line_features(line: bytes, words: list[bytes], seen: bool) -> list[float]:
    n = len(words)
    return [1.0, min(1.0, 5 * _share(line, SYMBOLS)), _share(line, _UPPER), _share(line, _DIGITS),
            min(1.0, 5 * _share(line, b"!")), min(1.0, 5 * _share(line, b"|")), float(seen),
            1.0 - len(set(words)) / n if n > 3 else 0.0, float(n < 3),
            float(words[-1][-1:] in (b".", b"?", b"!", b":", b'"')), min(1.0, len(line) / n / 40)]


def text_lines(data: bytes) -> tuple[list[list[float]], list[int], int]:
    """Features and word counts of the lines with a word; duplicate lines."""
    features, counts, seen, repeats = [], [], set(), 0
    for line in data.split(b"\n"):
        words = line.split()
        if not words:
            continue
        again = line in seen
        repeats += again
        seen.add(line)
        features.append(line_features(line, words, again))
        counts.append(len(words))
    return features, counts, repeats


def viterbi(scores: np.ndarray, transitions: np.ndarray) -> list[int]:
    """Best label sequence for line scores (lines x 2); ties go to content."""
    (cc, cb), (bc, bb) = transitions.tolist()
    rows = scores.tolist()
    a, b = rows[0]
    back = []
    for x, y in rows[1:]:
        from_a, from_b = a + cc >= b + bc, a + cb >= b + bb
        a, b = (a + cc if from_a else b + bc) + x, (a + cb if from_b else b + bb) + y
        back.append((CONTENT if from_a else BOILERPLATE, CONTENT if from_b else BOILERPLATE))
    label = CONTENT if a >= b else BOILERPLATE
    path = [label]
    for step in reversed(back):
        label = step[label]
        path.append(label)
    return path[::-1]


def repeated_window_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more."""
    n = len(words)
    if n <= window:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint64, n)
    if len(known) == n:
        return 0
    m = n - window + 1
    code = np.zeros(m, np.uint64)
    for j in range(window):
        code = code * np.uint64(0x9E3779B97F4A7C15) + ids[j:j + m] + np.uint64(1)
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    if not same.any():
        return 0
    # equal codes are only candidates: compare the windows themselves
    hit = np.zeros(m, bool)
    members = np.zeros(m, bool)
    members[1:] |= same
    members[:-1] |= same
    groups: dict[bytes, int] = {}
    for i in np.sort(order[members]):
        key = ids[i:i + window].tobytes()
        first = groups.setdefault(key, int(i))
        if first != i:
            hit[first] = hit[i] = True
    edges = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def judge_text(text: str | None, weights: np.ndarray, transitions: np.ndarray,
               min_content_share: float = MIN_CONTENT_SHARE) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    n_lines, n_content_lines, content_share) of one text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    spaces = len(data) - len(data.translate(None, SPACES))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    repeat_words = repeated_window_words(words)
    features, counts, repeats = text_lines(data)
    base_failed = n < MIN_WORDS or 100 * repeat_words > MAX_REPEAT_PERCENT * n
    share, content = 0.0, 0
    if features:
        path = viterbi(np.asarray(features) @ weights, transitions)
        content = sum(1 for p in path if p == CONTENT)
        share = sum(c for c, p in zip(counts, path) if p == CONTENT) / sum(counts)
    kept = not base_failed and share >= min_content_share
    return (n, len(text) - spaces, symbols, repeats, repeat_words, base_failed, kept,
            len(features), content, share)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _fit(data: list[tuple[np.ndarray, np.ndarray]], epochs: int, rate: float, decay: float, rng: np.random.Generator,
         chained: bool) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions from (features, labels) of lines by gradient steps
    on the mean log-likelihood per line, one sequence a step, averaged over the
    last half of the steps; transitions stay 0 unless ``chained``."""
    w, t = np.zeros((len(FEATURES), 2)), np.zeros((2, 2))
    mean_w, mean_t, taken = np.zeros_like(w), np.zeros_like(t), 0
    for epoch in range(epochs):
        step = rate / (1 + epoch)
        for i in rng.permutation(len(data)):
            x, y = data[i]
            n = len(x)
            scores = x @ w
            alpha, beta = np.empty((n, 2)), np.zeros((n, 2))
            alpha[0] = scores[0]
            if not chained:
                alpha = scores
                unary = np.exp(scores - _log_sum(scores, 1)[:, None])
            else:
                for k in range(1, n):
                    alpha[k] = scores[k] + _log_sum(alpha[k - 1][:, None] + t, 0)
                for k in range(n - 2, -1, -1):
                    beta[k] = _log_sum(t + (scores[k + 1] + beta[k + 1])[None, :], 1)
                total = _log_sum(alpha[-1], 0)
                unary = np.exp(alpha + beta - total)
            gold = np.zeros((n, 2))
            gold[np.arange(n), y] = 1
            w += step * (x.T @ (gold - unary) / n - decay * w)
            if chained and n > 1:
                pairs = np.exp(alpha[:-1, :, None] + t[None] + (scores[1:] + beta[1:])[:, None, :] - total)
                want = np.zeros((2, 2))
                np.add.at(want, (y[:-1], y[1:]), 1)
                t += step * ((want - pairs.sum(0)) / n - decay * t)
            if 2 * epoch >= epochs:
                taken += 1
                mean_w += (w - mean_w) / taken
                mean_t += (t - mean_t) / taken
    return mean_w, mean_t


def line_labels(features: np.ndarray, counts: np.ndarray, quality: int, weights: np.ndarray) -> np.ndarray:
    """Labels of a document's lines by line weights, within what its own label
    allows: half the words of a bad document are boilerplate at least, a third of
    a good one's at most."""
    scores = features @ weights
    lean = scores[:, BOILERPLATE] - scores[:, CONTENT]
    order = np.argsort(-lean, kind="stable")
    before = np.cumsum(counts[order]) - counts[order]
    labels = np.full(len(lean), CONTENT)
    if quality:
        labels[order[(lean[order] > 0) & (before + counts[order] <= counts.sum() / 3)]] = BOILERPLATE
    else:
        labels[order[(lean[order] > 0) | (before < counts.sum() / 2)]] = BOILERPLATE
    return labels


def splice(lines: list[bytes], labels: np.ndarray, block: list[bytes], at: int) -> tuple[list[bytes], np.ndarray]:
    """``block``, as boilerplate, before line ``at``."""
    return lines[:at] + block + lines[at:], np.concatenate([labels[:at], np.full(len(block), BOILERPLATE), labels[at:]])


def train(samples: list[tuple[str, int]], epochs: int = TRAIN_EPOCHS, rate: float = 0.3,
          decay: float = 1e-3, seed: int = 7, rounds: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions from (text, quality) pairs."""
    docs = []
    for text, quality in samples:
        lines = [x for x in (text or "").encode("utf-8", "surrogatepass").split(b"\n") if x.split()]
        if lines:
            features, counts, _ = text_lines(b"\n".join(lines))
            docs.append((lines, np.asarray(features), np.asarray(counts), int(bool(quality))))
    if len({q for *_, q in docs}) < 2:
        return DEFAULT_WEIGHTS, DEFAULT_TRANSITIONS
    rng = np.random.default_rng(seed)
    labels = [np.full(len(x), CONTENT if q else BOILERPLATE) for _, x, _, q in docs]
    for _ in range(rounds):
        weights, _ = _fit([(x, y) for (_, x, _, _), y in zip(docs, labels)], 2, rate, decay, rng, False)
        labels = [line_labels(x, counts, q, weights) for _, x, counts, q in docs]
    sequences = [(x, y) for (_, x, _, _), y in zip(docs, labels)]
    blocks = [[line for line, y in zip(lines, own) if y == BOILERPLATE] for (lines, _, _, q), own in zip(docs, labels) if not q]
    for (lines, _, _, quality), own in zip(docs, labels):
        if quality:
            block = blocks[rng.integers(len(blocks))]
            size = int(rng.integers(1, min(len(block), 8) + 1))
            first = int(rng.integers(len(block) - size + 1))
            mixed, y = splice(lines, own, block[first:first + size], int(rng.integers(len(lines) + 1)))
            sequences.append((np.asarray(text_lines(b"\n".join(mixed))[0]), y))
    return _fit(sequences, epochs, rate, decay, rng, True)


def fit_field(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, id_col: str = "doc_id",
              text_col: str = "text", max_chars: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Train on at most ``train_docs`` documents of either quality.  The sample
    is bounded by parameters (rows and characters), whatever the tables' size;
    documents over ``max_chars`` are left out of the sample (of it alone)."""
    chosen = None
    order = F.xxhash64(F.col(id_col).cast("string"))
    for quality in (0, 1):
        part = (labels.where(F.col("quality") == quality).select(id_col, "quality").distinct()
                .orderBy(order, id_col).limit(train_docs))
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = (docs.select(id_col, text_col).where(F.length(text_col) <= max_chars)
            .join(F.broadcast(chosen), id_col)          # 2 * train_docs rows
            .select(id_col, text_col, "quality").orderBy(id_col, text_col).limit(4 * train_docs).collect())
    return train([(r[1], r[2]) for r in rows])


STAT_FIELDS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
               ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
               ("kept", pa.bool_()), ("n_lines", pa.int64()), ("n_content_lines", pa.int64()),
               ("content_share", pa.float64())]
STAT_DDL = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "base_failed boolean, kept boolean, n_lines long, n_content_lines long, content_share double")


def judge_documents(docs: DataFrame, weights: np.ndarray, transitions: np.ndarray, id_col: str = "doc_id",
                    text_col: str = "text", min_content_share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """One row per document: id, statistics and verdict.  No shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            out = [judge_text(t, weights, transitions, min_content_share) for t in batch.column(1).to_pylist()]
            columns = [pa.array(c, kind) for c, (_, kind) in zip(zip(*out), STAT_FIELDS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, *(n for n, _ in STAT_FIELDS)])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, {STAT_DDL}")


def keep_good(docs: DataFrame, weights: np.ndarray, transitions: np.ndarray, text_col: str = "text",
              min_content_share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they are.  No shuffle."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            good = [judge_text(t, weights, transitions, min_content_share)[6]
                    for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
