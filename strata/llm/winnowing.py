"""Benchmark decontamination by winnowing.

A text is a sequence of words (A-Z lower-cased, runs of ASCII letters, digits
and non-ASCII characters).  Of every ``WINDOW`` consecutive words the k-gram
with the smallest hash is kept as the window's fingerprint.  Equal windows have
equal fingerprints wherever they stand, so a shared span of ``WINDOW`` words or
more shares a fingerprint for certain.

1. Benchmark items give (fingerprint, window); a bit table of their
   fingerprints, of a fixed largest size, is broadcast.  It can only pass too
   much: with a benchmark of any size nothing is lost.
2. Documents are read once.  Windows whose fingerprint is in the bit table are
   kept (a row per document, with the positions), everything else ends there.
3. Fingerprints of both sides are joined and each hit is extended to its whole
   window, compared by a second, independent hash of all its words; windows
   that touch or overlap grow into maximal spans.

Items of fewer than ``WINDOW`` words (but not none) are one window of their own
length, filed under its hash; documents look up every window of the lengths
that occur (at most ``WINDOW - 1`` of them).

Equal texts are judged once, and their result is joined back with hot texts
dealt over several tasks; so are hot windows.  Words are compared by hash: a
window counts as equal if two 64-bit hashes agree.

Defined cases: a NULL text has no words; repeated rows give repeated rows; a
NULL item id marks words, but is not listed; items are listed once however
often they are repeated; empty tables give no hits; further columns are not
looked at (``drop_contaminated`` passes them on, whatever they are called).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from strata.llm.common import bit_held, bit_table, join_hot, materialise, text_slices

WINDOW = 10
GRAM = 5
_REMEMBER = 200_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xD6E8FEB86659FD93)
_LETTERS = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _LETTERS else 32 for b in range(256))


class WordHashes:
    """64-bit hashes of the words of texts; remembers words (bounded)."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words in order, where each text starts; one more at the end)."""
        words: list[bytes] = []
        starts = [0]
        for text in texts:
            if text:
                words += text.encode("utf-8", "surrogatepass").translate(_TABLE).split()
            starts.append(len(words))
        if len(self.known) > _REMEMBER:
            self.known = {}
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), np.asarray(starts, np.int64)


def gram_codes(hashes: np.ndarray, size: int, multiplier: np.uint64 = _MULTIPLIER) -> np.ndarray:
    """A hash of every run of ``size`` words; never 0."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    code = np.full(n, np.uint64(size))
    for j in range(size):
        code = code * multiplier + hashes[j:j + n]
    code ^= code >> np.uint64(31)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    code ^= code >> np.uint64(29)
    return np.maximum(code, np.uint64(1))


def window_starts(starts: np.ndarray, size: int) -> np.ndarray:
    """Positions at which ``size`` words of one text follow."""
    total = int(starts[-1])
    end = np.repeat(starts[1:], np.diff(starts))
    return np.flatnonzero(np.arange(total) + size <= end)


def winnow(hashes: np.ndarray, starts: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(position, fingerprint, hash of the window) of every full window."""
    at = window_starts(starts, window)
    if not len(at):
        return at, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    codes = gram_codes(hashes, gram)
    least, size, want = codes, 1, window - gram + 1
    while size < want:                                  # minima of ever longer runs of k-grams
        step = min(size, want - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    return at, least[at], gram_codes(hashes, window, _SECOND)[at]


def _windows(hashes: np.ndarray, starts: np.ndarray, shorter: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, position, fingerprint, hash) for full windows and the ``shorter`` lengths."""
    yield (WINDOW, *winnow(hashes, starts))
    for size in shorter:
        at = window_starts(starts, size)
        if len(at):
            yield size, at, gram_codes(hashes, size)[at], gram_codes(hashes, size, _SECOND)[at]


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item string, size int, fp long, win long), one row per window of an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHashes()
        for batch in text_slices(batches):
            hashes, starts = hasher(batch.column(1).to_pylist())
            counts = np.diff(starts)
            short = sorted({int(c) for c in counts if 0 < c < WINDOW})
            for size, at, fp, win in _windows(hashes, starts, short):
                row = np.searchsorted(starts, at, side="right") - 1
                if size < WINDOW:                       # only items that are this one window
                    whole = counts[row] == size
                    row, fp, win = row[whole], fp[whole], win[whole]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(np.full(len(row), size, np.int32)),
                     pa.array(fp.view(np.int64)), pa.array(win.view(np.int64))], ["item", "size", "fp", "win"])

    return (items.select(F.col(id_col).cast("string").alias("item"), text_col)
            .mapInArrow(run, "item string, size int, fp long, win long").distinct())


def marked_documents(docs: DataFrame, items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, slot, n_words, windows): the windows of a document whose
    fingerprint the bit table holds; ``key`` tells texts apart."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(bit_table(items, "fp"))    # size bounded above
    shorter = sorted(r["size"] for r in items.select("size").distinct().collect() if r["size"] < WINDOW)   # <= WINDOW rows
    id_type = docs.schema[id_col].dataType.simpleString()
    window_type = pa.struct([("at", pa.int32()), ("size", pa.int32()), ("fp", pa.int64()), ("win", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, row_no = WordHashes(), 0
        for batch in text_slices(batches):
            texts = batch.column(1).to_pylist()
            hashes, starts = hasher(texts)
            parts = []
            for size, at, fp, win in _windows(hashes, starts, shorter):
                hit = bit_held(table.value, fp)
                parts.append((at[hit], np.full(int(hit.sum()), size, np.int32), fp[hit], win[hit]))
            at, size, fp, win = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((size, at))
            at, size, fp, win = at[order], size[order], fp[order], win[order]
            row = np.searchsorted(starts, at, side="right") - 1
            offsets = np.searchsorted(row, np.arange(len(texts) + 1))
            values = pa.StructArray.from_arrays(
                [pa.array((at - starts[row]).astype(np.int32)), pa.array(size), pa.array(fp.view(np.int64)),
                 pa.array(win.view(np.int64))], fields=list(window_type))
            keys = [hashlib.blake2b((t or "").encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    if offsets[i] < offsets[i + 1] else None for i, t in enumerate(texts)]
            slots = np.arange(row_no, row_no + len(texts), dtype=np.int32) % 4096
            row_no += len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(slots), pa.array(np.diff(starts)),
                 pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)],
                [id_col, "key", "slot", "n_words", "windows"])

    ddl = (f"`{id_col}` {id_type}, key binary, slot int, n_words long, "
           "windows array<struct<at: int, size: int, fp: long, win: long>>")
    return docs.select(id_col, text_col).mapInArrow(run, ddl)


def _spans(hits: DataFrame) -> DataFrame:
    """(key, spans): windows (key, at, size) that touch or overlap, as maximal [start, end) spans."""
    by_place = Window.partitionBy("key").orderBy("at", "size")
    before = F.max(F.col("at") + F.col("size")).over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    opened = hits.withColumn("open", F.coalesce(F.col("at") > before, F.lit(True)).cast("int"))
    runs = opened.withColumn("run", F.sum("open").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    return (runs.groupBy("key", "run").agg(F.min("at").alias("start"), F.max(F.col("at") + F.col("size")).alias("end"))
            .groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")))


def find_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_words``, ``spans`` (array of [start, end)
    word positions covered by occurrences of item windows) and ``items`` (ids,
    as sorted strings, of the items with a window there)."""
    items = materialise(item_windows(benchmark, item_id_col, item_text_col), "item-windows")
    marked = materialise(marked_documents(docs, items, id_col, text_col), "marked-documents")
    texts = marked.where("key is not null").groupBy("key").agg(F.first("windows").alias("windows"))
    seen = texts.select("key", F.inline("windows")).withColumn("slot", F.pmod(F.xxhash64("key"), F.lit(4096)))
    held = items.select("size", "fp", "win").distinct().withColumn("held", F.lit(True))
    join = ["size", "fp", "win"]
    hits = materialise(join_hot(seen, held, join, "slot", "inner").select("key", "at", *join), "window-hits")
    named = items.where("item is not null")
    windows = hits.select("key", *join).distinct().withColumn("slot", F.pmod(F.xxhash64("key"), F.lit(4096)))
    listed = (join_hot(windows, named, join, "slot", "inner").select("key", "item").distinct()
              .groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("items")))
    found = _spans(hits).join(listed, "key", "left")
    rows = marked.drop("windows")
    none = [F.expr("cast(array() as array<struct<start: int, end: int>>)"), F.expr("cast(array() as array<string>)")]
    hit = join_hot(rows.where("key is not null"), found, ["key"], "slot")
    clean = rows.where("key is null").select(id_col, "n_words", none[0].alias("spans"), none[1].alias("items"))
    return (hit.select(id_col, "n_words", F.coalesce("spans", none[0]).alias("spans"), F.coalesce("items", none[1]).alias("items"))
            .unionByName(clean))


def covered(spans: Column) -> Column:
    """Number of words in ``spans``."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + (s["end"] - s["start"]).cast("long"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of :func:`find_overlaps`: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    out = find_overlaps(docs, benchmark)
    return out.select("doc_id", "n_words", covered(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a hit, all columns as they are.  Rows are
    told apart by a digest of their text, not by their id."""
    items = materialise(item_windows(benchmark, item_id_col, item_text_col), "item-windows")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"),
                         F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256).alias("digest"))
    marked = materialise(marked_documents(packed.select("digest", "text"), items, "digest", "text")
                         .where("key is not null").groupBy("digest").agg(F.first("windows").alias("windows")), "marked-texts")
    held = items.select("size", "fp", "win").distinct()
    seen = (marked.select("digest", F.inline("windows")).withColumn("slot", F.pmod(F.xxhash64("digest"), F.lit(4096))))
    gone = materialise(join_hot(seen, held, ["size", "fp", "win"], "slot", "inner").select("digest").distinct()
                       .withColumn("gone", F.lit(True)), "gone-texts")
    # a hash of the row, so that a task that runs again deals its rows alike
    plain = [F.col("row")[f.name] for f in docs.schema.fields if isinstance(f.dataType, AtomicType)]
    rows = packed.drop("text").withColumn("slot", F.pmod(F.xxhash64(*plain), F.lit(4096)))
    return join_hot(rows, gone, ["digest"], "slot").where("gone is null").select("row.*")
