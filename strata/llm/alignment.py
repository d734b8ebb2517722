"""Alignment of two tokenizers over the same texts, by pointer jumping.

Tokens of either tokenizer cover the same bytes (a space and the text).  Every
token points to its farthest-right overlapping token: the other tokenizer's
token that holds its last byte.  A token whose end is also an end over there
closes a group.  Successors are doubled (``next = next[next]``) for all tokens
of many texts at once until nothing changes; then every token points to the
last token of its component, which labels its group.

Token ids of the two sides are linked where their tokens share a group.  A
pair's count is the number of documents that hold it linked:

1. texts are encoded and aligned once; each document keeps its distinct pairs
   with their multiplicity (written below the shared checkpoint folder);
2. pairs are counted over the corpus (partial aggregation, then by pair), and
   each id's highest count is taken from at most a vocabulary of rows;
3. the most frequent pairs, ``HOT_PAIRS`` at most, are broadcast and looked up
   in place.  Any others are joined by pair; none of those is frequent.

Groups of many tokens are paired by distinct ids, never token by token.

Defined cases: a NULL or empty text, or one whose bytes either tokenizer does
not give back (normalised, unknown characters), has no tokens, zero counts and
the digest ''; repeated rows count as documents of their own; texts of any
length are aligned whole; an empty table gives an empty result; further columns
are not looked at.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import join_hot, materialise, text_slices
from strata.llm.token_files import load_encoder

HOT_PAIRS = 1 << 20
OUTER_PAIRS = 256               # groups of more token pairs are paired by distinct ids
SLICE_BYTES = 1 << 19


class ByteSide:
    """A byte-level file of the tokenizers library; texts start with a space.
    Strings of special tokens are plain text."""

    def __init__(self, path: str):
        encoder = load_encoder(path)
        self.path, self.fast, self.size, self._slow = path, encoder.fast, encoder.size, None
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        alphabet = {chr(b): b for b in printable}
        alphabet.update({chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))})
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.bytes = [b""] * self.size
        for token, i in vocab.items():
            if all(c in alphabet for c in token):
                self.bytes[i] = bytes(alphabet[c] for c in token)

    def slow(self, text: str) -> list[int]:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
            self._slow.encode_special_tokens = True
        return self._slow.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._one(" " + t) for t in texts]

    def _one(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except (ValueError, RuntimeError):
                pass
        return np.asarray(self.slow(text), np.int64)


class PieceSide:
    """A sentencepiece model that puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(self.model.id_to_piece(list(range(self.size))))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


@lru_cache(maxsize=2)
def load_sides(path_a: str, path_b: str) -> tuple[ByteSide, PieceSide]:
    return ByteSide(path_a), PieceSide(path_b)


@lru_cache(maxsize=2)
def _tables(path_a: str, path_b: str) -> tuple[np.ndarray, ...]:
    """Byte lengths of either side's tokens; texts of ids before each separator."""
    a, b = load_sides(path_a, path_b)
    size = max(a.size, b.size)
    pieces = np.empty(3 * size, object)
    for k, sep in enumerate((b",", b"|", b";")):
        pieces[k * size:(k + 1) * size] = [str(i).encode() + sep for i in range(size)]
    return tuple(np.asarray([len(t) for t in s.bytes], np.int64) for s in (a, b)) + (pieces,)


def last_tokens(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For every token (all of A, then all of B) the last token of its
    component; ``ends`` are the byte offsets at which tokens end, ascending."""
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a - 1, side="right") + n          # B's token over A's last byte
    over_b = np.searchsorted(ends_a, ends_b - 1, side="right")              # A's token over B's last byte
    own = np.arange(n, n + len(ends_b))
    successor = np.concatenate([over_a, np.where(ends_a[over_b] > ends_b, over_b, own)])
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            return successor
        successor = further


class Aligned:
    """Token groups of a run of texts; ``rows`` tells which texts have tokens."""

    def __init__(self, texts: list[str | None], path_a: str, path_b: str):
        side_a, side_b = load_sides(path_a, path_b)
        length_a, length_b, self.pieces = _tables(path_a, path_b)
        held = [i for i, t in enumerate(texts) if t]
        whole = [texts[i] for i in held]
        self.rows, ids_a, ids_b = [], [], []
        for i, t, a, b in zip(held, whole, side_a.encode(whole), side_b.encode(whole)):
            data = b" " + t.encode("utf-8", "surrogatepass")
            if (b"".join(map(side_b.bytes.__getitem__, b.tolist())) == data
                    and b"".join(map(side_a.bytes.__getitem__, a.tolist())) == data):
                self.rows.append(i)
                ids_a.append(a)
                ids_b.append(b)
        self.n_a, self.n_b = (np.asarray([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        self.a, self.b = (np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64) for ids in (ids_a, ids_b))
        self.width = side_b.size
        ends_a, self.ends_b = np.cumsum(length_a[self.a]), np.cumsum(length_b[self.b])
        last = last_tokens(ends_a, self.ends_b) - len(self.a)
        self.closing = np.flatnonzero(last[len(self.a):] == np.arange(len(self.b)))    # B's last token of every group
        self.group = np.searchsorted(self.closing, last)
        total = len(self.closing)
        self.size_a = np.bincount(self.group[:len(self.a)], minlength=total)
        self.size_b = np.bincount(self.group[len(self.a):], minlength=total)
        self.start_a, self.start_b = (np.concatenate([[0], np.cumsum(s)]) for s in (self.size_a, self.size_b))
        # groups of each text: [first[i], first[i + 1])
        self.first = np.concatenate([[0], np.searchsorted(self.closing, np.cumsum(self.n_b) - 1, side="right")]).astype(np.int64)
        self.text_of = np.repeat(np.arange(len(self.rows)), np.diff(self.first))

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups, ``a1,a2|b1;a3|b2,b3``."""
        n_a, n_b, size = len(self.a), len(self.b), len(self.pieces) // 3
        ids = np.empty(n_a + n_b, np.int64)
        sep = np.zeros(n_a + n_b, np.int64)
        group_a, group_b = self.group[:n_a], self.group[n_a:]
        at_a = np.arange(n_a) + self.start_b[group_a]
        at_b = np.arange(n_b) + self.start_a[group_b + 1]
        ids[at_a], ids[at_b] = self.a, self.b
        sep[at_a[self.start_a[1:] - 1]], sep[at_b[self.start_b[1:] - 1]] = 1, 2
        parts = self.pieces[sep * size + ids].tolist()
        cuts = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)]).tolist()
        return [hashlib.sha256(b"".join(parts[lo:hi])[:-1]).hexdigest() for lo, hi in zip(cuts, cuts[1:])]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, multiplicity) of the distinct linked pairs, sorted."""
        product = self.size_a * self.size_b
        small = np.flatnonzero(product <= OUTER_PAIRS)
        times = product[small]
        group = np.repeat(small, times)
        local = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        wide = self.size_b[group]
        pair = self.a[self.start_a[group] + local // wide] * self.width + self.b[self.start_b[group] + local % wide]
        parts = [((self.text_of[group] << 40) | pair, np.ones(len(pair), np.int64))]
        for g in np.flatnonzero(product > OUTER_PAIRS):
            a, many_a = np.unique(self.a[self.start_a[g]:self.start_a[g + 1]], return_counts=True)
            b, many_b = np.unique(self.b[self.start_b[g]:self.start_b[g + 1]], return_counts=True)
            pair = (a[:, None] * self.width + b[None, :]).ravel()
            parts.append(((self.text_of[g] << 40) | pair, (many_a[:, None] * many_b[None, :]).ravel()))
        packed, many = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(packed, kind="stable")
        packed, many = packed[order], many[order]
        heads = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]])) if len(packed) else np.zeros(0, np.int64)
        total = np.add.reduceat(many, heads) if len(heads) else many
        return packed[heads] >> 40, packed[heads] & ((1 << 40) - 1), total


def token_groups(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, groups): per document its token groups in order -- the byte offset
    (in a space and the text) at which each ends, and the ids of either side."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, SLICE_BYTES):
            texts = batch.column(1).to_pylist()
            al = Aligned(texts, path_a, path_b)
            of_row = {r: k for k, r in enumerate(al.rows)}
            ends = al.ends_b[al.closing] - np.concatenate([[0], al.ends_b[np.cumsum(al.n_b) - 1]])[al.text_of]
            groups = pa.StructArray.from_arrays(
                [pa.array(ends), pa.ListArray.from_arrays(pa.array(al.start_a, pa.int32()), pa.array(al.a, pa.int32())),
                 pa.ListArray.from_arrays(pa.array(al.start_b, pa.int32()), pa.array(al.b, pa.int32()))], ["end", "a", "b"])
            sizes = [int(al.first[of_row[i] + 1] - al.first[of_row[i]]) if i in of_row else 0 for i in range(len(texts))]
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, groups)], [id_col, "groups"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type}, groups array<struct<end: long, a: array<int>, b: array<int>>>")


def linked_pairs(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, slot, n_a, n_b, n_groups, n_links, groups_sha256, pairs, many):
    sizes of a document's alignment and its distinct pairs (A id times B's
    vocabulary plus B id); ``key`` tells texts apart."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "key", "slot", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "many"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_no = 0
        for batch in text_slices(batches, SLICE_BYTES):
            texts = batch.column(1).to_pylist()
            al = Aligned(texts, path_a, path_b)
            rows, n = np.asarray(al.rows, np.int64), len(texts)
            sizes = np.zeros((4, n), np.int64)
            sizes[:3, rows] = al.n_a, al.n_b, np.diff(al.first)
            links = np.concatenate([[0], np.cumsum(al.size_a * al.size_b)])
            sizes[3, rows] = links[al.first[1:]] - links[al.first[:-1]]
            digests = [""] * n
            keys: list[bytes | None] = [None] * n
            for r, digest in zip(al.rows, al.digests()):
                digests[r] = digest
                keys[r] = hashlib.blake2b(texts[r].encode("utf-8", "surrogatepass"), digest_size=16).digest()
            text, pair, many = al.pairs()
            offsets = pa.array(np.searchsorted(rows[text], np.arange(n + 1)).astype(np.int32))
            slots = np.arange(row_no, row_no + n, dtype=np.int32) % 4096
            row_no += n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(slots), *(pa.array(s) for s in sizes), pa.array(digests),
                 pa.ListArray.from_arrays(offsets, pa.array(pair)), pa.ListArray.from_arrays(offsets, pa.array(many))], names)

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type}, key binary, slot int, n_a long, n_b long, n_groups long, n_links long, "
             "groups_sha256 string, pairs array<long>, many array<long>")


def pair_counts(linked: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): in how many documents a pair is linked, and whether that
    is its A id's highest count."""
    counts = materialise(linked.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")),
                         "pair-counts")
    a = F.floor(F.col("pair") / F.lit(width)).cast("long")
    top = counts.groupBy(a.alias("a")).agg(F.max("n").alias("top"))         # a row per id of A's vocabulary
    return (counts.withColumn("a", a).join(F.broadcast(top), "a")
            .select("pair", "n", (F.col("n") == F.col("top")).alias("best")))


def hot_threshold(counts: DataFrame, hot_pairs: int = HOT_PAIRS) -> int:
    """The smallest power of two that at most ``hot_pairs`` pairs reach."""
    bands = (counts.groupBy(F.floor(F.log2("n")).cast("int").alias("band")).agg(F.count(F.lit(1)).alias("rows"))
             .orderBy(F.desc("band")).collect())                            # 64 bands at most
    total, least = 0, 62
    for band in bands:
        total += band["rows"]
        if total > hot_pairs:
            break
        least = band["band"]
    else:
        least = 0
    return 1 << least


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best (links whose
    pair has its A id's highest count), count_sum (over links) and groups_sha256."""
    spark = docs.sparkSession
    width = load_sides(path_a, path_b)[1].size
    linked = materialise(linked_pairs(docs, path_a, path_b, id_col, text_col), "linked-pairs")
    counts = materialise(pair_counts(linked, width), "best-pairs")
    least = hot_threshold(counts, hot_pairs)
    hot = counts.where(F.col("n") >= least).orderBy("pair").toArrow()       # at most ``hot_pairs`` rows
    table = spark.sparkContext.broadcast(
        (hot.column("pair").to_numpy(), hot.column("n").to_numpy(), hot.column("best").to_numpy(zero_copy_only=False)))
    id_type = docs.schema[id_col].dataType.simpleString()
    plain = [id_col, "key", "slot", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = table.value
        for batch in batches:
            pairs, many = batch.column(len(plain)), batch.column(len(plain) + 1)
            offsets = np.asarray(pairs.offsets, np.int64)
            keys = np.asarray(pairs.values)[offsets[0]:offsets[-1]]
            times = np.asarray(many.values)[int(many.offsets[0].as_py()):int(many.offsets[-1].as_py())]
            offsets = offsets - offsets[0]
            at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
            found = known[at] == keys if len(known) else np.zeros(len(keys), bool)
            at = np.where(found, at, 0)

            def per_row(values: np.ndarray) -> np.ndarray:
                total = np.concatenate([[0], np.cumsum(values)])
                return total[offsets[1:]] - total[offsets[:-1]]

            if len(known):
                sums, bests = per_row(np.where(found, times * n[at], 0)), per_row(np.where(found & best[at], times, 0))
            else:
                sums = bests = np.zeros(batch.num_rows, np.int64)
            left = np.flatnonzero(~found)
            cuts = pa.array(np.searchsorted(left, offsets).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(plain))), pa.array(bests.astype(np.int64)), pa.array(sums.astype(np.int64)),
                 pa.ListArray.from_arrays(cuts, pa.array(keys[left])), pa.ListArray.from_arrays(cuts, pa.array(times[left]))],
                [*plain, "n_best", "count_sum", "rest", "rest_many"])

    rows = linked.select(*plain, "pairs", "many").mapInArrow(
        run, f"`{id_col}` {id_type}, key binary, slot int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
             "n_best long, count_sum long, rest array<long>, rest_many array<long>")
    out = [id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if least == 1:                                                          # no pair is left for the join
        return rows.select(*out)
    rows = materialise(rows, "hot-counts")
    texts = rows.where(F.size("rest") > 0).groupBy("key").agg(F.first(F.arrays_zip("rest", "rest_many")).alias("left"))
    texts = texts.select("key", F.inline("left")).withColumnsRenamed({"rest": "pair", "rest_many": "many"})
    more = (texts.join(counts.where(F.col("n") < least), "pair").groupBy("key")
            .agg(F.sum(F.col("many") * F.col("n")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("many"))).alias("more_best")))
    joined = join_hot(rows.where(F.size("rest") > 0).drop("rest", "rest_many"), more, ["key"], "slot")
    joined = (joined.withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0).cast("long")))
              .withColumn("count_sum", F.col("count_sum") + F.col("more_sum")))
    return joined.select(*out).unionByName(rows.where(F.size("rest") == 0).select(*out))
