"""Token ids as canonical, length-limited Huffman files.

Encoding a corpus takes three passes over ever smaller data:

1. texts become ids (written below the shared checkpoint folder), and the ids
   are counted over the whole corpus: per task first, then by id;
2. a length-limited code is built from the counts (package-merge; the table has
   one row per vocabulary id, so it may live on the driver), every document is
   coded, and the coded documents are range-partitioned and sorted by id;
3. consecutive documents are packed into segments and written.

File format (a folder of two Parquet tables, so that Spark's commit protocol
covers lost executors and any store that Spark writes will do):

* ``codebook``: ``symbol int, length int``.  Codes are canonical: by length,
  then symbol, counting up.
* ``segments``: a row per run of documents in ascending id order --
  ``part`` (range partition), ``first`` (ids before it there), ``ids`` and
  ``tokens`` (per document), ``payload`` (big-endian 32-bit words; a document
  starts at a new word) and ``checkpoints`` (little-endian 32-bit: the bit
  offset at which each block starts).  A block has ``block_ids`` ids of one
  document (its last one fewer) and can be decoded alone.

Decoding looks up ``max_bits`` bits at a time in a table of ``2 ** max_bits``
entries, all blocks of a segment in step.

Defined cases: a NULL text has no ids but the end id; a NULL id sorts first;
repeated rows are all stored (ties of the id: shorter, then by a hash of the
coded bytes), and rows of one id may lie in many ranges; a
text of any length is one document; an empty table gives empty tables; other
columns are not looked at.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import materialise, text_slices
from strata.session import scratch_path

END_ID = 2
MAX_BITS = 20
BLOCK_IDS = 256
SEGMENT_IDS = 1 << 18


# -- tokenising --------------------------------------------------------------

class Encoder:
    """Ids of a text by a ``tokenizers`` file.

    A byte-level byte-pair file whose ids follow its merges is run by the
    faster library over the same vocabulary (same ids, tested); any other file,
    and any text that one refuses, goes through the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, self._slow = path, None
        self.size = 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
        self.fast = _rank_encoder(spec)

    def slow(self, text: str) -> list[int]:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
        return self._slow.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except (ValueError, RuntimeError):
                pass
        return np.asarray(self.slow(text), np.uint32)


def _rank_encoder(spec: dict):
    """The rank form of a byte-level file, or None where the two could differ."""
    import public_tokenizers
    import tiktoken

    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    vocab, merges = model.get("vocab", {}), model.get("merges", [])
    if (model.get("type") != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel"
            or pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("dropout")
            or model.get("ignore_merges") or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
                                                 for t in spec["added_tokens"])):
        return None
    # the byte-level alphabet: printable bytes stand for themselves, the others are shifted up
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet = {chr(b): b for b in printable}
    alphabet.update({chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))})
    for i, merge in enumerate(merges):
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        if vocab.get(a + b) != 256 + i:
            return None
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items() if token not in special}
    return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


@lru_cache(maxsize=4)
def load_encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenise(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
             end_id: int = END_ID) -> DataFrame:
    """(id, n, ids): the ids as little-endian integers, 16 bits if the vocabulary allows."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(tokenizer_path)
        kind = id_type_of(encoder.size)
        for batch in text_slices(batches):
            counts, data = [], []
            for text in batch.column(1).to_pylist():
                ids = np.append(encoder(text or ""), np.uint32(end_id)).astype(kind)
                counts.append(len(ids))
                data.append(ids.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(data, pa.binary())],
                                             ["id", "n", "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, f"id {id_type}, n long, ids binary")


def id_type_of(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def count_ids(tokens: DataFrame, vocabulary: int) -> DataFrame:
    """(symbol, n) over the whole corpus; counted per task, then summed."""
    kind = id_type_of(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for cell in batch.column(0):
                total += np.bincount(np.frombuffer(cell.as_buffer(), kind), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["symbol", "n"])

    return (tokens.select("ids").mapInArrow(run, "symbol int, n long")
            .groupBy("symbol").agg(F.sum("n").alias("n")))


# -- the code ----------------------------------------------------------------

def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` bits (package-merge)."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} symbols need more than {max_bits} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.lexsort((used, counts[used]))]
    leaves = counts[order].astype(np.int64)
    n = len(leaves)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(max_bits):
        weights = np.concatenate([leaves, packages])
        rank = np.argsort(weights, kind="stable")
        levels.append(rank < n)                       # which items of the sorted level are leaves
        merged = weights[rank]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * (n - 1)
    depth = np.zeros(n, np.int64)
    for is_leaf in reversed(levels):
        chosen = int(is_leaf[:take].sum())
        depth[:chosen] += 1
        take = 2 * (take - chosen)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes that count up by (length, symbol)."""
    used = np.flatnonzero(lengths)
    codes = np.zeros(len(lengths), np.uint64)
    order = used[np.lexsort((used, lengths[used]))]
    code, last = 0, 0
    for symbol in order.tolist():
        size = int(lengths[symbol])
        code <<= size - last
        codes[symbol], last = code, size
        code += 1
    return codes


class Coder:
    """Coding and decoding tables of one code."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical_codes(lengths)
        self.bits = int(lengths.max(initial=1))
        table = np.zeros(1 << self.bits, np.uint64)
        for symbol in np.flatnonzero(lengths).tolist():
            size = int(lengths[symbol])
            lo = int(self.codes[symbol]) << (self.bits - size)
            table[lo: lo + (1 << (self.bits - size))] = symbol << 5 | size
        self.table = table

    def encode(self, ids: np.ndarray, counts: np.ndarray, block_ids: int = BLOCK_IDS
               ) -> tuple[list[bytes], list[bytes]]:
        """(payloads, checkpoints) of documents of ``counts`` ids each."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        bits_before = np.where(first > 0, ends[first - 1], 0)
        bits = np.add.reduceat(sizes, first)
        words = -(-bits // 32)
        word_at = np.concatenate([[0], np.cumsum(words)])
        shift = np.repeat(word_at[:-1] * 32 - bits_before, counts)
        begin = ends - sizes + shift
        word = begin >> 5
        value = self.codes[ids] << (64 - (begin & 31) - sizes).astype(np.uint64)
        runs = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out = np.zeros(int(word_at[-1]) + 1, np.uint64)
        out[word[runs]] = np.bitwise_or.reduceat(value >> np.uint64(32), runs)
        out[word[runs] + 1] |= np.bitwise_or.reduceat(value & np.uint64(0xFFFFFFFF), runs)
        data = out.astype(">u4").tobytes()
        payloads, checkpoints = [], []
        for d, n in enumerate(counts.tolist()):
            payloads.append(data[4 * word_at[d]: 4 * word_at[d + 1]])
            at = begin[first[d]: first[d] + n: block_ids] - 32 * word_at[d]
            checkpoints.append(at.astype("<u4").tobytes())
        return payloads, checkpoints

    def decode(self, payload: bytes, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of blocks that start at bit ``starts`` and hold ``counts`` ids,
        one after another; all blocks advance together."""
        words = np.concatenate([np.frombuffer(payload, ">u4").astype(np.uint64), np.zeros(2, np.uint64)])
        window = words[:-1] << np.uint64(32) | words[1:]
        out = np.zeros(int(counts.sum()), np.uint32)
        order = np.argsort(-counts, kind="stable")      # the blocks still running stay in front
        at = starts[order].astype(np.uint64)
        target = (np.cumsum(counts) - counts)[order]
        left = np.searchsorted(-counts[order], -np.arange(int(counts.max(initial=0))), side="left")
        drop, low, five = np.uint64(64 - self.bits), np.uint64(31), np.uint64(5)
        for step, live in enumerate(left.tolist()):
            p = at[:live]
            entry = self.table[(window[p >> five] << (p & low)) >> drop]
            out[target[:live] + step] = entry >> five
            at[:live] = p + (entry & low)
        return out


# -- files -------------------------------------------------------------------

def write_token_files(docs: DataFrame, tokenizer_path: str, out_path: str, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = END_ID, max_bits: int = MAX_BITS,
                      block_ids: int = BLOCK_IDS, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode ``docs`` into a token folder at ``out_path``."""
    spark = docs.sparkSession
    vocabulary = max(load_encoder(tokenizer_path).size, end_id + 1)
    tokens = materialise(tokenise(docs, tokenizer_path, id_col, text_col, end_id), "token-ids")
    counts = np.zeros(vocabulary, np.int64)
    for row in count_ids(tokens, vocabulary).collect():     # at most one row per vocabulary id
        counts[row["symbol"]] = row["n"]
    lengths = code_lengths(counts, max_bits)
    used = np.flatnonzero(lengths)
    book = spark.createDataFrame([(int(s), int(lengths[s])) for s in used], "symbol int, length int")
    book.coalesce(1).write.parquet(f"{out_path}/codebook")

    kind, id_type = id_type_of(vocabulary), tokens.schema["id"].dataType.simpleString()
    small = lengths.astype(np.uint8)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(small.astype(np.int64))
        for batch in text_slices(batches, max_bytes=2 << 20):
            ids = np.concatenate([np.frombuffer(c.as_buffer(), kind) for c in batch.column(2)])
            payloads, marks = coder.encode(ids.astype(np.int64), batch.column(1).to_numpy(), block_ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(payloads, pa.binary()),
                                              pa.array(marks, pa.binary())], ["id", "n", "payload", "marks"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, first, rows, held = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            bits, words, marks = [], 0, []
            for _, _, payload, mark in rows:
                marks.append(np.frombuffer(mark, "<u4").astype(np.int64) + 32 * words)
                words += len(payload) // 4
            bits = np.concatenate(marks).astype("<u8")
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([first], pa.int64()),
                pa.array([[r[0] for r in rows]], pa.list_(id_kind)),
                pa.array([[r[1] for r in rows]], pa.list_(pa.int64())),
                pa.array([b"".join(r[2] for r in rows)], pa.binary()), pa.array([bits.tobytes()], pa.binary())],
                ["part", "first", "ids", "tokens", "payload", "checkpoints"])

        for batch in batches:
            id_kind = batch.column(0).type
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if rows and held + row[1] > segment_ids:
                    yield flush()
                    first, rows, held = first + held, [], 0
                rows.append(row)
                held += row[1]
        if rows:
            yield flush()

    coded = tokens.mapInArrow(code, f"id {id_type}, n long, payload binary, marks binary")
    # AQE's coalescing joins neighbouring ranges only, so the order across partitions holds
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # rows of one id are cut apart by length and content, equal ones by where they were read
    coded = coded.withColumns({"mark": F.xxhash64("payload"), "spot": F.spark_partition_id()})
    (coded.repartitionByRange(parts, "id", "n", "mark", "spot").sortWithinPartitions("id", "n", "mark", "spot")
     .mapInArrow(pack, f"part int, first long, ids array<{id_type}>, tokens array<long>, payload binary, checkpoints binary")
     .write.option("compression", "none").parquet(f"{out_path}/segments"))


def read_token_files(spark: SparkSession, path: str, block_ids: int = BLOCK_IDS, arrays: bool = False) -> DataFrame:
    """One row per document of a token folder: id, start (ids of all documents
    before it), n_tokens, and the CRC-32 of the ids or (``arrays``) the ids."""
    segments = spark.read.parquet(f"{path}/segments")
    book = spark.read.parquet(f"{path}/codebook").collect()    # at most one row per vocabulary id
    lengths = np.zeros(1 + max((r["symbol"] for r in book), default=0), np.uint8)
    for r in book:
        lengths[r["symbol"]] = r["length"]
    id_type = segments.schema["ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(lengths.astype(np.int64))
        for batch in batches:
            for r in range(batch.num_rows):
                base, ids, tokens, payload, marks = (batch.column(i)[r] for i in range(5))
                counts = np.asarray(tokens.values)
                blocks = -(-counts // block_ids)
                sizes = np.full(int(blocks.sum()), block_ids, np.int64)
                sizes[np.cumsum(blocks) - 1] = counts - (blocks - 1) * block_ids
                out = coder.decode(payload.as_buffer(), np.frombuffer(marks.as_buffer(), "<u8"), sizes).astype("<u4")
                ends = np.cumsum(counts)
                begins = ends - counts
                value = [out[b:e].tolist() if arrays else zlib.crc32(out[b:e].tobytes())
                         for b, e in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    ids.values, pa.array(base.as_py() + begins, pa.int64()), pa.array(counts, pa.int64()),
                    pa.array(value, pa.list_(pa.int32()) if arrays else pa.int64())], ["id", "start", "n_tokens", "v"])

    held = segments.select("part", F.aggregate("tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    parts = held.groupBy("part").agg(F.sum("n").alias("n"))
    # one row per range partition: bounded by the partition count
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    rows = segments.join(F.broadcast(before), "part").select(
        (F.col("before") + F.col("first")).alias("base"), "ids", "tokens", "payload", "checkpoints")
    kind = "v array<int>" if arrays else "v long"
    out = rows.mapInArrow(decode, f"id {id_type}, start long, n_tokens long, {kind}")
    return out.withColumnRenamed("v", "token_ids" if arrays else "ids_crc32")


def token_file_rows(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the folder below the shared checkpoint folder and read it back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, tokenizer_path, path, id_col, text_col)
    return read_token_files(docs.sparkSession, path).withColumnRenamed("id", id_col)
