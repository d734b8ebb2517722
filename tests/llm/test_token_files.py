import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import token_files as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


def want_ids(texts):
    tok = Tokenizer.from_file(PATH)
    return [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_files_hold_the_ids_in_order(docs, texts):
    rows = {r["doc_id"]: r for r in T.token_file_rows(docs, PATH).collect()}
    start = 0
    for i, ids in enumerate(want_ids(texts)):
        assert (rows[i]["start"], rows[i]["n_tokens"]) == (start, len(ids)), texts[i]
        assert rows[i]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_small_segments_and_blocks_and_arrays(spark, docs, texts, tmp_path):
    path = str(tmp_path / "tokens")
    T.write_token_files(docs, PATH, path, block_ids=7, segment_ids=50, max_bits=16)
    rows = {r["id"]: r["token_ids"] for r in T.read_token_files(spark, path, block_ids=7, arrays=True).collect()}
    assert [rows[i] for i in range(len(texts))] == want_ids(texts)


def test_odd_and_empty_tables(odd_docs, no_docs):
    rows = T.token_file_rows(odd_docs, PATH).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(r["start"] for r in rows) == np.concatenate([[0], np.cumsum(
        [r["n_tokens"] for r in sorted(rows, key=lambda r: r["start"])])[:-1]]).tolist()
    assert T.token_file_rows(no_docs, PATH).count() == 0


@pytest.mark.parametrize("max_bits", [9, 12, 20])
def test_code_lengths_are_limited_prefix_free_and_optimal(max_bits):
    rng = np.random.default_rng(max_bits)
    counts = np.maximum(0, (rng.pareto(0.5, 300) * 3).astype(np.int64))
    lengths = T.code_lengths(counts, max_bits)
    used = lengths > 0
    assert (used == (counts > 0)).all() and lengths.max() <= max_bits
    assert (2.0 ** -lengths[used]).sum() <= 1
    if max_bits == 20:
        import heapq
        heap = [int(c) for c in counts if c]
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            a = heapq.heappop(heap) + heapq.heappop(heap)
            cost += a
            heapq.heappush(heap, a)
        assert int((counts * lengths).sum()) == cost


def test_too_few_bits_are_refused_and_one_symbol_works():
    with pytest.raises(ValueError):
        T.code_lengths(np.ones(10, np.int64), 3)
    coder = T.Coder(T.code_lengths(np.array([0, 5]), 4))
    payloads, marks = coder.encode(np.array([1, 1, 1]), np.array([3]))
    assert coder.decode(payloads[0], np.frombuffer(marks[0], "<u4"), np.array([3])).tolist() == [1, 1, 1]


def test_a_third_without_an_id_is_no_large_segment(spark, tmp_path):
    """Rows without an id, of one text and of many, are cut into ranges too."""
    base = spark.range(0, 9_000, numPartitions=16)
    for name, text in (("equal", F.lit("some text")), ("other", F.concat(F.lit("text "), F.col("id").cast("string")))):
        df = base.select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), text.alias("text"))
        path = str(tmp_path / name)
        T.write_token_files(df, PATH, path, segment_ids=500)
        parts = spark.read.parquet(f"{path}/segments").groupBy("part").agg(F.sum(F.size("ids")).alias("n")).collect()
        assert len(parts) >= 3 and max(r["n"] for r in parts) < 9_000 / 2
        rows = T.read_token_files(spark, path).collect()
        rows.sort(key=lambda r: r["start"])
        assert [r["start"] for r in rows] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in rows])[:-1]]).tolist()
        assert [r["id"] for r in rows] == [None] * 3_000 + [i for i in range(9_000) if i % 3]
