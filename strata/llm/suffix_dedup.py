"""Removal of long repeated byte strings by a distributed suffix merge sort.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts
somewhere else, in the same text or another.  Strings never cross texts.

Sorting the suffix at every byte would exchange hundreds of bytes per byte of
text, so suffixes are sorted at anchors only.  Each 400-byte window picks as its
anchor the position of the smallest hash among its first ``WINDOW`` 16-byte
strings (leftmost on ties): equal windows pick the same place, and one anchor
serves a run of neighbouring windows.  An anchor's record is the text left of it
back to the first window it serves, and the suffix from it to the end of the
last.  Two windows are equal if they are at the same distance before anchors
whose left texts agree that far and whose suffixes agree for the rest of the 400
bytes.  Hence for two anchors with ``R`` equal bytes to the right and ``L`` to
the left, everything from L before to R behind is repeated if L + R >= 400.

1. *Anchors* (no shuffle).  Each comes with a hash of the 145 bytes that any
   equal window must share to its right, and one of its whole record.
2. *Candidates.*  Anchors whose first hash is unique are dropped.  Equal records
   are counted together: all their windows are repeated, and one of them stands
   for all in what follows.
3. *Sorted runs.*  Tasks sort the remaining suffixes of their texts and write
   them front-coded (shared prefix length, rest), by bucket of the first hash.
4. *Merge.*  Per bucket a loser tree merges the runs.  It keeps, for every run's
   head, the prefix it shares with the last output, so bytes known to be equal
   are never compared again, and it yields the shared prefix lengths of the
   sorted suffixes.
5. *Matches.*  Along the tree of these lengths, the members of each node are
   sorted by their left texts; neighbours give each member's longest left match
   at the node's R.  The union of a member's matches is one interval.
6. *Cut.*  The intervals are joined to their texts.

Buckets are as many as the candidates need.  An anchor hash with more than
``GROUP_LIMIT`` different records (a passage that very many texts share) is taken
apart first, in rounds: all members are compared with one of them; as prefix
lengths form an ultrametric, two members can match further than with it only
where they leave it at the same place with the same next byte, on the right or
on the left, so they are regrouped by that.  No pair is lost.

Defined cases: a NULL text counts as empty; repeated rows repeat each other's
text; texts below 400 bytes keep all; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise, text_slices

LENGTH = 400
WINDOW = 256                      # a power of two
GRAM = 16
SHARED = LENGTH - WINDOW + 1      # bytes right of the anchor that equal windows share
CHUNK = 1 << 20                   # window starts looked at together
GROUP_LIMIT = 4096
BUCKET_RECORDS = 16_384
RUN_BYTES = 16 << 20
_POSITION = np.uint64((1 << 24) - 1)


# -- anchors -----------------------------------------------------------------

def _gram_hashes(data: np.ndarray) -> np.ndarray:
    code, size = data.astype(np.uint64) + np.uint64(1), 1
    for factor in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93):
        code = code[:-size] * np.uint64(factor) + code[size:]
        size *= 2
        code ^= code >> np.uint64(32)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    return code


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window) of a text, in order."""
    windows = len(data) - LENGTH + 1
    if windows <= 0:
        return (np.zeros(0, np.int64),) * 3
    raw = np.frombuffer(data, np.uint8)
    at = []
    for lo in range(0, windows, CHUNK):
        n = min(CHUNK, windows - lo)
        code = _gram_hashes(raw[lo: lo + n + WINDOW + GRAM - 2])
        code = (code & ~_POSITION) | np.arange(len(code), dtype=np.uint64)
        size = 1
        while size < WINDOW:
            code = np.minimum(code[:-size], code[size:])
            size *= 2
        at.append((code & _POSITION).astype(np.int64)[:n] + lo)
    at = np.concatenate(at)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], first, np.append(first[1:], windows) - 1


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """(id, th, h, record, a, lo, hi) per anchor of ``docs`` (id, th, text)."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, max_bytes=2 << 20):
            rows, hashes, records, places = [], [], [], []
            for r, text in enumerate(batch.column(2).to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                a, lo, hi = anchors(data)
                if not len(a):
                    continue
                view = memoryview(data)
                for x, y, z in zip(a.tolist(), lo.tolist(), hi.tolist()):
                    hashes.append(xxhash.xxh3_64_intdigest(view[x:x + SHARED]))
                    records.append(xxhash.xxh3_64_intdigest(view[y:z + LENGTH], x - y))
                rows.append(np.full(len(a), r))
                places.append(np.stack([a, lo, hi]))
            if rows:
                take = pa.array(np.concatenate(rows))
                place = np.concatenate(places, axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take),
                     pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array(np.array(records, np.uint64).view(np.int64)),
                     *(pa.array(p) for p in place)], ["id", "th", "h", "record", "a", "lo", "hi"])

    return docs.mapInArrow(run, f"id {id_type}, th long, h long, record long, a int, lo int, hi int")


# -- front-coded runs and their merge ----------------------------------------

def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be ``start`` at least."""
    end = min(len(a), len(b))
    while start < end:
        step = min(64, end - start)
        x, y = a[start:start + step], b[start:start + step]
        if x != y:
            diff = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return start + step - (diff.bit_length() + 7) // 8
        start += step
    return end


def encode_run(suffixes: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Sorted suffixes as (shared prefix length, rest)."""
    shared, last = [], b""
    for s in suffixes:
        shared.append(common_prefix(last, s))
        last = s
    return shared, [s[n:] for s, n in zip(suffixes, shared)]


class _Run:
    """The head of a front-coded run."""

    __slots__ = ("shared", "rests", "items", "at", "text", "lcp")

    def __init__(self, shared: list[int], rests: list[bytes], items: list):
        self.shared, self.rests, self.items = shared, rests, items
        self.at, self.text, self.lcp = 0, rests[0], 0

    def advance(self) -> bool:
        """Step to the next suffix, which shares ``lcp`` bytes with the last one."""
        self.at += 1
        if self.at >= len(self.rests):
            self.text = None
            return False
        self.lcp = self.shared[self.at]
        self.text = self.text[:self.lcp] + self.rests[self.at]
        return True


def _play(a: "_Run", b: "_Run") -> tuple["_Run", "_Run"]:
    """(winner, loser); both know the prefix they share with the last output,
    and the loser then knows the one it shares with the winner."""
    if b.text is None:
        return a, b
    if a.text is None:
        return b, a
    if a.lcp != b.lcp:
        return (a, b) if a.lcp > b.lcp else (b, a)
    n = common_prefix(a.text, b.text, a.lcp)
    if a.text[n:n + 1] <= b.text[n:n + 1]:
        b.lcp = n
        return a, b
    a.lcp = n
    return b, a


def merge_runs(runs: list["_Run"]) -> Iterator[tuple[bytes, int, object]]:
    """(suffix, prefix shared with the one before, item) in sorted order, from a
    loser tree over the runs' heads."""
    k = 1
    while k < len(runs):
        k *= 2
    idle = [_Run([0], [b""], [None]) for _ in range(k - len(runs))]
    for r in idle:
        r.text = None
    leaves = runs + idle
    place = {id(r): i for i, r in enumerate(leaves)}
    losers: list = [None] * k

    def build(node: int) -> "_Run":
        if node >= k:
            return leaves[node - k]
        winner, losers[node] = _play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    while winner.text is not None:
        yield winner.text, winner.lcp, winner.items[winner.at]
        winner.advance()
        node = (place[id(winner)] + k) // 2
        while node:
            winner, losers[node] = _play(winner, losers[node])
            node //= 2


# -- matches -----------------------------------------------------------------

def match_group(shared: list[int], lefts: list[bytes]) -> list[tuple[int, int] | None]:
    """For sorted suffixes with prefix lengths ``shared`` between neighbours and
    the reversed texts left of them: how far each one's repeated interval goes
    to the left and to the right of its anchor."""
    m = len(lefts)
    far_left, far_right = [-1] * m, [-1] * m
    longest = [len(x) for x in lefts]
    stack = [(0, m)]
    while stack:
        lo, hi = stack.pop()
        if hi - lo < 2:
            continue
        r = min(shared[lo:hi - 1])
        if r + max(longest[lo:hi]) >= LENGTH:
            order = sorted(range(lo, hi), key=lefts.__getitem__)
            before = 0
            for i, j in zip(order, [*order[1:], None]):
                after = common_prefix(lefts[i], lefts[j]) if j is not None else 0
                left = max(before, after)
                if left + r >= LENGTH:
                    if left > far_left[i]:
                        far_left[i] = left
                    if r > far_right[i]:
                        far_right[i] = r
                before = after
        cuts = [lo, *(i + 1 for i in range(lo, hi - 1) if shared[i] == r), hi]
        stack.extend(pairwise(cuts))
    return [(x, y) if x >= 0 else None for x, y in zip(far_left, far_right)]


def _merge_bucket(table: pa.Table) -> list[tuple[int, int, int]]:
    """(record number, left, right) of the matches in one bucket's runs."""
    runs = []
    for shared, rests, lefts, numbers in zip(*(table.column(c).to_pylist() for c in ("shared", "rests", "lefts", "numbers"))):
        runs.append(_Run(shared, rests, list(zip(numbers, lefts))))
    out: list[tuple[int, int, int]] = []
    group: list = []
    shared: list[int] = []

    def close() -> None:
        if len(group) > 1:
            for (number, _), hit in zip(group, match_group(shared, [left for _, left in group])):
                if hit:
                    out.append((number, *hit))

    for _, lcp, item in merge_runs(runs):
        if lcp < 8 + SHARED:       # 8 bytes of group key stand before every suffix
            close()
            group, shared = [], []
        else:
            shared.append(lcp - 8)
        group.append(item)
    close()
    return out


# -- the operator ------------------------------------------------------------

_RECORD = "number long, g long, lefts binary, suffix binary"


def _records(anchored: DataFrame) -> DataFrame:
    """(number, g, left, suffix) from (text, anchors: numbers, g, a, lo, hi): the
    left texts are reversed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, max_bytes=1 << 20):
            numbers, keys, lefts, suffixes = [], [], [], []
            for text, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                for x in rows:
                    numbers.append(x["number"])
                    keys.append(x["g"])
                    lefts.append(data[x["lo"]:x["a"]][::-1])
                    suffixes.append(data[x["a"]:x["hi"] + LENGTH])
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(keys, pa.int64()), pa.array(lefts, pa.binary()), pa.array(suffixes, pa.binary())],
                ["number", "g", "lefts", "suffix"])

    return anchored.select("text", "rows").mapInArrow(run, _RECORD)


def _sorted_runs(records: DataFrame, buckets: int) -> DataFrame:
    """(bucket, shared, rests, lefts, numbers): front-coded runs per bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            held.sort(key=lambda x: (x[0], x[1]))
            lo = 0
            while lo < len(held):
                hi = lo
                while hi < len(held) and held[hi][0] == held[lo][0]:
                    hi += 1
                part = held[lo:hi]
                shared, rests = encode_run([x[1] for x in part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part[0][0]], pa.int64()), pa.array([shared], pa.list_(pa.int32())), pa.array([rests], pa.list_(pa.binary())),
                     pa.array([[x[2] for x in part]], pa.list_(pa.binary())), pa.array([[x[3] for x in part]], pa.list_(pa.int64()))],
                    ["bucket", "shared", "rests", "lefts", "numbers"])
                lo = hi

        for batch in batches:
            for number, g, left, suffix in zip(*(batch.column(i).to_pylist() for i in range(4))):
                key = g & 0xFFFFFFFFFFFFFFFF
                held.append((key % buckets, key.to_bytes(8, "big") + suffix, left, number))
                size += len(left) + len(suffix) + 150
            if size > RUN_BYTES:
                yield from flush()
                held, size = [], 0
        yield from flush()

    return records.select("number", "g", "lefts", "suffix").mapInArrow(
        run, "bucket long, shared array<int>, rests array<binary>, lefts array<binary>, numbers array<long>")


def _matches(records: DataFrame, total: int) -> DataFrame:
    """(number, far_left, far_right) by sorting and merging all records."""
    buckets = max(1, -(-total // BUCKET_RECORDS))

    def merge(key, table: pa.Table) -> pa.Table:
        out = _merge_bucket(table)
        numbers, left, right = zip(*out) if out else ((), (), ())
        return pa.table({"number": pa.array(numbers, pa.int64()), "far_left": pa.array(left, pa.int32()), "far_right": pa.array(right, pa.int32())})

    return _sorted_runs(records, buckets).groupBy("bucket").applyInArrow(
        lambda key, table: merge(key, table), "number long, far_left int, far_right int")


def _split_large(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round over groups that are too large: (matches with the group's
    smallest record, the members in their new groups)."""
    first = records.groupBy("g").agg(F.min_by(F.struct("number", "lefts", "suffix"), "number").alias("first"))
    both = records.join(first, "g").select("number", "g", "lefts", "suffix", F.col("first.number").alias("fn"),
                                           F.col("first.lefts").alias("fl"), F.col("first.suffix").alias("fs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, max_bytes=1 << 20):
            out: list[tuple] = []
            for number, g, left, suffix, fn, fl, fs in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if number == fn:
                    continue
                n, m = common_prefix(left, fl), common_prefix(suffix, fs)
                hit = n + m >= LENGTH
                for who in (number, fn) if hit else ():
                    out.append((who, None, None, None, n, m))
                for side, at, text in ((b"R", m, suffix), (b"L", n, left)):
                    if at < len(text):
                        key = xxhash.xxh3_64_intdigest(side + at.to_bytes(4, "big") + text[at:at + 1], g & 0xFFFFFFFFFFFFFFFF)
                        out.append((number, key - (1 << 64) if key >> 63 else key, left, suffix, None, None))
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["number", "g", "lefts", "suffix", "far_left", "far_right"])

    out = materialise(both.mapInArrow(run, _RECORD + ", far_left int, far_right int"), "split-groups")
    return (out.where("g is null").select("number", "far_left", "far_right"),
            out.where("g is not null").select("number", "g", "lefts", "suffix"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(id, th, s, e): intervals of repeated bytes, possibly overlapping, of
    ``docs`` (id, th, text); th tells rows with one id apart."""
    rows = materialise(_anchor_rows(docs), "anchors")
    # what is equal as a whole is counted together, where it is read
    records = rows.groupBy("h", "record").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "th", "a")).alias("first"))
    groups = records.groupBy("h").agg(F.count(F.lit(1)).alias("d"), F.max("n").alias("most")).where("d > 1 or most > 1")
    held = records.join(groups.select("h", "d"), "h")
    marked = materialise(rows.join(held, ["h", "record"]).select(
        "id", "th", "h", "a", "lo", "hi", (F.col("n") > 1).alias("whole"),
        ((F.col("d") > 1) & F.struct("id", "th", "a").eqNullSafe(F.col("first"))).alias("sorted")), "candidates")
    whole = marked.where("whole").select("id", "th", F.col("lo").alias("s"), (F.col("hi") + LENGTH).alias("e"))

    # numbered once, in the written table
    to_sort = marked.where("sorted").dropDuplicates(["id", "th", "a"])
    to_sort = materialise(to_sort.select("id", "th", "h", "a", "lo", "hi", F.monotonically_increasing_id().alias("number")), "to-sort")
    per_text = to_sort.groupBy("id", "th").agg(F.collect_list(
        F.struct("number", F.col("h").alias("g"), "a", "lo", "hi")).alias("rows"))           # bounded by the text's length
    anchored = (docs.join(per_text.withColumnsRenamed({"id": "i2", "th": "t2"}),
                          F.col("id").eqNullSafe(F.col("i2")) & (F.col("th") == F.col("t2"))).select("text", "rows"))
    contexts = _records(anchored)

    sizes = to_sort.groupBy(F.col("h").alias("g")).agg(F.count(F.lit(1)).alias("n"))
    large = materialise(sizes.where(F.col("n") > GROUP_LIMIT).select("g"), "large-groups")
    found, total = [], to_sort.count()
    if not large.isEmpty():
        contexts = materialise(contexts, "contexts")
        small, todo = contexts.join(large, "g", "left_anti"), contexts.join(large, "g", "left_semi")
        while True:
            hits, parts = _split_large(todo)
            found.append(hits)
            size = parts.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
            usable = materialise(size.where("n > 1"), "group-sizes")
            parts = parts.join(usable, "g")
            fits = parts.where(F.col("n") <= GROUP_LIMIT).drop("n")
            small = small.unionByName(fits.select(*small.columns))
            todo = parts.where(F.col("n") > GROUP_LIMIT).drop("n").select(*small.columns)
            if usable.where(F.col("n") > GROUP_LIMIT).isEmpty():
                break
            todo = materialise(todo, "large-records")
        contexts, total = small, 3 * total
    found.append(_matches(contexts, total))
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    hits = hits.groupBy("number").agg(F.max("far_left").alias("far_left"), F.max("far_right").alias("far_right"))
    spans = to_sort.join(hits, "number").select("id", "th", (F.col("a") - F.col("far_left")).alias("s"), (F.col("a") + F.col("far_right")).alias("e"))
    return whole.unionByName(spans)


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint maximal runs of sorted or unsorted spans; touching ones join."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, the bytes that stay (``kept``),
    n_removed and the removed spans."""
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.select("id", F.xxhash64("text").alias("th"), "text")
    spans = (repeated_spans(texts).groupBy("id", "th").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
             .withColumnsRenamed({"id": "i2", "th": "t2"}))
    spans = materialise(spans, "repeated-spans")
    rows = texts.join(spans, F.col("id").eqNullSafe(F.col("i2")) & (F.col("th") == F.col("t2")), "left").select("id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            out = []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                cut = merge_spans([(x["s"], x["e"]) for x in found or ()])
                edges = [0, *(p for span in cut for p in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(data), len(data) - len(kept), [{"s": s, "e": e} for s, e in cut], kept))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))],
                                             ["id", "n_bytes", "n_removed", "spans", "kept"])

    out = rows.mapInArrow(run, f"id {id_type}, n_bytes long, n_removed long, spans array<struct<s:int,e:int>>, kept binary")
    return out.withColumnRenamed("id", id_col)
