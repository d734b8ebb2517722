"""Phrase collocations from weighted acyclic automata.

A count transducer holds n-grams as paths; the weight of a path is its number
of occurrences.  Symbols are 64-bit hashes of words.

1. Every task reads texts, sorts its n-grams and builds transducers level by
   level from them (a shard: a bounded number of words).  Equal states --
   transitions with equal symbols, weights and targets -- are stored once.  A
   shard leaves blocks of a bounded number of n-grams, each a transducer over
   one prefix range.
2. Cut points between prefix ranges come from a bounded sample of n-grams at
   random places of the blocks, one range for about ``RANGE_GRAMS`` of them.  A hot prefix
   is cut below itself, and a single n-gram counts once per shard, so no range
   is much larger.  Blocks are restricted to their ranges, and each range is
   the union of its blocks, weights summed.
3. This is done for words and pairs first, then for 3 to ``MAX_WORDS`` words:
   only where all pairs inside are frequent, as a phrase is at most as frequent
   as its parts.  A bit table of frequent pairs, of a fixed largest size, is
   broadcast for that; it can only let too much through.
4. The two parts of every cut of every candidate are composed with the frequent
   n-grams' transducers, range by range, which gives their weights.

Counts, cuts and scores are exact (integers, decimals); words are told apart by
their 64-bit hash.

Defined cases: a NULL text has no words; a NULL language is ``und``; repeated
rows all count; ties are broken by the contract's order, so equal scores at the
border are decided by the phrase; texts and words of any length are read whole;
an empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import bit_held, bit_table, join_hot, materialise, text_slices

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
COVER_PERCENT = 100
SHARD_WORDS = 1_000_000
SHARD_VOCABULARY = 400_000
BLOCK_GRAMS = 1 << 16
RANGE_GRAMS = 1 << 18           # n-grams before the union, per range
COMPOSE_GRAMS = 1 << 14         # frequent n-grams per range
MARK_GRAMS = 1 << 12            # a block shows one of so many n-grams to the sample
SAMPLE_MARKS = 200_000          # cut points come from so many of them; also the most ranges
NO_LANG = "und"

_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(46 if b in _ENDS else b + 32 if 65 <= b <= 90 else 32 if b == 9 else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.int64(-1)


# -- count transducers -------------------------------------------------------

class Levels:
    """Sorted n-grams as a tree: per level the parent's number, the symbol and
    the weight of each node, in the order of the n-grams."""

    def __init__(self, parents: list[np.ndarray], symbols: list[np.ndarray], weights: list[np.ndarray]):
        self.parents, self.symbols, self.weights = parents, symbols, weights

    @classmethod
    def from_grams(cls, columns: list[np.ndarray], weights: list[np.ndarray | None], symbols: np.ndarray) -> Levels:
        """From n-grams given by columns of symbol numbers (-1 past the end) into
        the sorted table ``symbols``.  ``weights[k]`` is what a row adds to its
        prefix of ``k + 1`` words; None: one for every row that has it."""
        out = cls([], [], [])
        width = max(len(symbols), 1)
        rows = np.arange(len(columns[0]) if columns else 0)
        node = np.zeros(len(rows), np.int64)
        for k, column in enumerate(columns):
            keep = column[rows] >= 0
            rows, node = rows[keep], node[keep]
            code, node = np.unique(node * width + column[rows], return_inverse=True)
            if weights[k] is None:
                total = np.bincount(node, minlength=len(code)).astype(np.int64)
            else:
                total = np.zeros(len(code), np.int64)
                np.add.at(total, node, weights[k][rows])
            out.parents.append(code // width)
            out.symbols.append(symbols[code % width])
            out.weights.append(total)
        return out

    def grams(self) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """(symbol columns, 0 past the end; sizes; weights; order): all nodes,
        and the order that sorts them as n-grams (a prefix before its extensions)."""
        below = [np.ones(len(s), np.int64) for s in self.symbols]
        for k in range(len(below) - 1, 0, -1):
            below[k - 1] += np.bincount(self.parents[k], weights=below[k], minlength=len(below[k - 1])).astype(np.int64)
        places, paths = [], []
        for k, symbol in enumerate(self.symbols):
            before = np.cumsum(below[k]) - below[k]
            if k == 0:
                place, path = before, []
            else:
                parent = self.parents[k]
                first = np.searchsorted(parent, parent)
                place = places[k - 1][parent] + 1 + before - before[first]
                path = [p[parent] for p in paths[k - 1]]
            places.append(place)
            paths.append([*path, symbol])
        depth = len(self.symbols)
        columns = [np.concatenate([paths[k][j] if j <= k else np.zeros(len(places[k]), np.uint64) for k in range(depth)])
                   for j in range(depth)]
        sizes = np.concatenate([np.full(len(p), k + 1, np.int64) for k, p in enumerate(places)])
        return columns, sizes, np.concatenate(self.weights), np.argsort(np.concatenate(places))


class CountTransducer:
    """A minimal acyclic automaton: per level the transitions of its states
    (symbol, weight, target state of the next level), grouped by state."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]):
        self.levels = levels            # (start of each state, one more at the end; symbols; weights; targets)

    @classmethod
    def from_levels(cls, tree: Levels) -> CountTransducer:
        levels = []
        target = np.zeros(len(tree.symbols[-1]) if tree.symbols else 0, np.int64)
        for k in range(len(tree.symbols) - 1, -1, -1):
            symbol, weight = tree.symbols[k], tree.weights[k]
            states = len(tree.symbols[k - 1]) if k else 1
            parent = tree.parents[k]
            start = np.searchsorted(parent, np.arange(states + 1))
            # a state is told by all its transitions, in two independent hashes
            marks = []
            for seed in (_MIX, np.uint64(0xD6E8FEB86659FD93)):
                h = (symbol ^ (weight.astype(np.uint64) * seed)) * seed + target.astype(np.uint64)
                h ^= h >> np.uint64(29)
                h *= np.uint64(0xBF58476D1CE4E5B9) ^ seed
                h ^= h >> np.uint64(32)
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * (h | np.uint64(1)), dtype=np.uint64)])
                marks.append(total[start[1:]] - total[start[:-1]] + (np.diff(start).astype(np.uint64) << np.uint64(1)))
            mark = np.empty(states, [("a", "u8"), ("b", "u8")])
            mark["a"], mark["b"] = marks
            _, kept, number = np.unique(mark, return_index=True, return_inverse=True)
            sizes = np.diff(start)[kept]
            at = np.repeat(start[kept] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
            levels.append((np.concatenate([[0], np.cumsum(sizes)]), symbol[at], weight[at], target[at]))
            target = number.astype(np.int64)
        return cls(levels[::-1])

    def to_levels(self) -> Levels:
        """All paths, as a tree."""
        tree = Levels([], [], [])
        state = np.zeros(1, np.int64)
        for start, symbol, weight, target in self.levels:
            sizes = start[state + 1] - start[state]
            at = np.repeat(start[state] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
            tree.parents.append(np.repeat(np.arange(len(state)), sizes))
            tree.symbols.append(symbol[at])
            tree.weights.append(weight[at])
            state = target[at]
        return tree

    def compose(self, columns: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
        """Weights of given paths (symbol columns, 0 past the end); 0 where there is none."""
        n = len(sizes)
        state, live, weight = np.zeros(n, np.int64), np.ones(n, bool), np.zeros(n, np.int64)
        for k, (start, symbol, w, target) in enumerate(self.levels):
            rows = np.flatnonzero(live & (sizes > k))
            if not len(rows) or not len(symbol):
                break
            # transitions are sorted by (state, symbol): one search for both
            key = np.empty(len(symbol), [("s", "u8"), ("x", "u8")])
            key["s"], key["x"] = np.repeat(np.arange(len(start) - 1), np.diff(start)), symbol
            ask = np.empty(len(rows), key.dtype)
            ask["s"], ask["x"] = state[rows], columns[k][rows]
            both, where = np.unique(np.concatenate([key, ask]), return_inverse=True)
            place = np.full(len(both), -1, np.int64)
            place[where[:len(key)]] = np.arange(len(key))
            at = place[where[len(key):]]
            live[rows[at < 0]] = False
            rows, at = rows[at >= 0], at[at >= 0]
            ends = sizes[rows] == k + 1
            weight[rows[ends]] = w[at[ends]]
            state[rows] = target[at]
        return weight

    def dump(self) -> bytes:
        parts = [np.asarray([len(self.levels)], "<u4").tobytes()]
        for start, symbol, weight, target in self.levels:
            kind = "<u4" if not len(weight) or weight.max() < 1 << 32 else "<u8"
            parts.append(np.asarray([len(start) - 1, len(symbol), int(kind[-1])], "<u4").tobytes())
            parts += [np.diff(start).astype("<u4").tobytes(), symbol.astype("<u8").tobytes(),
                      weight.astype(kind).tobytes(), target.astype("<u4").tobytes()]
        return b"".join(parts)

    @classmethod
    def load(cls, data: bytes) -> CountTransducer:
        at = 4

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        levels = []
        for _ in range(int(np.frombuffer(data, "<u4", 1)[0])):
            states, arcs, wide = (int(x) for x in take("<u4", 3))
            start = np.concatenate([[0], np.cumsum(take("<u4", states).astype(np.int64))])
            levels.append((start, take("<u8", arcs).astype(np.uint64), take(f"<u{wide}", arcs).astype(np.int64),
                           take("<u4", arcs).astype(np.int64)))
        return cls(levels)


def gram_keys(columns: list[np.ndarray], sizes: np.ndarray) -> list[bytes]:
    """N-grams as bytes that sort like them: 8 big-endian bytes a word."""
    packed = np.stack(columns, axis=1).astype(">u8")
    data, width = packed.tobytes(), 8 * len(columns)
    return [data[i * width:i * width + 8 * s] for i, s in enumerate(sizes.tolist())]


def key_columns(keys: list[bytes], depth: int) -> tuple[list[np.ndarray], np.ndarray]:
    data = b"".join(k.ljust(8 * depth, b"\0") for k in keys)
    table = np.frombuffer(data, ">u8").reshape(len(keys), depth).astype(np.uint64)
    return [table[:, k].copy() for k in range(depth)], np.asarray([len(k) // 8 for k in keys], np.int64)


def transducer_of(columns: list[np.ndarray], sizes: np.ndarray, weights: np.ndarray) -> tuple[CountTransducer, Levels]:
    """The transducer of n-grams in any order; weights of equal ones add up."""
    symbols, number = np.unique(np.concatenate(columns), return_inverse=True)
    number = number.reshape(len(columns), -1)
    numbered = [np.where(sizes > k, number[k], _NONE) for k in range(len(columns))]
    adds = [np.where(sizes == k + 1, weights, 0) for k in range(len(columns))]
    tree = Levels.from_grams(numbered, adds, symbols)
    return CountTransducer.from_levels(tree), tree


# -- shards ------------------------------------------------------------------

def lang_seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass")))


def pair_code(lang: str, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    code = (first ^ lang_seed(lang)) * _MIX + second
    code ^= code >> np.uint64(31)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    return code ^ (code >> np.uint64(29))


class Shard:
    """Texts of one language, up to a bounded number of words."""

    def __init__(self, lang: str):
        self.lang = lang
        self.known: dict[bytes, int] = {b".": 0}
        self.parts: list[np.ndarray] = []
        self.words = 0

    def add(self, texts: list[str]) -> None:
        data = ".".join([*texts, ""]).encode("utf-8", "surrogatepass").translate(_TABLE).replace(b".", b" . ")
        words = data.split()
        known = self.known
        for word in set(words).difference(known):
            known[word] = len(known)
        ids = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
        self.parts.append(ids)
        self.words += int(np.count_nonzero(ids))

    def sequence(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(symbol numbers in text order, -1 at piece ends; the sorted symbols; their words)."""
        words = list(self.known)[1:]
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        order = np.argsort(hashes)
        number = np.full(len(words) + 1, _NONE)
        number[order + 1] = np.arange(len(words))
        return number[np.concatenate(self.parts)], hashes[order], [words[i] for i in order]

    def pairs(self) -> Levels:
        ids, symbols, _ = self.sequence()
        after = np.concatenate([ids[1:], [_NONE]])
        keep = ids >= 0
        return Levels.from_grams([ids[keep], after[keep]], [None, None], symbols)

    def longer(self, table: np.ndarray, max_words: int) -> tuple[Levels | None, np.ndarray, list[bytes]]:
        """N-grams of 3 words or more in which the bit table holds every pair (one
        and two words weigh nothing here); the words of the pairs it holds."""
        ids, symbols, words = self.sequence()
        a, b = ids[:-1], ids[1:]
        held = (a >= 0) & (b >= 0)
        at = np.flatnonzero(held)
        held[at] = bit_held(table, pair_code(self.lang, symbols[a[at]], symbols[b[at]]))
        used = np.unique(np.concatenate([a[held], b[held]]))
        n = len(ids)
        fits, columns = np.zeros(n, bool), [ids]
        fits[:-1] = held
        for k in range(1, max_words):
            column = np.full(n, _NONE)
            left = max(n - k, 0)
            column[:left] = np.where(fits[:left], ids[k:], _NONE)
            columns.append(column)
            fits[:left] &= np.concatenate([held, [False]])[k:]
            fits[left:] = False
        rows = np.flatnonzero(columns[2] >= 0) if max_words > 2 else np.zeros(0, np.int64)
        if not len(rows):
            return None, symbols[used], [words[i] for i in used]
        none = np.zeros(len(rows), np.int64)
        tree = Levels.from_grams([c[rows] for c in columns], [none, none, *([None] * (max_words - 2))], symbols)
        return tree, symbols[used], [words[i] for i in used]


BLOCK_DDL = "lang string, words long, grams long, marks array<binary>, block binary, symbols array<binary>, texts array<string>"


def _blocks(lang: str, words: int, tree: Levels | None, symbols: np.ndarray, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Rows of a shard: its transducer in blocks; words and texts on the first."""
    names = ["lang", "words", "grams", "marks", "block", "symbols", "texts"]
    columns, sizes, weights, order = tree.grams() if tree else ([], np.zeros(0), np.zeros(0), np.zeros(0, np.int64))
    if len(order):                              # prefixes that weigh nothing are there by their extensions
        order = order[weights[order] > 0]
    spelled, keys = [t.decode("utf-8", "surrogatepass") for t in texts], gram_keys([symbols], np.ones(len(symbols), np.int64))
    for lo in range(0, max(len(order), 1), BLOCK_GRAMS):
        part = order[lo:lo + BLOCK_GRAMS]
        cols, size = [c[part] for c in columns], sizes[part]
        block = transducer_of(cols, size, weights[part])[0].dump() if len(part) else None
        # places that differ from shard to shard: all shards hold much the same n-grams in the same order
        places = np.random.default_rng([words, lo, len(part)]).integers(len(part), size=-(-len(part) // MARK_GRAMS)) if len(part) else []
        marks = gram_keys([c[places] for c in cols], size[places]) if len(part) else []
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([0 if lo else words], pa.int64()), pa.array([len(part)], pa.int64()),
             pa.array([marks], pa.list_(pa.binary())), pa.array([block], pa.binary()),
             pa.array([[] if lo else keys], pa.list_(pa.binary())),
             pa.array([[] if lo else spelled], pa.list_(pa.string()))], names)


def shards(docs: DataFrame, text_col: str, lang_col: str, max_words: int, table=None) -> DataFrame:
    """Blocks of all shards (``BLOCK_DDL``); pairs without a ``table`` (a
    broadcast bit table), else 3 to ``max_words`` words."""

    def rows(shard: Shard) -> Iterator[pa.RecordBatch]:
        if table is None:
            yield from _blocks(shard.lang, shard.words, shard.pairs(), np.zeros(0, np.uint64), [])
        else:
            yield from _blocks(shard.lang, shard.words, *shard.longer(table.value, max_words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, Shard] = {}
        for batch in text_slices(batches):
            texts = batch.column(0).to_pylist()
            langs = batch.column(1).to_pylist()
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(texts, langs):
                if text:
                    by_lang.setdefault(lang, []).append(text)
            for lang, own in by_lang.items():
                if lang not in open_:
                    open_[lang] = Shard(lang)
                open_[lang].add(own)
            while sum(s.words for s in open_.values()) > SHARD_WORDS or sum(len(s.known) for s in open_.values()) > SHARD_VOCABULARY:
                yield from rows(open_.pop(max(open_, key=lambda key: (open_[key].words, key))))
        for lang in sorted(open_):
            yield from rows(open_[lang])

    return (docs.select(text_col, F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("__lang"))
            .mapInArrow(run, BLOCK_DDL))


# -- unions by prefix range --------------------------------------------------

def range_cuts(keys: DataFrame, total: int, size: int) -> list[tuple[str, bytes]]:
    """First keys (lang, first) of all prefix ranges but the first, for ranges of
    about ``size`` of ``total``: quantiles of the ``keys`` (lang, first) with the
    smallest hashes (``SAMPLE_MARKS`` rows at most)."""
    ranges = min(-(-total // size), SAMPLE_MARKS)
    if ranges < 2:
        return []
    sample = sorted((r["lang"], bytes(r["first"])) for r in keys.orderBy(F.xxhash64("lang", "first"), "lang", "first")
                    .limit(SAMPLE_MARKS).collect())
    ranges = min(ranges, len(sample))
    return sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)})


def block_cuts(blocks: DataFrame) -> list[tuple[str, bytes]]:
    held = blocks.where("block is not null")
    return range_cuts(held.select("lang", F.explode("marks").alias("first")), held.agg(F.sum("grams")).first()[0] or 0, RANGE_GRAMS)


def _deal(df: DataFrame, cuts: list, *keys: str) -> DataFrame:
    """Ranges over tasks: about as many tasks as ranges, however large they are."""
    n = max(len(cuts) + 1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *keys)


def frequent_grams(blocks: DataFrame, cuts: list[tuple[str, bytes]], depth: int, min_count: int) -> DataFrame:
    """(lang, gram, size, n, code): n-grams whose summed weight is ``min_count`` or
    more; ``code`` is the pair code of pairs."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                columns, sizes, weights, order = CountTransducer.load(data.as_buffer().to_pybytes()).to_levels().grams()
                order = order[weights[order] > 0]
                keys = gram_keys([columns[0][order], *(c[order] for c in columns[1:])], sizes[order])
                first = bisect.bisect_right(cuts, (lang, keys[0]))
                last = bisect.bisect_right(cuts, (lang, keys[-1]))
                edges = [0, *(bisect.bisect_left(keys, cuts[c][1]) for c in range(first, last)), len(keys)]
                for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
                    if lo < hi:
                        part = order[lo:hi]
                        own = data.as_buffer().to_pybytes() if hi - lo == len(keys) else \
                            transducer_of([c[part] for c in columns], sizes[part], weights[part])[0].dump()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang]), pa.array([first + k], pa.int32()), pa.array([own], pa.binary())],
                            ["lang", "part", "block"])

    def union(key, table):
        lang = key[0].as_py()
        columns, sizes, weights = [[] for _ in range(depth)], [], []
        for data in table.column("block"):
            cols, size, weight, _ = CountTransducer.load(data.as_buffer().to_pybytes()).to_levels().grams()
            held = weight > 0
            for k in range(depth):
                columns[k].append(cols[k][held])
            sizes.append(size[held])
            weights.append(weight[held])
        _, tree = transducer_of([np.concatenate(c) for c in columns], np.concatenate(sizes), np.concatenate(weights))
        cols, size, weight, order = tree.grams()
        order = order[weight[order] >= min_count]
        cols, size, weight = [c[order] for c in cols], size[order], weight[order]
        code = pair_code(lang, cols[0], cols[1]).view(np.int64)
        return pa.table([pa.array([lang] * len(size), pa.string()), pa.array(gram_keys(cols, size), pa.binary()),
                         pa.array(size.astype(np.int32)), pa.array(weight), pa.array(code, mask=size != 2)],
                        names=["lang", "gram", "size", "n", "code"])

    dealt = _deal(blocks.where("block is not null").select("lang", "block")
                  .mapInArrow(deal, "lang string, part int, block binary"), cuts, "lang", "part")
    return dealt.groupBy("lang", "part").applyInArrow(union, "lang string, gram binary, size int, n long, code long")


def count_grams(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
                min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent n-grams (lang, gram, size, n); words per language (lang, total);
    the words behind the symbols of frequent pairs (symbol, word)."""
    spark = docs.sparkSession
    short = materialise(shards(docs, text_col, lang_col, 2), "pair-shards")
    totals = short.groupBy("lang").agg(F.sum("words").alias("total"))
    few = materialise(frequent_grams(short, block_cuts(short), 2, min_count), "frequent-pairs")
    table = spark.sparkContext.broadcast(bit_table(few.where("size = 2"), "code"))       # size bounded
    long_ = materialise(shards(docs, text_col, lang_col, max_words, table), "phrase-shards")
    many = materialise(frequent_grams(long_, block_cuts(long_), max_words, min_count), "frequent-phrases")
    grams = few.unionByName(many).drop("code")
    words = long_.select(F.explode(F.arrays_zip("symbols", "texts")).alias("w")).select("w.symbols", "w.texts")
    words = words.groupBy(F.col("symbols").alias("symbol")).agg(F.min("texts").alias("word"))
    return grams, totals, words


# -- parts, scores, ranks ----------------------------------------------------

def compose_parts(grams: DataFrame, parts: DataFrame, max_words: int) -> DataFrame:
    """(lang, part, weight): the weights of distinct ``parts`` (lang, part), composed
    with the transducer of the frequent n-grams of their prefix range.  Ranges
    are cut at a bounded sample of the n-grams."""
    cuts = range_cuts(grams.select("lang", F.col("gram").alias("first")), grams.count(), COMPOSE_GRAMS)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield batch.append_column("range", pa.array([bisect.bisect_right(cuts, k) for k in keys], pa.int32()))

    def walk(key, held, asked):
        keys = asked.column("part").to_pylist()
        if held.num_rows:
            columns, sizes = key_columns(held.column("part").to_pylist(), max_words)
            machine = transducer_of(columns, sizes, held.column("n").to_numpy())[0]
            weight = machine.compose(*key_columns(keys, max_words)) if keys else np.zeros(0, np.int64)
        else:
            weight = np.zeros(len(keys), np.int64)
        return pa.table([asked.column("lang"), asked.column("part"), pa.array(weight)], names=["lang", "part", "weight"])

    held = grams.select("lang", F.col("gram").alias("part"), "n").mapInArrow(route, "lang string, part binary, n long, range int")
    asked = parts.select("lang", "part").mapInArrow(route, "lang string, part binary, range int")
    held, asked = _deal(held, cuts, "lang", "range"), _deal(asked, cuts, "lang", "range")
    return (held.groupBy("lang", "range").cogroup(asked.groupBy("lang", "range"))
            .applyInArrow(walk, "lang string, part binary, weight long"))


def _first(df: DataFrame, top: int, order: list[Column], ties: bool) -> DataFrame:
    """Each language's first ``top`` rows, salted first so that no task meets a
    whole language; with ``ties`` also those equal to the last."""
    rank = F.rank() if ties else F.row_number()
    slot = F.pmod(F.xxhash64("lang", "gram"), F.lit(64))
    some = (df.withColumn("__r", rank.over(Window.partitionBy("lang", slot).orderBy(*order))).where(F.col("__r") <= top))
    return some.withColumn("__r", rank.over(Window.partitionBy("lang").orderBy(*order))).where(F.col("__r") <= top)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
                 min_count: int = MIN_COUNT, top: int = TOP, cover_percent: int = COVER_PERCENT) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score."""
    grams, totals, words = count_grams(docs, text_col, lang_col, max_words, min_count)
    phrases = grams.where("size > 1")
    # a phrase inside a longer one is inside one with a word more, at either end, that is at least as frequent
    longer = phrases.where("size > 2")
    inner = [F.expr("substring(gram, 1, 8 * (size - 1))"), F.expr("substring(gram, 9, 8 * (size - 1))")]
    covers = (longer.select("lang", F.explode(F.array(*inner)).alias("gram"), "n").groupBy("lang", "gram")
              .agg(F.max("n").alias("longer")))
    kept = (phrases.join(covers, ["lang", "gram"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < cover_percent * F.col("n"))).drop("longer"))
    kept = materialise(kept, "candidates")
    cuts = kept.select("lang", "gram", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    sides = [F.struct(F.lit("l").alias("side"), F.expr("substring(gram, 1, 8 * k)").alias("part")),
             F.struct(F.lit("r").alias("side"), F.expr("substring(gram, 8 * k + 1, 8 * (size - k))").alias("part"))]
    cuts = materialise(cuts.select("lang", "gram", "k", F.inline(F.array(*sides))), "cuts")
    weights = materialise(compose_parts(grams, cuts.select("lang", "part").distinct(), max_words), "part-weights")
    slotted = cuts.withColumn("slot", F.pmod(F.xxhash64("gram"), F.lit(4096)))
    halves = (join_hot(slotted, weights, ["lang", "part"], "slot", "inner").groupBy("lang", "gram", "k")
              .agg(F.max(F.when(F.col("side") == "l", F.col("weight"))).alias("l"),
                   F.max(F.when(F.col("side") == "r", F.col("weight"))).alias("r")))
    rows = halves.join(kept.select("lang", "gram", F.col("n").alias("a")), ["lang", "gram"]).join(totals, "lang")
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r", "total")}
    rows = rows.withColumns({"product": (wide["a"] * wide["total"] * F.lit(1000)).cast("decimal(38,0)"), "parts": wide["l"] * wide["r"]})
    rows = rows.withColumn("score", F.expr("product div parts"))
    best = rows.groupBy("lang", "gram", "a", "total").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    best = materialise(best.select("lang", "gram", "a", F.col("total").alias("n"), "c.score", "c.l", "c.r"), "scores")
    first = _first(best, top, [F.desc("score"), F.desc("a")], True)
    # spell the phrases that may be among the first
    at = F.expr("transform(sequence(0, length(gram) div 8 - 1), i -> "
                "named_struct('i', i, 'symbol', substring(gram, 8 * i + 1, 8)))")
    first = materialise(first.drop("__r"), "first")
    spelled = (first.select("lang", "gram", F.inline(at)).join(words, "symbol").groupBy("lang", "gram")
               .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "word"))), lambda w: w["word"]), " ")
                    .alias("phrase")))
    out = _first(first.join(spelled, ["lang", "gram"]), top, [F.desc("score"), F.desc("a"), F.asc("phrase")], False)
    return out.select("lang", F.col("__r").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
