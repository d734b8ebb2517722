"""Offset-preserving SentencePiece encoding (byte-pair models).

1. Normalisation.  The model's compiled character map is a double-array trie
   plus a table of replacement strings.  At each place the longest key of the
   trie that is a prefix of the rest is replaced; without one, one character is
   copied.  For every normalised byte the source byte it came from is recorded.
   White space handling (dummy prefix, removal of extra spaces, escaping) is
   part of the same pass.  A model with an empty map copies characters, and the
   alignment is then known without a table.
2. Segmentation.  Adjacent symbols merge in the order of piece score, leftmost
   first.  A merge across two characters makes a piece that holds them side by
   side; where no piece of the model does, the text can be cut without changing
   the result (before most space marks and punctuation).  The pieces of each cut
   are remembered (bounded memory).
3. Projection.  Each piece's normalised byte span is mapped back to the span of
   original UTF-8 bytes.

Defined cases: a NULL text counts as empty; an empty text has no pieces;
repeated rows give repeated rows; texts of any length are encoded whole; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import text_slices

MARK = "▁"
CACHE_CHUNKS = 150_000
SHORT_CHUNK = 48
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class CharacterMap:
    """Longest-prefix replacement through a compiled (double-array) map."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.strings = blob[4 + size:] if blob else b""

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(source bytes consumed, replacement) of the longest key at ``at``."""
        if not self.units:
            return None
        units, end, best = self.units, len(data), None
        unit = units[0]
        node = (unit >> 10) << ((unit & 0x200) >> 6)
        i = at
        while i < end:
            byte = data[i]
            node ^= byte
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            i += 1
            if unit & 0x100:
                value = units[node] & 0x7FFFFFFF
                best = (i - at, value)
        if best is None:
            return None
        return best[0], self.strings[best[1]:self.strings.index(b"\0", best[1])]


def _char_length(data: bytes, at: int) -> int:
    lead = data[at]
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Normalizer:
    def __init__(self, charsmap: bytes, add_dummy_prefix: bool, remove_extra_whitespaces: bool,
                 escape_whitespaces: bool, whitespace_as_suffix: bool = False):
        self.map = CharacterMap(charsmap)
        self.dummy, self.squeeze, self.escape = add_dummy_prefix, remove_extra_whitespaces, escape_whitespaces
        self.suffix = whitespace_as_suffix
        self.plain = not self.map.units and not self.squeeze and self.escape and not self.suffix

    def _step(self, data: bytes, at: int) -> tuple[int, bytes]:
        found = self.map.longest(data, at)
        if found:
            return found
        n = _char_length(data, at)
        return n, data[at:at + n]

    def normalize(self, text: str) -> tuple[str, list[int]]:
        """(normalised text, for each of its UTF-8 bytes and its end the source byte)."""
        data = text.encode("utf-8", "replace")
        space = MARK.encode() if self.escape else b" "
        out, align, at, end = bytearray(), [], 0, len(data)
        if self.squeeze:
            while at < end:
                n, piece = self._step(data, at)
                if piece != b" ":
                    break
                at += n
        if at >= end:
            return "", [0]
        if self.dummy and not self.suffix:
            out += space
            align += [at] * len(space)
        after_space = self.squeeze
        while at < end:
            n, piece = self._step(data, at)
            while after_space and piece.startswith(b" "):
                piece = piece[1:]
            if piece:
                for byte in piece:
                    if byte == 0x20 and self.escape:
                        out += space
                        align += [at] * len(space)
                    else:
                        out.append(byte)
                        align.append(at)
                after_space = piece.endswith(b" ")
            at += n
            if not self.squeeze:
                after_space = False
        if self.squeeze:
            while out.endswith(space):
                del out[-len(space):]
                at = align[len(out)]
                del align[len(out):]
        if self.dummy and self.suffix:
            out += space
            align += [at] * len(space)
        align.append(at)
        return out.decode("utf-8"), align


LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"


def _cutter(pieces) -> Callable[[str], list[str]]:
    """A function that cuts a normalised text only between characters that no
    piece holds side by side: before a space mark after something else, between
    a letter and punctuation that follows no letter in any piece, and around
    line ends if no longer piece holds one."""
    pairs = {a + b for p in pieces for a, b in zip(p, p[1:])}
    if any(x[1] == MARK != x[0] for x in pairs):
        return lambda text: [text]
    letter = re.compile(f"[{LETTERS}]").match
    after_letter = {x[1] for x in pairs if letter(x)}
    line = "" if any("\n" in x for x in pairs) else "\n"
    closed = "".join(re.escape(c) for c in map(chr, range(33, 127)) if not c.isalnum() and c not in after_letter)
    return re.compile(("\n|" if line else "") + f"{MARK}*[{LETTERS}]+(?=[{MARK}{closed}{line}]|\\Z)|"
                      f"{MARK}*[^{MARK}{line}]+|{MARK}+").findall


class PieceModel:
    """A byte-pair SentencePiece model read from its file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as model_pb

        proto = model_pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        if proto.trainer_spec.model_type != 2:
            raise ValueError("a byte-pair model is needed")
        spec = proto.normalizer_spec
        self.normalizer = Normalizer(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces,
                                     spec.escape_whitespaces, proto.trainer_spec.treat_whitespace_as_suffix)
        self.pieces = [p.piece for p in proto.pieces]
        self.score, self.id, self.byte_id, self.unk, unused = {}, {}, {}, 0, False
        self.user: list[str] = []
        for i, p in enumerate(proto.pieces):
            if p.type in (NORMAL, USER_DEFINED, UNUSED):
                self.id[p.piece], self.score[p.piece] = i, p.score
                unused |= p.type == UNUSED
                if p.type == USER_DEFINED:
                    self.user.append(p.piece)
            elif p.type == BYTE:
                self.byte_id[int(p.piece[1:-1], 16)] = i
            elif p.type == UNKNOWN:
                self.unk = i
        if unused or self.user:
            raise ValueError("models with unused or user-defined pieces are not supported")
        self.byte_fallback = proto.trainer_spec.byte_fallback
        self.size = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.text = [str(i) for i in range(len(proto.pieces))]
        self.cut = _cutter(self.id)
        self.cache: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def merge(self, text: str) -> list[str]:
        """Pieces of a normalised text: best score first, then leftmost."""
        return self._merge_short(text) if len(text) <= SHORT_CHUNK else self._merge_long(text)

    def _merge_short(self, text: str) -> list[str]:
        parts, score, none = list(text), self.score.get, float("-inf")
        scores = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == none:
                break
            i = scores.index(best)
            parts[i] += parts.pop(i + 1)
            del scores[i]
            if i < len(scores):
                scores[i] = score(parts[i] + parts[i + 1], none)
            if i:
                scores[i - 1] = score(parts[i - 1] + parts[i], none)
        return parts

    def _merge_long(self, text: str) -> list[str]:
        symbols: list[str | None] = list(text)
        n = len(symbols)
        score = self.score
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            s = score.get(symbols[i] + symbols[i + 1])
            if s is not None:
                agenda.append((-s, i, i + 1, len(symbols[i]) + len(symbols[i + 1])))
        heapq.heapify(agenda)
        while agenda:
            _, i, j, size = heapq.heappop(agenda)
            a, b = symbols[i], symbols[j]
            if a is None or b is None or after[i] != j or len(a) + len(b) != size:
                continue
            symbols[i], symbols[j] = a + b, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                s = score.get(symbols[i] + symbols[k])
                if s is not None:
                    heapq.heappush(agenda, (-s, i, k, size + len(symbols[k])))
            h = before[i]
            if h >= 0:
                s = score.get(symbols[h] + symbols[i])
                if s is not None:
                    heapq.heappush(agenda, (-s, h, i, len(symbols[h]) + size))
        return [s for s in symbols if s is not None]

    def chunk(self, text: str) -> tuple[int, ...]:
        """Ids of one cut."""
        found = self.older.get(text)
        if found is None:
            found = self._chunk(text)
        if len(text) <= SHORT_CHUNK:
            if len(self.cache) >= CACHE_CHUNKS:       # two generations bound the memory
                self.older, self.cache = self.cache, {}
            self.cache[text] = found
        return found

    def _chunk(self, text: str) -> tuple[int, ...]:
        ids = []
        for piece in self.merge(text):
            i = self.id.get(piece)
            if i is not None:
                ids.append(i)
            elif self.byte_fallback:
                ids += [self.byte_id[b] for b in piece.encode()]
            else:
                ids.append(~ord(piece))       # a character without a piece; see _join_unknown
        return tuple(ids)

    def _join_unknown(self, ids: list[int]) -> tuple[list[int], list[int]]:
        """Neighbouring characters without a piece become one unknown id."""
        out, sizes, open_ = [], [], False
        for i in ids:
            size = self.size[i] if i >= 0 else len(chr(~i).encode())
            if i < 0 and open_:
                sizes[-1] += size
                continue
            open_ = i < 0
            out.append(self.unk if open_ else i)
            sizes.append(size)
        return out, sizes

    def encode(self, text: str) -> tuple[list[int], np.ndarray]:
        """(ids, original byte spans as an n x 2 array)."""
        if not text:
            return [], np.zeros((0, 2), np.int32)
        if self.normalizer.plain:
            normal = text.replace(" ", MARK)
            normal, align = (MARK + normal if self.normalizer.dummy else normal), None
        else:
            normal, align = self.normalizer.normalize(text)
        ids = list(chain.from_iterable([self.cache.get(part) or self.chunk(part) for part in self.cut(normal)]))
        if self.byte_fallback:
            sizes = self.size[np.fromiter(ids, np.int32, len(ids))]
        else:
            ids, sizes = self._join_unknown(ids)
        ends = np.cumsum(sizes)
        if align is None:
            align = self._plain_alignment(text)
        table = np.asarray(align, np.int64)
        spans = np.empty((len(ends), 2), np.int32)
        if len(ends):
            spans[1:, 0] = table[ends[:-1]]
            spans[0, 0] = table[0]
            spans[:, 1] = table[ends]
        return ids, spans

    def names(self, ids: list[int]) -> str:
        """The ids as decimal text, joined by commas."""
        text = self.text
        return ",".join([text[i] for i in ids])

    def _plain_alignment(self, text: str) -> np.ndarray:
        """Alignment when characters are copied and only spaces are escaped."""
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        width = np.where(raw == 0x20, 3, 1)
        table = np.repeat(np.arange(len(raw)), width)
        head = np.zeros(3 if self.normalizer.dummy else 0, np.int64)
        return np.concatenate([head, table, [len(raw)]])


@lru_cache(maxsize=4)
def load_model(path: str) -> PieceModel:
    return PieceModel(path)


@lru_cache(maxsize=4)
def load_decoder(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


DIGEST_DDL = ("n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long, "
              "n_bytes long")
_DIGEST_TYPES = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     digests: bool = False) -> DataFrame:
    """One row per document.  ``digests=False``: ids, begins, ends (arrays; the
    spans are original UTF-8 bytes).  ``digests=True``: the number of ids, the
    SHA-256 of the ids as text, of the decoded text, and a CRC-32 of the spans.
    No shuffle; the model file must be at ``model_path`` on every host."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, decoder = load_model(model_path), load_decoder(model_path)
        for batch in text_slices(batches, max_bytes=1 << 20):
            out = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                ids, spans = model.encode(text)
                if digests:
                    decoded = decoder.decode(ids) if ids else ""
                    out.append((len(ids), hashlib.sha256(model.names(ids).encode()).hexdigest(),
                                hashlib.sha256(decoded.encode("utf-8")).hexdigest(),
                                zlib.crc32(spans.tobytes()), int(spans[-1, 1]) if len(spans) else 0))
                else:
                    out.append((ids, spans[:, 0].tolist(), spans[:, 1].tolist()))
            names_, kinds = ((["n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32", "n_bytes"], _DIGEST_TYPES)
                             if digests else (["ids", "begins", "ends"], [pa.list_(pa.int32())] * 3))
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, *names_])

    ddl = DIGEST_DDL if digests else "ids array<int>, begins array<int>, ends array<int>"
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, {ddl}")
