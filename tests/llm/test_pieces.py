import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as model_pb

from strata.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)


def odd_texts():
    rng = random.Random(1)
    return ["".join(rng.choice(" ▁abthe\n.,é日<>0x😀\tT") for _ in range(rng.randint(0, 60))) for _ in range(400)] + ["x" * 3000, "the " * 500, "　", "ﬁ"]


def library_spans(text):
    """The library's spans; where a character is spelled in bytes, it gives all
    of it to the last one, and here each byte has its own."""
    out = []
    for p in LIB.encode(text, return_type="proto").pieces:
        at = out[-1][1] if out else 0
        out.append((at, at + 1) if LIB.is_byte(p.id) else (p.begin, p.end))
    return out


def test_ids_and_spans_equal_the_library(texts):
    model = P.PieceModel(PATH)
    for text in [t for t in texts if t] + odd_texts():
        ids, spans = model.encode(text)
        assert ids == LIB.encode(text), text[:60]
        assert [tuple(s) for s in spans.tolist()] == library_spans(text), text[:60]


def test_bounded_memory_does_not_change_ids(texts, monkeypatch):
    monkeypatch.setattr(P, "CACHE_CHUNKS", 5)
    model = P.PieceModel(PATH)
    for text in filter(None, texts):
        assert model.encode(text)[0] == LIB.encode(text)
    assert len(model.cache) <= 5 and len(model.older) <= 5


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "nfkc"])
def test_normalisation_through_a_compiled_map(texts, rule):
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    proto = model_pb.ModelProto()
    proto.ParseFromString(lib.serialized_model_proto())
    spec = proto.normalizer_spec
    own = P.Normalizer(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)
    assert own.map.units
    for text in [t for t in texts if t] + odd_texts() + ["ＡＢＣ ﬁ ①  Å  x ", "Ǆ ㍿ é"]:
        normal, align = own.normalize(text)
        assert normal == lib.normalize(text)
        assert len(align) == len(normal.encode()) + 1 and align == sorted(align)
        assert align[-1] <= len(text.encode())


def test_digests(docs, texts):
    rows = {r["doc_id"]: r for r in P.encode_documents(docs, PATH, digests=True).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        ids = LIB.encode(text or "")
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256((LIB.decode(ids) if ids else "").encode()).hexdigest()
        assert rows[i]["n_bytes"] == len((text or "").encode())


def test_arrays_odd_and_empty_tables(odd_docs, no_docs):
    rows = P.encode_documents(odd_docs, PATH).collect()
    assert len(rows) == odd_docs.count()
    assert all(len(r["ids"]) == len(r["begins"]) == len(r["ends"]) for r in rows)
    assert P.encode_documents(no_docs, PATH).count() == 0
