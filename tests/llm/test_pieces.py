import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tests.llm.helpers import documents, prose
from tillflow.llm.pieces import CharMap, decode_documents, digest_documents, encode_documents, model

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", " a", "a ", "  a   b  ", "\n", "a\nb", "a \n b", "\n\n a", "tab\there", "▁", "a▁b", "中文 日本", "😀 x😀", "é é", "\x00\x01",
       "x" * 500, " " * 40 + "x", "\r\n", " nb", "<s></s><unk>", "<0x0A>", "﷽ ½ ﬁ"]


def texts():
    rng = random.Random(7)
    out = ODD + [prose(rng, rng.choice([3, 60, 500])) for _ in range(40)]
    return out + ["".join(rng.choice("ab \n▁é中😀\t.") for _ in range(40)) for _ in range(400)]


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_and_decoding_equal_the_library(lib):
    m = model(PATH)
    assert m.separable
    for t in texts():
        ids = lib.encode(t)
        assert m.ids(t).tolist() == ids, repr(t)
        assert m.decode(ids) == lib.decode(ids), repr(t)


def test_spans_cover_the_text_in_order(lib):
    m = model(PATH)
    for t in texts():
        e = m.encode(t)
        data = t.encode()
        if not data:
            assert not len(e.ids)
            continue
        assert e.begin[0] == 0 and e.end[-1] == len(data)
        assert (e.begin[1:] == e.end[:-1]).all() or "▁" in t
        for piece, a, b in zip(e.ids.tolist(), e.begin.tolist(), e.end.tolist()):
            raw = m.plain[piece]
            assert data[a:b] == raw or (a == 0 and b" " + data[a:b] == raw) or "▁" in t, (t, piece, a, b)


def test_character_map_equals_the_library_normaliser():
    rule = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=False, escape_whitespaces=False,
                                                 remove_extra_whitespaces=False)
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.ParseFromString(rule.serialized_model_proto())
    charmap = CharMap(bytes(proto.normalizer_spec.precompiled_charsmap))
    assert not charmap.empty
    rng = random.Random(3)
    pool = "ab①ﬁ½Å̊é éＡＢｶﾞ　 \t㍿ẛ̣한中😀"
    for t in ["ﬁne ½ Ａ", "é", "ｶﾞ", *("".join(rng.choice(pool) for _ in range(20)) for _ in range(300))]:
        norm, source = charmap.normalise(t.encode())
        assert norm.decode() == rule.normalize(t), repr(t)
        assert len(source) == len(norm) + 1 and (np.diff(source) >= 0).all() and source[-1] == len(t.encode())
    norm, source = charmap.normalise("xﬁy".encode())
    assert norm == b"xfiy" and source.tolist() == [0, 1, 1, 4, 5]      # both letters come from the ligature's bytes


def variant(tmp_path, change) -> str:
    """A model file with other settings."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.ParseFromString(sentencepiece.SentencePieceProcessor(model_file=PATH).serialized_model_proto())
    change(proto, pb)
    path = tmp_path / "variant.model"
    path.write_bytes(proto.SerializeToString())
    return str(path)


def trimming(proto, pb):
    proto.normalizer_spec.remove_extra_whitespaces = True


def mapped(proto, pb):
    trimming(proto, pb)
    rule = pb.ModelProto()
    rule.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    proto.normalizer_spec.precompiled_charsmap = rule.normalizer_spec.precompiled_charsmap


def mapped_untrimmed(proto, pb):
    mapped(proto, pb)
    proto.normalizer_spec.remove_extra_whitespaces = False


def without_bytes(proto, pb):
    mapped(proto, pb)
    proto.trainer_spec.byte_fallback = False
    for p in proto.pieces:
        if p.type == pb.ModelProto.SentencePiece.BYTE:
            p.type = pb.ModelProto.SentencePiece.UNUSED


def unigram(proto, pb):
    without_bytes(proto, pb)
    proto.trainer_spec.model_type = 1


def symbols(proto, pb):
    mapped(proto, pb)
    for name in ("abﬁ", "ﬁx", "xﬁ½"):
        proto.pieces.add(piece=name, score=0.0, type=pb.ModelProto.SentencePiece.USER_DEFINED)


def suffix(proto, pb):
    mapped(proto, pb)
    proto.trainer_spec.treat_whitespace_as_suffix = True


def no_prefix(proto, pb):
    trimming(proto, pb)
    proto.normalizer_spec.add_dummy_prefix = False


@pytest.mark.parametrize("change", [trimming, mapped, mapped_untrimmed, without_bytes, unigram, symbols, suffix, no_prefix])
def test_ids_offsets_and_decoding_of_other_models(tmp_path, change):
    path = variant(tmp_path, change)
    lib, m = sentencepiece.SentencePieceProcessor(model_file=path), model(path)
    assert not m.separable
    rng = random.Random(11)
    pool = ["a", "b", " ", "  ", "\n", "ﬁ", "ﬁx", "x", "½", "　", "é", "é", "Ａ", "中", "😀", "▁", "\t", "\u200b", "¨", "the ", "hello", "\u00ad", "㍿", "ଅ", "abﬁ"]
    cases = ["hello   world", "  hello world  ", "   ", " ¨ a ", "\u200b  a", *ODD, *("".join(rng.choices(pool, k=rng.randrange(1, 25))) for _ in range(500))]
    for t in cases:
        e = m.encode(t)
        want = lib.encode(t, return_type="proto")
        assert e.ids.tolist() == [p.id for p in want.pieces], repr(t)
        assert m.decode(e.ids.tolist()) == lib.decode(e.ids.tolist()), repr(t)
        data, at = t.encode(), 0
        for p, a, b in zip(want.pieces, e.begin.tolist(), e.end.tolist()):
            if not lib.is_byte(p.id):
                assert (a, b) == (p.begin, p.end), (t, p.piece)
            assert at <= a <= b <= len(data)
            at = a


def test_documents_round_trip(spark, lib):
    rng = random.Random(8)
    rows = list(enumerate(texts()[:60])) + [(900, None), (None, "x y"), (5, "again"), (901, prose(rng, 20_000))]
    df = documents(spark, rows, clash=True)
    enc = encode_documents(df, PATH)
    for r in enc.collect():
        assert len(r.ids) == len(r.begins) == len(r.ends)
    back = sorted([tuple(r) for r in decode_documents(enc, PATH).collect()], key=str)
    want = sorted([(d, lib.decode(lib.encode(t or ""))) for d, t in rows], key=str)
    assert back == want
    got = sorted([(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digest_documents(df, PATH).collect()], key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = [(d, lib.encode(t or "")) for d, t in rows]
    assert got == sorted([(d, len(x), sha(",".join(map(str, x))), sha(lib.decode(x))) for d, x in ids], key=str)
    assert digest_documents(documents(spark, []), PATH).collect() == []
