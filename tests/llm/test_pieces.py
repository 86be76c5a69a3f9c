from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

from obsflow.llm.pieces import CharacterMap, PieceModel, digests, encode_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  a  b", "a\nb\t c", "▁x ▁", "é日本語 🎉", "a" * 3000, "\0 nul", "<s> </s> <0x0A>", "word " * 40_000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_ids_and_text_are_the_librarys(documents, library):
    chance = random.Random(5)
    texts = ODD + ["".join(chance.choice(" ▁\nabcé日.🎉<s>") for _ in range(chance.randrange(50))) for _ in range(200)]
    found = {r.doc_id: r for r in encode_pieces(documents(list(enumerate(texts))), MODEL).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        assert found[i].ids == ids
        assert found[i].decoded == library.decode(ids)


def test_spans_are_the_bytes_of_each_piece(library):
    model = PieceModel(open(MODEL, "rb").read())
    for text in filter(None, ODD):
        ids = model.encode([text])[0]
        begins, ends = model.spans(text, ids)
        theirs = [p for p in library.encode(text, return_type="proto").pieces]
        ours = list(zip(begins.tolist()[1:-1], ends.tolist()[1:-1]))
        assert [s for s, p in zip(ours, theirs) if not library.is_byte(p.id)] == [(p.begin, p.end) for p in theirs if not library.is_byte(p.id)]
        assert all(e - b == 1 for (b, e), p in zip(ours, theirs) if library.is_byte(p.id))


def test_normalising_through_a_compiled_map():
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name="nfkc_cf")
    from sentencepiece import sentencepiece_model_pb2 as proto

    described = proto.ModelProto()
    described.ParseFromString(normalizer.serialized_model_proto())
    known = CharacterMap(described.normalizer_spec.precompiled_charsmap)
    assert known.longest("Ａ".encode(), 0) == (3, b"a")
    assert known.longest("ﬁx".encode(), 0) == (3, b"fi")
    assert known.longest(b"q", 0) is None

    model = PieceModel.__new__(PieceModel)
    model.rules, model.map, model.symbols, model.plain = described.normalizer_spec, known, [], False
    for flags in ((False, False, False), (True, True, True)):
        model.rules.add_dummy_prefix, model.rules.remove_extra_whitespaces, model.rules.escape_whitespaces = flags
        for text in ("Straße ＡＢ ﬁ", "  Éa  ①  ", "é Å"):
            normal, source = model.normalise(text)
            assert len(source) == len(normal) + 1 and list(source) == sorted(source)
            if all(flags):
                assert normal.decode() == normalizer.normalize(text)
    assert model.normalise("ﬁ")[1].tolist()[-3:] == [0, 0, 3]


def test_digests_and_empty_table(documents):
    packed = digests(encode_pieces(documents([(1, "a b"), (None, None), (1, "a b")]), MODEL, packed=True)).collect()
    assert sorted(r.n_tokens for r in packed) == [2, 4, 4]
    assert digests(encode_pieces(documents([]), MODEL, packed=True)).count() == 0
