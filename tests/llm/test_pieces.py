import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from kindred.llm import pieces
from tests.conftest import rows
from tests.llm.texts import documents, frame

PATH = public_tokenizers.path("piece_bpe_32k.model")
MORE = [
    (90, "a  b \n c　 d <0x0A> <unk> </s> it's  "),
    (91, "   lead"),
    (92, "é" * 40 + " 漢字 ﬁ 🙂\t" * 9),
    (93, "aaaaaaaaaaaaaaa bananananana 1234567 ##### ======== 0x0x0x"),
    (94, " "),
    (95, "xyz▁abc ▁▁ q"),
    (96, "The quick brown fox's internationalization; größere Straßenbahnhaltestellen — déjà vu, señorita!"),
]


def test_equals_the_library(spark):
    docs = documents() + MORE
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    want = []
    for doc_id, text in docs:
        ids = library.encode(text or "")
        decoded = library.decode(ids)
        sha = hashlib.sha256(decoded.encode()).hexdigest()
        want.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), sha, True))
    got = pieces.encode(frame(spark, docs), PATH, want_ids=False)
    assert rows(got) == sorted(want, key=repr)


def test_round_trip(spark):
    docs = [(i, t) for i, (_, t) in enumerate(documents())]
    encoded = pieces.encode(frame(spark, docs), PATH)
    assert dict(rows(pieces.decode(encoded, PATH))) == {i: t or "" for i, t in docs}


@pytest.mark.parametrize("text", ["abcab", "cabba", "▁xab", "ab é ab", "c c"])
def test_unigram_models(text):
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.trainer_spec.model_type = pieces.UNIGRAM
    proto.trainer_spec.byte_fallback = True
    proto.normalizer_spec.add_dummy_prefix = True
    proto.normalizer_spec.remove_extra_whitespaces = False
    proto.normalizer_spec.escape_whitespaces = True
    proto.normalizer_spec.name = "identity"
    entries = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)] + [(f"<0x{i:02X}>", 0, 6) for i in range(256)]
    entries += [("▁", -2.0, 1), ("a", -3.1, 1), ("b", -3.3, 1), ("c", -2.7, 1), ("ab", -3.9, 1), ("ca", -4.2, 1), ("abc", -6.05, 1), ("▁c", -3.0, 1)]
    for piece, score, kind in entries:
        proto.pieces.add(piece=piece, score=score, type=kind)
    model = proto.SerializeToString()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    ids = np.frombuffer(pieces.Transducer(model).encode(text), "<u4").tolist()
    assert ids == library.encode(text)


def test_empty_table(spark):
    assert rows(pieces.encode(frame(spark, []), PATH)) == []


@pytest.mark.parametrize("text", [" " * 300_000, "\n" * 300_000, "a" * 300_000, " \n" * 150_000])
def test_long_runs_equal_the_library(text):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert np.frombuffer(pieces.Transducer.of(PATH).encode(text), "<u4").tolist() == library.encode(text)
