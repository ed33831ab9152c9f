import random
import zlib

import numpy as np
import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kindred.llm import packing, queries
from tests.conftest import rows
from tests.llm.texts import documents, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


def best_fit_decreasing(lengths, sequence):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((fit if fit is not None else sequence) - n)
    return len(gaps)


def check(placed, sequence):
    by_sequence = {}
    for length, sequence_id, offset in placed:
        by_sequence.setdefault(sequence_id, []).append((offset, length))
    for members in by_sequence.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= sequence
    return len(by_sequence)


@pytest.mark.parametrize(
    "lengths",
    [
        [random.Random(1).randrange(1, 101) for _ in range(800)],
        [min(100, 1 + int(random.Random(i).expovariate(0.1))) for i in range(900)],
        [1] * 950,
        [51] * 40 + [49] * 40 + [100] * 3,
        [60] * 30 + [40] * 29 + [1],
        [7],
        [],
    ],
)
def test_places_are_valid_and_few(spark, lengths):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id long, length long").repartition(3)
    placed = packing.pack(df, 100).join(df, "id").select("length", "sequence_id", "offset").collect()
    assert len(placed) == len(lengths)
    n = check(placed, 100)
    assert n <= best_fit_decreasing(lengths, 100) + (len(lengths) > 0) * (n // 100 + 1)


def test_pieces_equal_the_tokenizer(spark):
    docs = documents() + [(90, "a  b \n c　 d <|endoftext|> it's  "), (91, " x  y \u0085 z"), (92, "é" * 40 + " 漢字 " * 9)]
    got = packing.pack_documents(frame(spark, docs), PATH, 64).collect()
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    want = []
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = list(range(len(ids), 0, -64))[::-1]
        for piece, (low, high) in enumerate(zip([0, *cuts], cuts)):
            part = ids[low:high]
            want.append((doc_id, piece, low, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), part))
    mine = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in got]
    assert sorted(mine, key=repr) == sorted(want, key=repr)
    check([(r.length, r.sequence_id, r.offset) for r in got], 64)


def test_empty_table(spark):
    assert rows(packing.pack_documents(frame(spark, []), PATH, want_ids=False)) == []


def test_added_tokens_as_the_unmodified_tokenizer(spark, tmp_path):
    docs = [(1, "a <|endoftext|> b"), (2, "<|endoftext|><|endoftext|>"), (3, "a <|endoftext| > b"), (4, "é 漢 <|endoftext|>c"), (5, None)]
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op1_best_fit_packing(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((doc_id, 0, 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    packed = corpus_pipeline.best_fit_packing(spark, frame(spark, docs), "").collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, " \n\t" * 400_000, "a" * 2_000_000, (" " * 5_000 + "a") * 100])
def test_long_runs_equal_the_library(text):
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    for added in (True, False):
        assert np.frombuffer(packing.Encoder.of(PATH, added).encode([text])[0], "<u4").tolist() == want


def test_a_document_of_blanks(spark):
    docs = [(1, " " * 1_500_000), (2, "short"), (3, "\n" * 900_000)]
    got = packing.pack_documents(frame(spark, docs), PATH, want_ids=False, added=True)
    counts = {r.doc_id: r.n for r in got.groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    tokenizer = Tokenizer.from_file(PATH)
    assert counts == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in docs}
