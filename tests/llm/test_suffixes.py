import hashlib
import random

import numpy as np
import pytest

from kindred.llm import suffixes
from kindred.llm.tables import FIRST
from tests.conftest import rows
from tests.llm.texts import documents, frame


def text_key(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return {r.t: r.h for r in df.selectExpr("t", "hash(t) AS h").collect()}


def expected(spark, docs, length):
    keys = text_key(spark, {t for _, t in docs})
    order = sorted({(FIRST if i is None else i, keys[t], t or "") for i, t in docs})
    first, gone = {}, {}
    for doc_id, key, text in order:
        data, covered = text.encode(), set()
        for i in range(len(data) - length + 1):
            if first.setdefault(data[i : i + length], (doc_id, key, i)) != (doc_id, key, i):
                covered.update(range(i, i + length))
        gone[doc_id, key] = covered
    out = []
    for doc_id, text in docs:
        data, covered = (text or "").encode(), gone[FIRST if doc_id is None else doc_id, keys[text]]
        spans = sum(i - 1 not in covered for i in covered)
        kept = bytes(b for i, b in enumerate(data) if i not in covered)
        out.append((doc_id, len(data), len(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length, seed, crowd", [(100, 32, 2048), (100, 32, 1), (20, 8, 3)])
def test_equals_brute_force(spark, length, seed, crowd):
    docs = documents()
    got = suffixes.drop_repeats(frame(spark, docs), length, seed, crowd, kept_bytes=False)
    assert rows(got) == expected(spark, docs, length)


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"\x00\x01", bytes(range(256))])
def test_two_stage_sorting(alphabet):
    rng = random.Random(3)
    for n in (0, 1, 2, 7, 100, 700):
        data = bytes(rng.choice(alphabet) for _ in range(n))
        order = suffixes.suffix_array(np.frombuffer(data, np.uint8), 12)
        assert sorted(order.tolist()) == list(range(n))
        cut = [data[i : i + 12] for i in order.tolist()]
        assert cut == sorted(cut)


def test_empty_table(spark):
    assert rows(suffixes.drop_repeats(frame(spark, []), kept_bytes=False)) == []
