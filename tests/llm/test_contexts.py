import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.llm import bytesops as B
from kindred.llm.contexts import grams, held_out, log_kt, score
from tests.llm.texts import documents, frame

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def steps(text, depth):
    """(context with the last byte first, choice node, bit) of all choices of a text."""
    data = b"\xff" * depth + (text or "").encode().translate(LOWER) + b"\xff"
    for j in range(depth, len(data)):
        context = data[j - depth : j][::-1]
        for k in range(8):
            yield context, (1 << k) | (data[j] >> (8 - k)), (data[j] >> (7 - k)) & 1


def kt(a, b):
    """In whole numbers, one bit after the other."""
    p = Fraction(1)
    for i in range(a):
        p *= Fraction(2 * i + 1, 2 * (i + 1))
    for i in range(b):
        p *= Fraction(2 * i + 1, 2 * (a + i + 1))
    return p


class Tree:
    """The weighted context tree as its definition says, by recursion over exact fractions."""

    def __init__(self, texts, depth):
        self.depth, self.counts, self.children = depth, {}, {}
        for text in texts:
            for context, node, bit in steps(text, depth):
                for d in range(depth + 1):
                    self.counts.setdefault((node, context[:d]), [0, 0])[bit] += 1
                    if d:
                        self.children.setdefault((node, context[: d - 1]), set()).add((node, context[:d]))
        self.known = {}

    def pw(self, at):
        if at not in self.known:
            pe = kt(*self.counts[at])
            if len(at[1]) < self.depth:
                below = Fraction(1)
                for child in self.children[at]:
                    below *= self.pw(child)
                pe = pe / 2 + below / 2
            self.known[at] = pe
        return self.known[at]

    def bit(self, context, node, bit, d=0):
        at = (node, context[:d])
        if at not in self.counts:
            return None if d else 0.5
        a, b = self.counts[at]
        here = ((b if bit else a) + 0.5) / (a + b + 1)
        below = self.bit(context, node, bit, d + 1) if d < self.depth else None
        if below is None:
            return here
        stop = float(kt(a, b) / 2 / self.pw(at))
        return stop * here + (1 - stop) * below

    def score(self, text):
        return sum(math.log10(self.bit(*s)) for s in steps(text, self.depth))


def words(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(LOWER))


def brute(rows, depth):
    train = [t for i, t in rows if not out(i)]
    counts = {}
    for t in train:
        for w in [*words(t), None]:
            counts[w] = counts.get(w, 0) + 1
    total, tree, result = sum(counts.values()), Tree(train, depth), []
    for i, t in rows:
        tokens = [*words(t), None]
        base = sum(math.log10((counts.get(w, 0) + 1) / (total + len(counts) + 1)) for w in tokens)
        known = sum(counts.get(w, 0) > 0 for w in tokens)
        result.append((i, out(i), len(tokens), known, total, base, tree.score(t), len((t or "").encode())))
    return result


def check(got, want):
    got = [tuple(r)[:8] for r in got.collect()]
    order = lambda r: repr((r[0], r[7], round(r[6], 6)))
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=order), sorted(want, key=order)):
        assert g[:5] == w[:5] and g[7] == w[7]
        assert g[5:7] == pytest.approx(w[5:7], rel=1e-9)


@pytest.mark.parametrize(("depth", "chunk"), [(2, 1 << 20), (4, 300), (3, 1)])
def test_scores_equal_the_tree(spark, depth, chunk):
    rng = random.Random(depth)
    rows = [(i, " ".join(rng.choice(["Ab", "abc", "née", "x"]) for _ in range(rng.randrange(12)))) for i in range(25)]
    rows += [(None, None), (None, "zz ZZ"), (1, ""), rows[4], rows[4], (7, "\t \n"), (30, "unseen ÄÖ 漢"), (39, "ab " * 60)]
    assert {out(i) for i, _ in rows} == {True, False}
    check(score(frame(spark, rows), depth=depth, chunk=chunk), brute(rows, depth))


def test_awkward_documents(spark):
    rows = documents()
    got = score(frame(spark, rows), chunk=20_000)
    assert got.count() == len(rows)
    tokens = sorted((len(words(t)) + 1, out(i)) for i, t in rows)
    assert sorted((r.n_tokens, r.held_out) for r in got.collect()) == tokens
    assert got.filter("NOT score < 0 OR NOT base_score < 0 OR isnan(score)").count() == 0


def test_chunks_do_not_matter(spark):
    docs = frame(spark, documents())
    one, many = (sorted((r.doc_id or 0, r.n_bytes, round(r.score, 6)) for r in score(docs, chunk=c).collect()) for c in (1 << 25, 999))
    assert one == many


def test_probabilities_of_all_next_bytes_sum_to_one(spark):
    """Held-out texts that differ in their last byte: with that byte's chance, all 256 continuations of a context make one."""
    train = [(i, f"abab{i}c") for i in range(20)]
    tree = Tree([t for _, t in train], 4)
    for context in (b"ba\xff\xff", b"abab", b"zzzz", b"0bab"):
        total = 0
        for byte in range(256):
            p = 1.0
            for k in range(8):
                p *= tree.bit(context, (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1)
            total += p
        assert total == pytest.approx(1)
    held = [(100 + i, "ab" + chr(i)) for i in range(97, 123)]
    got = score(frame(spark, train + held), F.col("doc_id") >= 100).filter("held_out").collect()
    assert {r.doc_id: pytest.approx(r.score) for r in got} == {i: tree.score(t) for i, t in held}


def test_learning_helps_on_held_out_texts(spark):
    got = score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rows = got.groupBy("held_out").agg((-F.sum("score") * math.log2(10) / F.sum("n_bytes")).alias("bits")).collect()
    bits = {r.held_out: r.bits for r in rows}
    assert bits[True] < 4 and bits[False] < bits[True]


def test_nothing_to_learn_from(spark):
    assert score(frame(spark, [])).count() == 0
    held = next(i for i in range(99) if out(i))
    r = score(frame(spark, [(held, "abc d")])).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)
    assert r.score == pytest.approx(48 * math.log10(0.5)) and r.bits_per_byte == pytest.approx(8)


def test_held_out_rule(spark):
    got = spark.range(500).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == out(r.id) for r in got)


def test_kt_and_grams():
    for a, b in [(0, 0), (1, 0), (3, 5), (40, 2)]:
        assert log_kt(np.array([float(a)]), np.array([float(b)]))[0] == pytest.approx(math.log(kt(a, b)), abs=1e-11)
    texts = B.Texts(0, np.frombuffer(b"AbC", np.uint8), np.array([0, 2, 2, 3]))
    keys, doc = grams(texts, 2)
    assert doc.tolist() == [0, 0, 0, 1, 2, 2]
    assert [k.to_bytes(3) for k in keys.tolist()] == [b"\xff\xffa", b"a\xffb", b"ba\xff", b"\xff\xff\xff", b"\xff\xffc", b"c\xff\xff"]
