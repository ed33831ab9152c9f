"""Texts made so that polynomials modulo 2**64 agree: the orders of Thue and Morse, and of blocks in them."""

import random

import numpy as np
import pytest

from kindred.llm import bytesops as B
from kindred.llm import jaccard, rules, substring, suffixes
from tests.llm import test_jaccard, test_rules, test_substring, test_suffixes
from tests.conftest import rows
from tests.llm.texts import frame, prose


def morse(n, one="a", two="b"):
    return "".join(two if i.bit_count() % 2 else one for i in range(n))


PAIRS = [(morse(n), morse(n, "b", "a")) for n in (64, 128, 256, 1024, 2048, 8192)]
PAIRS += [(morse(1024, "x" * 128, "y" * 128), morse(1024, "y" * 128, "x" * 128)), (morse(4096) + "a", morse(4096, "b", "a") + "a")]


def values(text):
    return np.frombuffer(text.encode(), np.uint8)


@pytest.mark.parametrize("which", range(4))
def test_ranges_of_any_length_have_their_own_hashes(which):
    for one, two in PAIRS:
        both = np.concatenate([values(one), values(two), values(one)])
        n = len(one)
        found = B.hashes(both, np.array([0, n, 2 * n]), np.array([n, 2 * n, 3 * n]), which)
        assert found[0] != found[1] and found[0] == found[2]
    assert all(b % 8 in (3, 5) for b in B.BASES)


def test_hashes_of_ranges_follow_their_values():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 2, 3000).astype(np.uint8)
    low = rng.integers(0, 3000, 400)
    high = np.minimum(low + rng.choice([0, 1, 5, 128, 129, 400, 2000], 400), 3000)
    by_value = {}
    for a, b, h in zip(low, high, B.hashes(data, low, high, 1)):
        by_value.setdefault(data[a:b].tobytes(), set()).add(int(h))
    assert all(len(h) == 1 for h in by_value.values())
    assert len({next(iter(h)) for h in by_value.values()}) == len(by_value)


def documents():
    out, i = [], 0
    for one, two in PAIRS:
        rest = " ".join(f"w{i}x{j}" for j in range(34))
        out += [(i, f"{one} {rest}"), (i + 1, f"{two} {rest}")]  # windows of 35 words, no two alike
        out += [(i + 2, f"{one}\n{two}\n{two} a\n{one} a"), (i + 3, " ".join([one] * 12)), (i + 4, " ".join([two] * 12))]
        i += 5
    w = {"a": "left", "b": "right"}
    for n in (64, 1024):
        out += [(i, " ".join(w[c] for c in morse(n))), (i + 1, " ".join(w[c] for c in morse(n, "b", "a")))]
        i += 2
    return out


def test_substring_dedup(spark):
    docs = documents()
    got = substring.drop_repeats(frame(spark, docs), 35, 10, kept_text=False)
    assert rows(got) == sorted(test_substring.expected(docs, 35), key=repr)
    first = {r.doc_id: r.n_removed for r in got.collect()}
    assert first[0] == first[1] == 0


def test_jaccard_join(spark):
    docs = documents()
    found = jaccard.join(frame(spark, docs)).select("doc_id", "n_shingles", "n_links")
    assert rows(found) == sorted(((i, n, links) for i, n, links, _ in test_jaccard.expected(docs)), key=repr)


def test_quality_rules(spark):
    docs = documents()
    assert rows(rules.apply_rules(frame(spark, docs), kept_text=False)) == sorted(test_rules.expected(docs), key=repr)


@pytest.mark.parametrize("length", [100])
def test_suffix_array_dedup(spark, length):
    docs = [(i, t) for i, t in documents() if len(t) < 5000]
    got = suffixes.drop_repeats(frame(spark, docs), length, kept_bytes=False)
    assert rows(got) == sorted(test_suffixes.expected(spark, docs, length), key=repr)


def long_documents():
    """Texts longer than what is handled at once, with passages that repeat within and across them."""
    rng = random.Random(5)
    passage = prose(rng, 80)
    long = "\n".join(f"{prose(rng, 30)} {passage if i % 500 == 250 else ''}" for i in range(4500))
    assert len(long.encode()) > B.CHUNK
    words = long.split(" ")
    words[len(words) // 2] = "changed"
    return [(1, long), (2, "short"), (3, " ".join(words)), (4, prose(rng, 60) + " " + passage), (5, None)]


def test_texts_longer_than_a_chunk(spark):
    docs = long_documents()
    table = frame(spark, docs)
    assert rows(substring.drop_repeats(table, kept_text=False)) == sorted(test_substring.expected(docs, 35), key=repr)
    found = jaccard.join(table).select("doc_id", "n_shingles", "n_links")
    assert rows(found) == sorted(((i, n, links) for i, n, links, _ in test_jaccard.expected(docs)), key=repr)
    assert rows(rules.apply_rules(table, kept_text=False)) == sorted(test_rules.expected(docs), key=repr)
    assert rows(suffixes.drop_repeats(table, kept_bytes=False)) == sorted(test_suffixes.expected(spark, docs, 100), key=repr)
