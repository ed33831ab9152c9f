import functools
import hashlib
from collections import Counter

import pytest

from kindred.llm import substring
from tests.conftest import rows
from tests.llm.texts import blank_words, documents, frame


def expected(docs, window):
    return sorted((expected_row(docs, window, i) for i in range(len(docs))), key=repr)


def expected_row(docs, window, at):
    return _rows(tuple(docs), window)[at]


@functools.cache
def _rows(docs, window):
    words = [blank_words(t) for _, t in docs]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("window, seed", [(35, 10), (12, 5), (3, 3)])
def test_equals_brute_force(spark, window, seed):
    docs = documents()
    got = substring.drop_repeats(frame(spark, docs), window, seed, kept_text=False)
    assert rows(got) == expected(docs, window)


def test_kept_text_has_the_hash_it_is_given(spark):
    got = substring.drop_repeats(frame(spark, documents(2))).collect()
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got)


def test_empty_table(spark):
    assert rows(substring.drop_repeats(frame(spark, []), kept_text=False)) == []
