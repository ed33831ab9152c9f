import hashlib
import math
import random

import numpy as np
import pytest

from kindred.llm import lloyd
from kindred.llm.lloyd import compress, digest, label_errors, reassign, scan

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, v string, _label string"


def brute(rows, parts, entries, rounds, d):
    """(vec_id, label, code, error) of each row that takes part, and the codebooks; every round scans all."""
    ok = [r for r in rows if r[1] is not None and len(r[1]) == d and all(x is not None and math.isfinite(x) for x in r[1])]
    cut = lambda v: [[math.floor(256 * float(np.float32(x))) for x in v[p * d // parts : (p + 1) * d // parts]] for p in range(parts)]
    vectors = [cut(r[1]) for r in ok]
    first = sorted(range(len(ok)), key=lambda i: (ok[i][0] is None, ok[i][0] or 0, vectors[i]))[:entries]
    books = [[list(vectors[i][p]) for i in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for step in range(rounds + 1):
        best = [[nearest(v[p], books[p]) for p in range(parts)] for v in vectors]
        for p in range(parts if step < rounds else 0):
            for e in range(len(books[p])):
                mine = [v[p] for v, b in zip(vectors, best) if b[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [(r[0], None if r[2] is None else str(r[2]), bytes(e for _, e in b), sum(x for x, _ in b)) for r, b in zip(ok, best)]
    return found, books


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA).repartition(3)


def vectors(seed, n, d=8, step=0.25):
    rng = random.Random(seed)
    return [(i, [rng.randrange(-8, 8) * step for _ in range(d)], rng.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("rounds", [0, 1, 2, 5])
def test_rounds_equal_full_scans(spark, rounds):
    rows = vectors(rounds, 120)
    rows += [(200, [math.nan] + [0.0] * 7, 1), (201, None, 1), (202, [None] + [1.0] * 7, 2), (203, [math.inf] * 8, 1)]
    rows += [rows[3], rows[3], rows[4], (None, [0.5] * 8, None), (0, [0.25] * 8, 2), (204, [1.0] * 4, 1), (205, [], 1)]
    got = compress(table(spark, rows), parts=4, entries=6, rounds=rounds)
    want, books = brute(rows, 4, 6, rounds, 8)
    assert sorted(map(tuple, got.rows.collect()), key=repr) == sorted(((i, c, bytearray(b), e) for i, c, b, e in want), key=repr)
    assert got.codebooks.tolist() == books
    flat = ",".join(str(x) for p in books for e in p for x in e)
    assert digest(got.codebooks) == hashlib.sha256(flat.encode()).hexdigest()
    sums = {}
    for _, label, _, e in want:
        sums[label] = sums.get(label, 0) + e
    assert all(r.label_error == sums[r.label] for r in label_errors(got.rows, chunk=10).collect())
    assert label_errors(got.rows, chunk=10).count() == len(want)


def test_large_components_and_few_vectors(spark):
    rows = [(1, [-1000.5, 3.0, 0.0, 1.0], 1), (2, [1000.25, -3.0, 7.0, -1.0], 1), (3, [1e30, 0.0, 0.0, 0.0], 1), (4, [0.0] * 4, None)]
    got = compress(table(spark, rows), parts=2, entries=64)
    want, books = brute([r for r in rows if r[0] != 3], 2, 64, 2, 4)
    assert sorted(map(tuple, got.rows.collect())) == sorted((i, c, bytearray(b), e) for i, c, b, e in want)
    assert got.codebooks.tolist() == books


def test_one_vector_many_times(spark):
    rows = [(7, [0.5] * 8, 1)] * 50 + [(9, [0.25] * 8, 1)]
    got = compress(table(spark, rows), parts=4, entries=3)
    want, books = brute(rows, 4, 3, 2, 8)
    assert got.codebooks.tolist() == books and got.rows.count() == 51
    assert {(r.vec_id, bytes(r.code), r.error) for r in got.rows.collect()} == {(i, b, e) for i, _, b, e in want}


def test_no_vectors(spark):
    for rows in ([], [(1, None, 1), (2, [math.nan] * 8, None)]):
        got = compress(table(spark, rows), parts=4)
        assert got.rows.count() == 0 and label_errors(got.rows).count() == 0
        assert digest(got.codebooks) == hashlib.sha256(b"").hexdigest()


def test_reassign_equals_scan():
    rng = np.random.default_rng(5)
    for _ in range(30):
        x, old = rng.integers(-4, 4, (40, 3)), rng.integers(-4, 4, (7, 3))
        moved = rng.random(7) < rng.choice([0, 0.3, 1])
        new = np.where(moved[:, None], rng.integers(-4, 4, (7, 3)), old)
        want, got = scan(x, new), reassign(x, new, moved, *scan(x, old))
        assert (want[0] == got[0]).all() and (want[1] == got[1]).all()


def test_only_moved_entries_are_compared(monkeypatch):
    seen = []
    monkeypatch.setattr(lloyd, "scan", lambda x, entries: seen.append((len(x), len(entries))) or scan(x, entries))
    x, entries = np.array([[0], [10], [20]]), np.array([[0], [10], [21]])
    reassign(x, entries, np.array([False, False, True]), np.array([0, 1, 2]), np.array([0, 0, 0]))
    assert seen == [(1, 3), (2, 1)]
