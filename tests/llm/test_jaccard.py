import random
from collections import Counter

import numpy as np
import pytest

from kindred.llm import jaccard
from kindred.llm.components import components
from kindred.llm.tables import FIRST, Scratch
from tests.conftest import rows
from tests.llm.texts import blank_words, documents, frame, prose


def shingles(text, n=5):
    w = blank_words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) or frozenset([tuple(w)] if w else [])


def expected(docs, threshold=0.8):
    sets = [shingles(t) for _, t in docs]
    n = len(docs)
    linked = [[False] * n for _ in range(n)]
    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
                linked[i][j] = linked[j][i] = True
    root = list(range(n))
    for _ in range(n):
        new = [min([root[i]] + [root[j] for j in range(n) if linked[i][j]]) for i in range(n)]
        if new == root:
            break
        root = new
    return [(docs[i][0], len(sets[i]), sum(linked[i]), root[i]) for i in range(n)]


def near_copies(seed, n, edits):
    rng = random.Random(seed)
    words = prose(rng, 150).split()
    out = []
    for i in range(n):
        mine = list(words)
        for _ in range(rng.randrange(edits)):
            mine[rng.randrange(len(mine))] = f"e{rng.randrange(10**6)}"
        out.append((1000 * seed + i, " ".join(mine)))
    return out


@pytest.mark.parametrize("block", [256, 7])
def test_equals_brute_force(spark, block):
    docs = documents() + near_copies(3, 60, 14) + near_copies(4, 5, 3) + [(9000, documents()[53][1])]
    got = jaccard.join(frame(spark, docs), block=block).collect()
    want = expected(docs)
    assert Counter((r.doc_id, r.n_shingles, r.n_links) for r in got) == Counter(w[:3] for w in want)
    # the same rows share a class; ids that repeat are left out
    single = {i for i, n in Counter(d for d, _ in docs).items() if n == 1 and i is not None}
    mine, theirs = {}, {}
    for r in got:
        if r.doc_id in single and r.n_shingles:
            mine.setdefault(r.class_id, set()).add(r.doc_id)
    for doc_id, n, _, root in want:
        if doc_id in single and n:
            theirs.setdefault(root, set()).add(doc_id)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))
    assert all(c in g for c, g in mine.items() if len(g) > 1 and c >= 1000)


def test_empty_table_and_no_links(spark):
    assert rows(jaccard.join(frame(spark, []))) == []
    got = jaccard.join(frame(spark, [(1, None), (2, "a b c"), (None, "d e")])).collect()
    assert sorted((r.doc_id or 0, r.n_links, r.class_id) for r in got) == [(0, 0, FIRST), (1, 0, 1), (2, 0, 2)]


def test_more_blocks_than_members(spark, monkeypatch):
    members = [(1, 3, 0, 10), (1, 3, 0, 11), (2, 4, 1, 12), (2, 4, 2, 13)]
    pairs = jaccard.block_pairs(spark.createDataFrame(members, "root long, n_blocks int, block int, node long"), ["root"], ["node"])
    met = [(sorted(x.node for x in r.list), r.others and [x.node for x in r.others]) for r in pairs.collect()]
    assert sorted(met, key=repr) == [([10, 11], None), ([12], None), ([12], [13]), ([13], None)]
    # ten families of two, of two blocks each
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 1700)
    docs = []
    for i in range(10):
        words = prose(random.Random(i), 150).split()
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:-1], "changed"]))]
    got = jaccard.join(frame(spark, docs)).collect()
    assert sorted((r.doc_id, r.n_links) for r in got) == [(i, 1) for i in range(20)]


def test_posterior_floor_is_the_beta_tail():
    rng = np.random.default_rng(1)
    for n, floor in zip((20, 40), jaccard.posterior_floor(0.8, 1e-2, 40, 20)):
        chance = [(rng.beta(m + 1, n - m + 1, 200_000) >= 0.8).mean() for m in range(n + 1)]
        assert chance[floor] >= 0.8e-2 and (floor == 0 or chance[floor - 1] < 1.2e-2)


def test_components(spark):
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(1000, 1040)]
    star = [(5, i) for i in range(100, 160)]
    pairs = path + star + [(rng.randrange(50), rng.randrange(50)) for _ in range(30)]
    got = dict(rows(components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark))))
    root = {x: x for p in pairs for x in p}
    for _ in root:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    loops = {a for a, b in pairs if a == b} - {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {k: v for k, v in root.items() if k not in loops}
