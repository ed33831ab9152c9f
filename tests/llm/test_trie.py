import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from kindred.llm.queries import QUERIES
from kindred.llm.trie import ends_digest, prefix_trie, with_text

SCHEMA = "conv_id long, turn long, role string, text string, depth string, x string, part string, h string"


def rebuilt(rows, every, heads):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % every) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows, every=10, heads=6):
    """Per node its conv_id, depth, parent, members, children, leaves, saved tokens and ends."""
    members, ends = {}, {}
    for c, turns in rebuilt(rows, every, heads).items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    out = []
    for node, convs in members.items():
        d = len(node)
        below = [n for n in members if n[:d] == node]
        children = lambda n: [m for m in members if len(m) == len(n) + 1 and m[:-1] == n]
        leaves = sum(not children(n) for n in below)
        saved = sum((len(members[n]) - 1) * (len(n[-1][1]) if n else 0) for n in below)
        parent = min(members[node[:-1]]) if d else None
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        out.append((min(convs), d, parent, len(convs), len(children(node)), leaves, saved, digest))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(4)


def got(spark, rows, every=10, **options):
    found = prefix_trie(table(spark, rows), every, **options)
    empty = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))
    nodes = found.nodes.join(ends_digest(found.ends, ids=3), ["depth", "x", "y"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", empty
    )
    return sorted(map(tuple, nodes.collect()), key=repr)


def conversations(seed, n, most=7):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 200), n):
        for turn in range(rng.randrange(1, most)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "bé", "ccc", "漢字"])))
    return rows


@pytest.mark.parametrize(("seed", "block", "chunk"), [(1, 1024, 1000), (2, 2, 3), (3, 1, 1)])
def test_trie_equals_brute_force(spark, seed, block, chunk):
    rows = conversations(seed, 60)
    rows += [(300, None, None, None), (300, 1, "user", None), (300, 1, "user", ""), (300, None, "z", "x")]
    rows += [(None, 1, "user", "lost"), rows[0], rows[0], (301, 5, "user", "é" * 3000), (301, None, "", "")]
    assert got(spark, rows, block=block, chunk=chunk) == brute(rows)


def test_copies_and_prefixes_of_one_another(spark):
    turns = [("user", "hi"), ("bot", "there"), ("user", "more"), ("bot", "end")]
    rows = [(c, t, *turns[t]) for c in range(0, 400, 10) for t in range(1 + c // 10 % 4)]
    assert got(spark, rows, chunk=2) == brute(rows)


def test_a_conversation_of_many_turns(spark):
    rows = [(20, t % 50, "user", f"t{t % 7}") for t in range(300)] + conversations(7, 20, 5)
    assert got(spark, rows, block=16) == brute(rows)


def test_conversations_without_turns(spark):
    missing = next(c for c in range(11, 99) if c % 10 and zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(missing, 0, "user", "gone"), (missing, 1, "user", "gone too")]
    want = brute(rows)
    assert len(want) == 1 and got(spark, rows) == want
    rows += [(200, 0, "user", "stays")]
    assert got(spark, rows) == brute(rows)


def test_an_empty_table(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 1, "user", "x")]) == []


def test_texts_of_nodes(spark):
    rows = conversations(4, 30)
    turns = rebuilt(rows, 10, 6)
    for r in with_text(prefix_trie(table(spark, rows), 10)).collect():
        assert (r.role, r.text) == (turns[r.conv_id][r.depth - 1] if r.depth else (None, None))


def test_query_on_repeated_reads_is_stable(spark):
    first, second = (sorted(map(repr, QUERIES["op13_prefix_trie"](spark, "/root/testdata/sf0.001").collect())) for _ in range(2))
    assert first == second
