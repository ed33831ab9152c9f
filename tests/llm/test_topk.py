import math
import random

import pytest

from kindred.llm import topk
from tests.conftest import rows

SCHEMA = "vec_id long, embedding array<float>, label int, score string, pack int"


def vectors(n, d=6, seed=1, spread=1.0):
    rng = random.Random(seed)
    out = [(i, [math.ldexp(round(rng.gauss(rng.randrange(3), spread) * 256), -8) for _ in range(d)]) for i in range(n)]
    out += [(10, out[3][1]), (10, out[3][1]), (50, None), (100, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (150, [float("nan")] * d)]
    out += [(151, [float("inf")] * d), (None, [9.0] * d), (-50, [-1.0] * d), (300, []), (301, [2.0, 1.0])]
    out += [(i, out[7][1]) for i in range(400, 420)]
    return out


def frame(spark, data):
    return spark.createDataFrame([(i, v, 1, "s", 2) for i, v in data], SCHEMA).repartition(3)


def expected(data, k=5):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in data if i is not None and v is not None and None not in v
            and all(map(math.isfinite, v))]
    out = []
    for a, (i, q) in enumerate(good):
        if i % 50 == 0:
            found = sorted((-sum(x * y for x, y in zip(q, v)), j) for b, (j, v) in enumerate(good) if a != b)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, pack, first", [(1024, 256, 2), (7, 3, 1)])
def test_equals_brute_force(spark, block, pack, first):
    data = vectors(280)
    got = topk.search(frame(spark, data), block=block, pack=pack, first=first)
    assert rows(got) == expected(data)


def test_fewer_rows_than_k_and_repeated_queries(spark):
    data = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [0.5, -0.5])]
    assert rows(topk.search(frame(spark, data))) == expected(data)
    assert rows(topk.search(frame(spark, data[:1]))) == []


def test_empty_table(spark):
    assert rows(topk.search(frame(spark, []))) == []


def test_large_components(spark):
    data = [(0, [2.0**40, 1.0]), (1, [-(2.0**2), 3.0]), (2, [2.0**3 + 0.25, 3.0])]
    assert rows(topk.search(frame(spark, data))) == expected(data)


def clustered(n, d=16, centres=12, seed=3):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 4) for _ in range(d)] for _ in range(centres)]
    out = []
    for i in range(n):
        c = rng.choice(middle)
        out.append((i, [math.ldexp(round((x + rng.gauss(0, 0.2)) * 256), -8) for x in c]))
    return out


@pytest.mark.parametrize("first, group", [(1, 64), (2, 3), (50, 1)])
def test_bounds_rule_blocks_out_on_clustered_vectors(spark, first, group):
    data = clustered(1500)
    options = {"block": 32, "pack": 8, "first": first, "group": group}
    assert rows(topk.search(frame(spark, data), **options)) == expected(data)
    assert topk.scored_share(topk.find(frame(spark, data), **options)) < (0.5 if first < 50 else 1)


def test_ties_at_the_floor_go_to_the_smaller_id(spark):
    data = [(i, [1.0, 0.0]) for i in range(200)] + [(i, [0.5, 1.0]) for i in range(200, 260)]
    assert rows(topk.search(frame(spark, data), block=8, pack=2, first=1)) == expected(data)


def test_no_row_for_a_query_and_a_block(spark):
    data = clustered(1500)
    found = topk.find(frame(spark, data), block=32, pack=8).groupBy("pack", "place").count().filter("place >= 0")
    assert found.agg({"count": "max"}).first()[0] <= 5 * (1500 // 32 // topk.GROUP + 1)
