import random
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from kindred.operators import pairs
from kindred.operators import ratings as rated
from tests import naive
from tests.conftest import rows


def table(spark, members):
    return spark.createDataFrame(sorted(set(members)), "business_id long, user_id long")


def sims(df):
    return {(r["b1"], r["b2"]): r["sim"] for r in df.collect()}


def random_members(seed, n=500):
    draw = random.Random(seed)
    hot = [(b, u) for b in range(30) for u in range(5) if draw.random() < 0.7]
    rest = [(draw.randrange(60), 5 + draw.randrange(80)) for _ in range(n)]
    return sorted(set(hot + rest))


def test_jaccard_exactly_at_the_threshold_is_kept(spark):
    # One common user of 20 in the union: 0.05.
    members = [(1, 0)] + [(1, u) for u in range(1, 10)] + [(2, 0)] + [(2, u) for u in range(20, 30)]
    assert sims(pairs.similar_pairs(table(spark, members), threshold=0.05)) == {(1, 2): 0.05}
    assert sims(pairs.similar_pairs(table(spark, members), threshold=0.0501)) == {}


@pytest.mark.parametrize("floor", [5_000, 20, 3])
def test_similar_pairs_equal_brute_force_whatever_counts_as_hot(spark, floor):
    members = random_members(7)
    for threshold in (0.05, 0.3):
        found = sims(pairs.similar_pairs(table(spark, members), threshold=threshold, hot_floor=floor))
        assert found == naive.similar(members, threshold)


@pytest.mark.parametrize("floor", [5_000, 4])
@pytest.mark.parametrize("min_overlap", [1, 2, 3, 4])
def test_overlap_counts_equal_brute_force(spark, floor, min_overlap):
    members = random_members(11, n=250)
    sets = naive.sets_of(members)
    expected = {
        (x, y): len(sets[x] & sets[y])
        for x, y in combinations(sorted(sets), 2)
        if len(sets[x] & sets[y]) >= min_overlap
    }
    found = pairs.overlap_pairs(table(spark, members), "business_id", "user_id", None, min_overlap, hot_floor=floor)
    assert {(r["a"], r["b"]): r["n"] for r in found.collect()} == expected


def test_each_pair_of_hot_elements_alone_is_found_once(spark):
    # Every element is hot; items hold 4 of 6 users.
    members = [(i, u) for i, users in enumerate(combinations(range(6), 4)) for u in users]
    found = pairs.overlap_pairs(table(spark, members), "business_id", "user_id", None, 3, hot_floor=2)
    sets = naive.sets_of(members)
    expected = [(x, y, 3) for x, y in combinations(range(15), 2) if len(sets[x] & sets[y]) == 3]
    assert rows(found) == sorted(expected, key=repr)


def test_one_user_with_a_third_of_the_rows_makes_no_pairs_of_its_own(spark):
    members = [(i, 0) for i in range(400)] + [(i % 400, 1 + i // 4) for i in range(800)]
    by_hot = pairs.overlap_pairs(table(spark, members), "business_id", "user_id", None, 3, hot_floor=50)
    plain = pairs.overlap_pairs(table(spark, members), "business_id", "user_id", None, 3)
    assert rows(by_hot) == rows(plain)
    # No pair of items shares three raters through this user alone.
    assert max(Counter(i for i, _ in members).values()) < 5


@pytest.mark.parametrize("floor", [5_000, 15, 2])
def test_moments_and_pearson(spark, floor):
    ratings = naive.skewed_ratings(random.Random(3))
    df = spark.createDataFrame(ratings, "user_id long, business_id long, stars double, at long")
    latest = rated.dedup_ratings(df, ["at"])
    found = pairs.pearson_pairs(pairs.pair_moments(latest, hot_floor=floor)).filter("sim > 0")
    assert {(r["a"], r["b"]): r["sim"] for r in found.collect()} == pytest.approx(naive.cf_model(ratings, by=1))


def test_zero_variance_and_negative_correlation_have_no_similarity(spark):
    flat = [(u, 1, 4.0) for u in range(4)] + [(u, 2, float(u)) for u in range(4)]
    down = [(u, 3, float(-u)) for u in range(4)]
    df = spark.createDataFrame(flat + down, "user_id long, business_id long, stars double")
    assert {r["sim"] for r in pairs.pearson_pairs(pairs.pair_moments(df)).collect()} == {0.0}


def test_overlap_of_two_is_too_little_and_of_three_enough(spark):
    two = [(u, b, float(u)) for u in range(2) for b in (1, 2)]
    three = [(10 + u, b, float(u)) for u in range(3) for b in (3, 4)]
    df = spark.createDataFrame(two + three, "user_id long, business_id long, stars double")
    assert [(r["a"], r["b"], r["n"]) for r in pairs.pair_moments(df).collect()] == [(3, 4, 3)]


def test_string_ids(spark):
    df = spark.createDataFrame([("x", "u"), ("y", "u"), ("y", "v")], "business_id string, user_id string")
    assert sims(pairs.similar_pairs(df)) == {("x", "y"): 0.5}
    assert sims(pairs.similar_pairs(df, hot_floor=1)) == {("x", "y"): 0.5}


def test_jaccard_pairs_give_sizes(spark):
    members = [(1, u) for u in range(4)] + [(2, u) for u in range(1, 6)]
    assert rows(pairs.jaccard_pairs(table(spark, members))) == [(1, 2, 3, 6, 0.5)]


def test_empty_input(spark):
    empty = spark.createDataFrame([], "business_id long, user_id long")
    assert pairs.similar_pairs(empty).count() == 0


def test_row_order_and_partitions_do_not_matter(spark):
    members = table(spark, random_members(5))
    assert rows(pairs.similar_pairs(members)) == rows(pairs.similar_pairs(members.repartition(7).orderBy("user_id")))


@pytest.mark.parametrize(("n_hot", "min_overlap", "threshold"), [(64, 3, 0.0), (65, 3, 0.0), (200, 4, 0.0), (200, 1, 0.3), (130, 1, 0.0)])
def test_more_hot_elements_than_a_long_has_bits(spark, n_hot, min_overlap, threshold):
    draw = random.Random(n_hot)
    members = [(b, u) for b in range(40) for u in range(n_hot) if draw.random() < 0.25]
    members += [(b + 100, u) for b in range(5) for u in (0, 63, n_hot - 1)] + [(draw.randrange(45), 1000 + draw.randrange(60)) for _ in range(100)]
    members = sorted(set(members))
    sets = naive.sets_of(members)
    found = pairs.overlap_pairs(table(spark, members), "business_id", "user_id", None, min_overlap, threshold, hot_floor=4)
    want = {}
    for x, y in combinations(sorted(sets), 2):
        n = len(sets[x] & sets[y])
        if n >= min_overlap and n / len(sets[x] | sets[y]) >= threshold - 1e-12:
            want[x, y] = n
    got = {(r["a"], r["b"]): r["n"] for r in found.collect()}
    assert got == want and got


@pytest.mark.parametrize("floor", [5_000, 3])
def test_moments_over_many_hot_elements(spark, floor):
    draw = random.Random(4)
    stars = {(u, b): float(draw.randrange(1, 6)) for b in range(25) for u in range(150) if draw.random() < 0.2}
    df = spark.createDataFrame([(u, b, s) for (u, b), s in stars.items()], "user_id long, business_id long, stars double")
    found = {(r["a"], r["b"]): tuple(r)[2:] for r in pairs.pair_moments(df, hot_floor=floor).collect()}
    want = {}
    for a, b in combinations(range(25), 2):
        both = [(stars[u, a], stars[u, b]) for u in range(150) if (u, a) in stars and (u, b) in stars]
        if len(both) >= 3:
            x, y = zip(*both)
            want[a, b] = (len(both), sum(x), sum(y), sum(i * i for i in x), sum(j * j for j in y), sum(i * j for i, j in both))
    assert found == want


def test_null_elements_are_shared_by_nobody(spark):
    members = spark.createDataFrame([(b, None) for b in range(20)] + [(1, 5), (2, 5)], "business_id long, user_id long")
    found = pairs.overlap_pairs(members, "business_id", "user_id", None, 1, hot_floor=3)
    assert [(r["a"], r["b"], r["n"]) for r in found.collect()] == [(1, 2, 1)]


def brute_moments(ratings, needed):
    stars = {(u, b): s for u, b, s in ratings}
    items = sorted({b for _, b in stars})
    users = sorted({u for u, _ in stars})
    want = {}
    for a, b in combinations(items, 2):
        both = [(stars[u, a], stars[u, b]) for u in users if (u, a) in stars and (u, b) in stars]
        if len(both) >= needed:
            x, y = zip(*both)
            want[a, b] = (len(both), sum(x), sum(y), sum(i * i for i in x), sum(j * j for j in y), sum(i * j for i, j in both))
    return want


@pytest.mark.parametrize("floor", [5_000, 12])
@pytest.mark.parametrize("chunk", [100_000, 6])
def test_parts_grow_with_the_pairs_and_large_entities_are_cut(spark, monkeypatch, floor, chunk):
    monkeypatch.setattr(pairs, "PART_PAIRS", 100)
    monkeypatch.setattr(pairs, "CHUNK_ROWS", chunk)
    draw = random.Random(12)
    ratings = [(u, b, float(draw.randrange(1, 6))) for u in range(40) for b in range(50) if draw.random() < 0.3 or b == 0]
    df = spark.createDataFrame(ratings, "user_id long, business_id long, stars double")
    found = pairs.pair_moments(df, hot_floor=floor)
    got = {(r["a"], r["b"]): tuple(r)[2:] for r in found.collect()}
    assert got == brute_moments(ratings, 3) and len(found.collect()) == len(got)
    if floor == 5_000:
        held = Counter(u for u, _, _ in ratings)
        n_parts = -(-sum(n * (n - 1) // 2 for n in held.values()) // 100)
        dealt = "a#\\d+L, _piece#\\d+" if chunk == 6 else "a#\\d+L"
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"hashpartitioning\({dealt}, {n_parts}\)", plan) and n_parts > 40


def test_pairs_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(pairs, "PART_PAIRS", 10_000)
    # Ten users with 100 items each: 49,500 pairs, of which at most 1,000 rows, each with a list, meet by item.
    members = [(b, u) for u in range(10) for b in range(u * 100, u * 100 + 100)]
    plan = pairs.overlap_pairs(table(spark, members), "business_id", "user_id", None, 2)._jdf.queryExecution().executedPlan().toString()
    after = [line for line in plan.split("\n") if "Exchange" in line or "Generate inline" in line]
    # read from the result down: the lists become pairs after the last exchange
    assert "Generate inline" in after[0] and re.search(r"hashpartitioning\(a#\d+L, 5\)", after[1])


def test_rows_are_written_once_and_meet_without_a_join(spark):
    members = table(spark, random_members(3))
    plan = pairs.overlap_pairs(members, "business_id", "user_id", None, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "ExistingRDD" not in plan and plan.count("FileScan parquet") == 1


def test_sizes_too_far_apart_do_not_meet_though_others_of_the_list_do(spark):
    # Element 0 is held by all, the others of 1000 and more by two of near sizes.
    sizes = {4: 1, 1: 2, 3: 10, 2: 40, 5: 11}
    members = [(b, 0) for b in sizes] + [(b, 100 * b + i) for b, n in sizes.items() for i in range(1, n)]
    members += [(b, 1000 + i) for b in (3, 5) for i in range(20)]
    held = Counter(b for b, _ in members)
    sized = spark.createDataFrame([(b, u, held[b]) for b, u in members], "id long, via long, size long")
    lists = pairs.group_lists(
        sized, ["via"], ["size"], False, lambda size: (size * 10 >= F.col("size_a") * 4) & (F.col("size_a") * 10 >= size * 4)
    )
    met = {(r["a"], b) for r in lists.collect() for b in r["bs"]}
    want = {(a, b) for a, b in combinations(sorted(held), 2) if min(held[a], held[b]) * 10 >= max(held[a], held[b]) * 4}
    assert met == want and 0 < len(want) < 10


def test_repeated_rows_meet_the_others_as_often_as_they_stand_but_not_themselves(spark):
    made = [(1, 7), (1, 7), (2, 7), (2, 7), (3, 7), (None, 7), (1, 8), (3, 8)]
    df = spark.createDataFrame(made, "business_id long, user_id long")
    found = pairs.overlap_pairs(df, "business_id", "user_id", None, 1)
    assert {(r["a"], r["b"]): r["n"] for r in found.collect()} == {(1, 2): 4, (1, 3): 3, (2, 3): 2}


@pytest.mark.parametrize("floor", [5_000, 3, 10])
def test_null_entities_make_no_pair_and_null_elements_count_in_sizes(spark, floor):
    made = [(None, u) for u in range(6)] + [(b, u) for b in range(4) for u in range(b, 6)] + [(0, None), (1, None)]
    df = spark.createDataFrame(made, "business_id long, user_id long")
    sets = {b: set(range(b, 6)) for b in range(4)}
    size = {b: len(s) + (b < 2) for b, s in sets.items()}
    want = {}
    for a, b in combinations(range(4), 2):
        n = len(sets[a] & sets[b])
        if n / (size[a] + size[b] - n) >= 0.5:
            want[a, b] = round(n / (size[a] + size[b] - n), 9)
    assert sims(pairs.similar_pairs(df, threshold=0.5, hot_floor=floor)) == want


def test_lists_are_made_in_parts_that_follow_the_pairs(spark, monkeypatch):
    monkeypatch.setattr(pairs, "LIST_PAIRS", 1_000)
    # 30 users with 40 items each: 1,200 rows, which the runtime would take as one part, and 23,400 pairs.
    ratings = [(u, u + 7 * i, float(1 + (u + i) % 5)) for u in range(30) for i in range(40)]
    df = spark.createDataFrame(ratings, "user_id long, business_id long, stars double")
    found = pairs.pair_moments(df)
    assert {(r["a"], r["b"]): tuple(r)[2:] for r in found.collect()} == brute_moments(ratings, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(via#\d+L, 25\), REPARTITION_BY_NUM", plan)


@pytest.mark.parametrize(
    ("shift", "step", "short"),
    [(0, 1.0, True), (2**31 - 30, 1.0, True), (2**31 - 29, 1.0, False), (-(2**31) - 1, 1.0, False), (0, 0.5, False), (0, 64.0, False)],
)
def test_whole_numbers_travel_short_only_where_all_fit(spark, shift, step, short):
    draw = random.Random(5)
    ratings = [(u, b + shift, step * draw.randrange(1, 6)) for u in range(20) for b in range(30) if draw.random() < 0.4 or b in (0, 29)]
    df = spark.createDataFrame(ratings, "user_id long, business_id long, stars double")
    found = pairs.pair_moments(df)
    assert found.dtypes[:2] == [("a", "bigint"), ("b", "bigint")]
    assert {(r["a"], r["b"]): tuple(r)[2:] for r in found.collect()} == brute_moments(ratings, 3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert ("as int) AS id" in plan and "as tinyint) AS v" in plan) == short


def test_values_that_are_no_numbers_stay_as_they_are(spark):
    nan = float("nan")
    made = [(u, b, nan if (u, b) == (0, 0) else None if (u, b) == (0, 1) else 2.0) for u in range(4) for b in range(4)]
    df = spark.createDataFrame([*made, (None, 2, 1.0), (9, None, 300.0)], "user_id long, business_id long, stars double")
    found = {(r["a"], r["b"]): r for r in pairs.pair_moments(df).collect()}
    assert len(found) == 6 and all(r["n"] == 4 for r in found.values())
    assert found[0, 2]["sx"] != found[0, 2]["sx"] and found[1, 2]["sx"] == 6.0 and found[2, 3]["sxy"] == 16.0


@pytest.mark.parametrize(("floor", "chunk"), [(5_000, 5), (6, 100_000)])
@pytest.mark.parametrize(("least", "most", "packed"), [(0, 2**24 - 1, True), (-5, 2**24 - 5, False), (2**62, 2**62 + 2**24 - 1, True), (-(2**63), 2**63 - 1, False)])
def test_lists_hold_three_bytes_an_id_where_all_are_near(spark, monkeypatch, floor, chunk, least, most, packed):
    monkeypatch.setattr(pairs, "CHUNK_ROWS", chunk)
    draw = random.Random(7)
    ids = [least, least + 1, least + 2**16 - 1, least + 2**16, least + 2**23, most - 2**15, most - 1, most]
    members = [(b, u) for b in ids for u in range(12) if draw.random() < 0.6]
    found = pairs.similar_pairs(table(spark, members), threshold=0.2, hot_floor=floor)
    assert sims(found) == naive.similar(members, 0.2) and sims(found)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert ("low_bs" in plan) == packed
