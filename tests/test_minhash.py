import random
import re

import pytest
from pyspark.sql import functions as F

from kindred.operators import evaluate, minhash, pairs
from kindred.plans.similar import similar_businesses
from tests import naive
from tests.conftest import rows


def members(spark, made):
    return spark.createDataFrame(made, "business_id long, user_id long")


def random_sets(seed=1, n=400):
    draw = random.Random(seed)
    return sorted({(draw.randrange(40), draw.randrange(100, 160)) for _ in range(n)})


def naive_signatures(made, family, buckets):
    ids = {u: i for i, u in enumerate(sorted({u for _, u in made}))}
    m = max(len(ids) - 1, 1)
    sets = naive.sets_of(made)
    return {
        b: [
            min(((x * ids[u] + y) % minhash.PRIME) % m if buckets else (x * ids[u] + y) % minhash.PRIME for u in users)
            for x, y in family
        ]
        for b, users in sets.items()
    }


def test_hash_family_is_seeded_and_in_range():
    family = minhash.hash_family(100, 5)
    assert family == minhash.hash_family(100, 5) != minhash.hash_family(100, 6)
    assert all(900_000_017 <= a <= 900_000_040 + i * 10**7 for i, (a, _) in enumerate(family))
    # a * idx + b fits a long for every index below 2^31.
    assert max(a for a, _ in family) * 2**31 + max(b for _, b in family) < 2**63


@pytest.mark.parametrize("rows_per_range", [1_000_000, 7, 1])
def test_ids_are_dense_and_ascending(spark, rows_per_range):
    names = [f"k{i:03d}" for i in range(50)]
    df = spark.createDataFrame([(n,) for n in names * 3], "user_id string").repartition(5)
    coded = minhash.encode_ids(df, "user_id", rows_per_range)
    assert rows(coded) == [(n, i) for i, n in enumerate(names)]


@pytest.mark.parametrize("n_hashes", [3, 10, 23])
@pytest.mark.parametrize("bucketed", [True, False])
def test_signatures_equal_the_definition(spark, n_hashes, bucketed):
    made = random_sets()
    family = minhash.hash_family(n_hashes, 2)
    found = minhash.minhash_signatures(members(spark, made), family=family, bucketed=bucketed)
    assert {r[0]: r[1] for r in found.collect()} == naive_signatures(made, family, bucketed)


def test_one_element_does_not_divide_by_zero(spark):
    found = minhash.minhash_signatures(members(spark, [(1, 9), (2, 9)]), family=minhash.hash_family(4, 1))
    assert {r[0]: r[1] for r in found.collect()} == {1: [0, 0, 0, 0], 2: [0, 0, 0, 0]}


@pytest.mark.parametrize("rows_per_band", [1, 2, 3])
def test_candidate_groups_and_verified_pairs(spark, rows_per_band):
    made = random_sets()
    family = minhash.hash_family(8, 3)
    signatures = naive_signatures(made, family, True)
    bands = {b: [tuple(s[i : i + rows_per_band]) for i in range(0, 8, rows_per_band)] for b, s in signatures.items()}
    table = members(spark, made)
    spark_signatures = minhash.minhash_signatures(table, family=family)

    groups = minhash.lsh_candidates(spark_signatures, "business_id", 8, rows_per_band).collect()
    expected = set()
    for b, own in bands.items():
        for i, bucket in enumerate(own):
            n = sum(other[i] == bucket for other in bands.values())
            if n > 1:
                expected.add((i, bucket, b, n))
    assert {(g["band"], tuple(g["bucket"]), g["business_id"], g["n_members"]) for g in groups} == expected
    assert len(groups) == len(expected)

    stats = minhash.lsh_stats(spark_signatures, "business_id", 8, rows_per_band).orderBy("band").collect()
    for i, row in enumerate(stats):
        sizes = {}
        for own in bands.values():
            sizes[own[i]] = sizes.get(own[i], 0) + 1
        assert row["n_pairs"] == sum(n * (n - 1) // 2 for n in sizes.values())
        assert row["n_single"] == sum(n == 1 for n in sizes.values())
        assert (row["n_entities"], row["n_buckets"], row["largest_bucket"]) == (40, len(sizes), max(sizes.values()))

    found = minhash.similar_pairs_lsh(table, threshold=0.1, family=family, rows_per_band=rows_per_band)
    meet = lambda x, y: any(p == q for p, q in zip(bands[x], bands[y]))
    wanted = {p: s for p, s in naive.similar(made, 0.1).items() if meet(*p)}
    assert {(r[0], r[1]): r[2] for r in found.collect()} == wanted


def test_recall_is_near_its_formula(spark):
    # Pairs of sets with Jaccard 1/3; n hashes find them with probability 1 - (2/3)^n. The formula
    # holds for elements without a pattern, so they are drawn at random.
    ids = random.Random(8).sample(range(10**6), 150 * 15)
    made = [(2 * p + side, ids[15 * p + u]) for p in range(150) for side in (0, 1) for u in range(side * 5, side * 5 + 10)]
    table = members(spark, made)
    truth = pairs.similar_pairs(table, threshold=0.3)
    for n_hashes, low, high in ((20, 0.99, 1.0), (2, 0.40, 0.70)):
        family = minhash.hash_family(n_hashes, 4)
        found = minhash.similar_pairs_lsh(table, threshold=0.3, family=family, bucketed=False)
        measured = evaluate.precision_recall(found, truth).first()
        assert measured["precision"] == 1.0 and low <= measured["recall"] <= high
        assert measured["n_truth"] == 150


def test_signature_agreement_estimates_jaccard_as_in_spark_ml(spark):
    from pyspark.ml.feature import MinHashLSH
    from pyspark.ml.linalg import Vectors

    made = random_sets(9)
    table = members(spark, made)
    exact = naive.similar(made, 0.15)
    vectors = spark.createDataFrame(
        [(b, Vectors.sparse(200, sorted(u), [1.0] * len(u))) for b, u in naive.sets_of(made).items()], ["id", "features"]
    )
    model = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=60, seed=1).fit(vectors)
    joined = model.approxSimilarityJoin(vectors, vectors, 0.85, "d").filter("datasetA.id < datasetB.id and d < 0.85")
    theirs = {(r[0], r[1]) for r in joined.select(F.col("datasetA.id"), F.col("datasetB.id")).collect()}
    ours = minhash.similar_pairs_lsh(table, threshold=0.15, family=minhash.hash_family(60, 1), bucketed=False)
    found = {(r[0], r[1]) for r in ours.collect()}
    strict = {p for p, s in exact.items() if s > 0.15}
    assert found <= exact.keys() and theirs <= exact.keys()
    assert len(found & strict) >= 0.95 * len(strict) and len(theirs & strict) >= 0.95 * len(strict)


def test_plan_chooses_the_method(spark):
    reviews = members(spark, random_sets())
    exact = set(rows(similar_businesses(reviews, 0.1, "exact")))
    assert set(rows(similar_businesses(reviews, 0.1, "lsh"))) <= exact and exact
    with pytest.raises(ValueError):
        similar_businesses(reviews, method="other")


def test_candidate_pairs_hold_those_that_share_one_element(spark):
    sets = {"a": {1, 2, 3, 4}, "b": {1, 2, 3, 5}, "c": {4, 6}, "d": {7, 8}, "e": {1, 2, 9}}
    sample = [(k, v) for k, vs in sets.items() for v in vs]
    members = spark.createDataFrame(sample, "business_id string, user_id int")
    found = {tuple(r)[:3]: r.n_bands for r in minhash.lsh_candidate_pairs(members).collect()}
    signed = {r.business_id: r.signature for r in minhash.minhash_signatures(members).collect()}
    want = {}
    for x in sets:
        for y in sets:
            n, met = len(sets[x] & sets[y]), sum(i == j for i, j in zip(signed[x], signed[y]))
            if x < y and n and met:
                want[x, y, n] = met
    assert found == want and min(n for _, _, n in found) == 1


@pytest.mark.parametrize("rows_per_band", [1, 2])
@pytest.mark.parametrize("block_rows", [1, 4, 1000])
def test_bucket_pairs_equal_the_definition(spark, rows_per_band, block_rows):
    made = random_sets() + [(b, 900) for b in range(100, 130)]  # 30 equal sets share all buckets
    family = minhash.hash_family(6, 3)
    signatures = naive_signatures(made, family, True)
    bands = {b: [tuple(s[i : i + rows_per_band]) for i in range(0, 6, rows_per_band)] for b, s in signatures.items()}
    want = {}
    for x in bands:
        for y in bands:
            met = sum(p == q for p, q in zip(bands[x], bands[y]))
            if x < y and met:
                want[x, y] = met
    signed = minhash.minhash_signatures(members(spark, made), family=family)
    found = minhash.lsh_pairs(signed, "business_id", 6, rows_per_band, block_rows).collect()
    assert {(r.a, r.b): r.n_bands for r in found} == want and len(found) == len(want)

    listed = minhash.lsh_candidate_pairs(members(spark, made), min_overlap=0, family=family, rows_per_band=rows_per_band)
    sets = naive.sets_of(made)
    assert rows(listed) == sorted(((x, y, len(sets[x] & sets[y]), n) for (x, y), n in want.items()), key=repr)


@pytest.mark.parametrize("rows_per_band", [1, 2, 3])
def test_both_starts_give_the_same_pairs(spark, rows_per_band):
    made = random_sets(6, 500) + [(b, u) for b in (200, 201, 202) for u in range(100, 160)]
    table, family = members(spark, made), minhash.hash_family(12, 3)
    found = [
        rows(minhash.similar_pairs_lsh(table, threshold=0.1, family=family, rows_per_band=rows_per_band, start=start))
        for start in ("buckets", "elements", None)
    ]
    assert found[0] == found[1] == found[2] and found[0]
    with pytest.raises(ValueError):
        minhash.similar_pairs_lsh(table, start="other")


def test_banded_pairs_do_not_start_from_all_pairs(spark):
    table = members(spark, random_sets())
    found = minhash.similar_pairs_lsh(table, family=minhash.hash_family(8, 1), rows_per_band=2)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_lo#" in plan  # blocks of buckets
    assert not re.search(r"\bvia#", plan)  # no self-join of the sets by their elements
    exact = pairs.similar_pairs(table)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"\bvia#", exact)


def test_rows_that_look_elements_up_hold_no_sizes(spark):
    made = random_sets(6, 300)
    table = members(spark, made)
    sized = pairs.with_sizes(pairs.overlap_pairs(table, "business_id", "user_id").select("a", "b"), table, "business_id")
    found = pairs.looked_up(sized, table, "business_id", "user_id")
    sets = naive.sets_of(made)
    want = {(x, y): (len(sets[x]), len(sets[y]), len(sets[x] & sets[y])) for x in sets for y in sets if x < y and sets[x] & sets[y]}
    assert {(r.a, r.b): (r.size_a, r.size_b, r.n) for r in found.collect()} == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    met = next(line for line in plan.split("\n") if "Aggregate [_few" in line)
    assert "size_" not in met


@pytest.mark.parametrize("chunk", [1, 7, 100_000])
def test_a_large_set_is_cut_into_pieces(spark, chunk):
    made = random_sets(3) + [(77, u) for u in range(500)]
    ids = {u: i for i, u in enumerate(sorted({u for _, u in made}))}
    coded = spark.createDataFrame([(b, ids[u]) for b, u in made], "business_id long, idx long").repartition(4)
    family = minhash.hash_family(9, 2)
    found = minhash.minhash(coded, "business_id", family, chunk=chunk).collect()
    assert {r.business_id: r.signature for r in found} == naive_signatures(made, family, False)


def test_ids_of_an_empty_table_and_nulls(spark):
    assert minhash.encode_ids(spark.createDataFrame([], "k string"), "k").collect() == []
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "k string")
    assert rows(minhash.encode_ids(df, "k")) == [("a", 0), ("b", 1)]


@pytest.mark.parametrize(("per_band", "floor", "shift"), [(1, 5_000, 0), (2, 8, 2**40), (1, 8, None)])
def test_candidates_are_listed_in_rounds_where_their_lists_are_long(spark, monkeypatch, per_band, floor, shift):
    made = random_sets() + [(b, 900) for b in range(100, 130)] + [(5, None), (None, 900), (2**24, 900), (2**24 - 1, 101)]
    if shift is None:
        table = spark.createDataFrame([(b and f"{b:09d}", u) for b, u in made], "business_id string, user_id long")
    else:
        table = members(spark, [(b and b + shift, u) for b, u in made if b != 2**24 or not shift])
    listed, written = [], []
    for most in (10**9, 1_500):
        monkeypatch.setattr(pairs, "ROUND_PAIRS", most)
        monkeypatch.setattr(pairs, "_written", lambda *given, real=pairs._written: written.append(1) or real(*given))
        found = minhash.lsh_candidate_pairs(table, min_overlap=0, family=minhash.hash_family(6, 3), rows_per_band=per_band, hot_floor=floor)
        listed.append(rows(found))
        if most == 10**9:
            assert not written
        else:
            assert len(written) > 1 and "low_bs" not in found._jdf.queryExecution().optimizedPlan().toString()
        monkeypatch.undo()
    assert listed[0] == listed[1] and len(listed[0]) > 400 and any(r[2] > 1 for r in listed[0])
