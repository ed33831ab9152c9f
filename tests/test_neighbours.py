import random

import pytest
from pyspark.sql import functions as F

from kindred.operators import evaluate, minhash, neighbours
from kindred.plans import collaborative
from tests import naive
from tests.conftest import rows

SCHEMA = "user_id long, business_id long, stars double, at long"


def model_table(spark, model, left="b1", right="b2"):
    return spark.createDataFrame([(x, y, s) for (x, y), s in model.items()], f"{left} long, {right} long, sim double")


def as_dict(df):
    return {(r[0], r[1]): r[2] for r in df.collect()}


@pytest.fixture(scope="module")
def world(spark):
    ratings = naive.skewed_ratings(random.Random(17))
    draw = random.Random(5)
    targets = [(draw.randrange(45), draw.randrange(65)) for _ in range(250)]
    targets += targets[:20] + [(0, 0), (0, 1), (1, 0)]
    return (
        ratings,
        targets,
        spark.createDataFrame(ratings, SCHEMA),
        spark.createDataFrame(targets, "user_id long, business_id long"),
    )


@pytest.mark.parametrize("floor", [5_000, 10])
def test_models_equal_brute_force(world, floor):
    ratings, _, df, _ = world
    assert as_dict(neighbours.item_cf_model(df, ["at"], hot_floor=floor)) == pytest.approx(naive.cf_model(ratings, by=1))
    found = as_dict(neighbours.user_cf_model_exact(df, ["at"], min_jaccard=0.2, hot_floor=floor))
    assert found == pytest.approx(naive.cf_model(ratings, by=0, min_jaccard=0.2)) and found


def test_lsh_user_model_is_part_of_the_exact_one(world):
    _, _, df, _ = world
    exact = as_dict(neighbours.user_cf_model_exact(df, ["at"]))
    family = minhash.hash_family(6, 2)
    found = as_dict(neighbours.user_cf_model_lsh(df, ["at"], family, bucketed=False))
    assert found.items() < exact.items()
    assert as_dict(neighbours.user_cf_model_lsh(df, ["at"], family, bucketed=False)) == found


@pytest.mark.parametrize("rows_per_band", [1, 2])
def test_lsh_user_model_is_the_same_from_either_start(world, rows_per_band):
    ratings, _, df, _ = world
    family = minhash.hash_family(6, 2)
    options = {"family": family, "rows_per_band": rows_per_band, "bucketed": False, "min_jaccard": 0.1}
    found = [as_dict(neighbours.user_cf_model_lsh(df, ["at"], start=s, **options)) for s in ("buckets", "elements")]
    assert found[0] == found[1] and found[0]
    exact = naive.cf_model(ratings, by=0, min_jaccard=0.1)
    assert found[0] == pytest.approx({p: exact[p] for p in found[0]})


@pytest.mark.parametrize("chunk", [100_000, 25, 3])
def test_item_predictions_equal_brute_force(spark, world, chunk):
    ratings, targets, df, target_df = world
    model = naive.cf_model(ratings, by=1)
    found = neighbours.item_cf_predict(target_df, df, model_table(spark, model), chunk=chunk)
    expected = naive.predict_items(targets, ratings, model, 5)
    assert rows(found.withColumn("stars", F.round("stars", 6))) == sorted(expected, key=repr)


@pytest.mark.parametrize("chunk", [100_000, 25, 3])
def test_user_predictions_equal_brute_force(spark, world, chunk):
    ratings, targets, df, target_df = world
    model = naive.cf_model(ratings, by=0)
    found = neighbours.user_cf_predict(target_df, df, model_table(spark, model, "u1", "u2"), ["at"], chunk=chunk)
    expected = naive.predict_users(targets, ratings, model, 20)
    assert rows(found.withColumn("stars", F.round("stars", 6))) == sorted(expected, key=repr)


def test_conflicting_stars_are_two_neighbours(spark):
    ratings = spark.createDataFrame([(1, 7, 2.0, 1), (1, 7, 4.0, 2)], SCHEMA)
    target = spark.createDataFrame([(1, 8)], "user_id long, business_id long")
    model = model_table(spark, {(7, 8): 0.5})
    assert rows(neighbours.item_cf_predict(target, ratings, model)) == [(1, 8, 3.0)]
    assert rows(neighbours.item_cf_predict(target, ratings, model, top_n=1)) == [(1, 8, 2.0)]


def test_single_rating_neighbour_deviates_by_nothing(spark):
    # The neighbour's only rating leaves a deviation of 0, and so no prediction by default.
    ratings = spark.createDataFrame([(1, 5, 3.0, 1), (2, 8, 5.0, 2)], SCHEMA)
    target = spark.createDataFrame([(1, 8)], "user_id long, business_id long")
    model = model_table(spark, {(1, 2): 0.9}, "u1", "u2")
    assert rows(neighbours.user_cf_predict(target, ratings, model)) == []
    kept = neighbours.user_cf_predict(target, ratings, model, emit_zero_deviation=True)
    assert rows(kept) == [(1, 8, 3.0)]


def test_neighbour_mean_leaves_the_target_item_out(spark):
    ratings = spark.createDataFrame([(1, 5, 3.0, 1), (2, 8, 5.0, 2), (2, 6, 2.0, 3), (2, 7, 3.0, 4)], SCHEMA)
    target = spark.createDataFrame([(1, 8)], "user_id long, business_id long")
    model = model_table(spark, {(1, 2): 0.9}, "u1", "u2")
    assert rows(neighbours.user_cf_predict(target, ratings, model)) == [(1, 8, 5.5)]
    assert rows(neighbours.user_cf_predict(target, ratings, model, clip=(1, 5))) == [(1, 8, 5.0)]


def test_unknown_users_and_items_have_no_prediction(spark):
    ratings = spark.createDataFrame([(1, 7, 2.0, 1)], SCHEMA)
    target = spark.createDataFrame([(9, 8), (1, 99)], "user_id long, business_id long")
    assert rows(neighbours.item_cf_predict(target, ratings, model_table(spark, {(7, 8): 0.5}))) == []


def test_support_filter_beyond_the_overlap(spark, world):
    ratings, _, df, _ = world
    counts = {}
    for _, item, *_ in ratings:
        counts[item] = counts.get(item, 0) + 1
    found = as_dict(neighbours.item_cf_model(df, ["at"], min_ratings=12))
    expected = {p: s for p, s in naive.cf_model(ratings, by=1).items() if min(counts[p[0]], counts[p[1]]) >= 12}
    assert found == pytest.approx(expected)


def test_modes(spark, world):
    _, _, df, target_df = world
    model = collaborative.cf_train(df, "item_based", ["at"])
    assert model.columns == ["b1", "b2", "sim"]
    assert collaborative.cf_train(df, "user_based", ["at"], method="exact").columns == ["u1", "u2", "sim"]
    assert collaborative.cf_predict(target_df, df, model, "item_based").count() > 0
    for call in (lambda m: collaborative.cf_train(df, m), lambda m: collaborative.cf_predict(target_df, df, model, m)):
        with pytest.raises(ValueError):
            call("neither")


def test_rmse_and_precision_recall(spark):
    truth = spark.createDataFrame([(1, 1, 4.0), (1, 1, 2.0), (2, 2, 5.0)], "user_id long, business_id long, stars double")
    predicted = spark.createDataFrame([(1, 1, 3.0), (1, 1, 3.0)], "user_id long, business_id long, stars double")
    assert rows(evaluate.rmse(predicted, truth)) == [(3, 2, 1.0)]
    nothing = predicted.limit(0)
    assert rows(evaluate.rmse(nothing, truth)) == [(3, 0, None)]
    found = spark.createDataFrame([(1, 2), (1, 3)], "b1 long, b2 long")
    wanted = spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "b1 long, b2 long")
    assert rows(evaluate.precision_recall(found, wanted)) == [(2, 3, 1, 0.5, 1 / 3)]
