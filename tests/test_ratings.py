from kindred.operators import ratings as rated
from kindred.operators import skew
from tests.conftest import rows

RAW = [
    ("u", "x", 5.0, 1),
    ("u", "x", 2.0, 2),
    ("u", "y", 3.0, 3),
    ("v", "x", 4.0, 4),
    ("v", "x", 4.0, 5),
]


def raw(spark):
    return spark.createDataFrame(RAW, "user_id string, business_id string, stars double, at long")


def test_the_last_rating_wins(spark):
    assert rows(rated.dedup_ratings(raw(spark), ["at"])) == [("u", "x", 2.0), ("u", "y", 3.0), ("v", "x", 4.0)]


def test_without_an_order_the_greatest_stars_win(spark):
    assert ("u", "x", 5.0) in rows(rated.dedup_ratings(raw(spark)))


def test_distinct_ratings_keep_conflicting_stars(spark):
    assert rows(rated.distinct_user_ratings(raw(spark))) == [
        ("u", "x", 2.0),
        ("u", "x", 5.0),
        ("u", "y", 3.0),
        ("v", "x", 4.0),
    ]


def test_user_statistics_count_raw_rows(spark):
    assert rows(rated.user_rating_stats(raw(spark))) == [("u", 10.0, 3, 10 / 3), ("v", 8.0, 2, 4.0)]


def test_support_counts_rows_not_raters(spark):
    assert rows(rated.min_support_items(raw(spark))) == [("x", 4)]
    kept = rated.keep_supported(raw(spark), rated.dedup_ratings(raw(spark), ["at"]))
    assert {r["business_id"] for r in kept.collect()} == {"x"}


def test_entity_members_are_distinct(spark):
    assert rows(rated.entity_members(raw(spark))) == [("x", "u"), ("x", "v"), ("y", "u")]


def test_spread_join_equals_a_plain_join(spark):
    left = spark.createDataFrame([(i % 3 if i % 2 else 0, i) for i in range(300)], "k long, v long")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (5, "c")], "k long, w string")
    for how in ("inner", "left"):
        plain = rows(left.join(right, "k", how))
        weights = skew.count_by(left, "k")
        assert rows(skew.spread_join(left, right, ["k"], how, weights=weights, chunk=20)) == plain
        assert rows(skew.spread_join(left, right, ["k"], how, hot=skew.hot_keys(left, ["k"], 20), chunk=20)) == plain
        assert rows(skew.salted_join(left, right, "k", "v", how, pieces=5)) == plain


def test_heavy_hitters_are_bounded_and_repeatable(spark):
    df = spark.createDataFrame([(i % 100,) for i in range(1000)], "k long")
    hot = skew.hot_keys(df, ["k"], 5, limit=64)
    assert [r["k"] for r in hot] == list(range(64))


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), ("c", 13)], "k string, n long")
    assert skew.repeat_rows(df, "n", step=4).groupBy("k").count().orderBy("k").collect() == [("a", 1), ("b", 5), ("c", 13)]
