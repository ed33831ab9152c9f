import glob
import json
import os
import tempfile
import time

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from kindred.operators import minhash, text
from kindred.session import materialize, own_tables
from kindred.plans.collaborative import cf_train
from kindred.sources import json_lines as io
from tests.conftest import rows


def write_lines(path, lines):
    path.write_text("".join(f"{line}\n" for line in lines))
    return str(path)


REVIEWS = [
    {"user_id": "u1", "business_id": "b1", "stars": 4, "text": "good\nfood", "extra": [1]},
    {"business_id": "b2", "user_id": "u2", "stars": 2.5, "text": "bad"},
]


def test_reviews(spark, tmp_path):
    path = write_lines(tmp_path / "r.json", [json.dumps(r) for r in REVIEWS])
    assert rows(io.read_reviews(spark, path)) == [("u1", "b1", 4.0, "good\nfood"), ("u2", "b2", 2.5, "bad")]
    assert io.read_reviews(spark, path, ["user_id", "business_id"]).columns == ["user_id", "business_id"]


def test_bad_rows_are_dropped_counted_or_fatal(spark, tmp_path):
    lines = [json.dumps(REVIEWS[0]), "{not json", json.dumps({"user_id": "u3", "stars": 1})]
    path = write_lines(tmp_path / "bad.json", lines)
    assert io.read_reviews(spark, path, on_bad="drop").count() == 1
    assert rows(io.read_reviews(spark, path, ["user_id"], on_bad="drop")) == [("u1",), ("u3",)]
    assert rows(io.count_bad_reviews(spark, path)) == [(3, 2)]
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        io.read_reviews(spark, path, on_bad="fail").collect()
    short = write_lines(tmp_path / "short.json", lines[2:])
    with pytest.raises(Exception, match="row without business_id"):
        io.read_reviews(spark, short, on_bad="fail").collect()
    with pytest.raises(ValueError):
        io.read_reviews(spark, path, on_bad="ignore")


def test_a_review_without_stars_stays(spark, tmp_path):
    line = json.dumps({"user_id": "u3", "business_id": "b3", "text": "fine"})
    reviews = io.read_reviews(spark, write_lines(tmp_path / "s.json", [json.dumps(REVIEWS[0]), line]))
    assert reviews.count() == 2
    with pytest.raises(Exception, match="without stars"):
        cf_train(reviews, "item_based").collect()


def test_test_pairs_keep_repeats(spark, tmp_path):
    pair = json.dumps({"user_id": "u", "business_id": "b", "stars": 3})
    path = write_lines(tmp_path / "t.json", [pair, pair])
    assert rows(io.read_test_pairs(spark, path)) == [("u", "b"), ("u", "b")]


def test_stopwords_are_trimmed(spark, tmp_path):
    path = write_lines(tmp_path / "stop.txt", ["the ", " and", "of\t", "the"])
    assert rows(io.read_stopwords(spark, path)) == [("and",), ("of",), ("the",)]


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_cf_model_round_trip_orders_pairs(spark, tmp_path, fmt):
    model = spark.createDataFrame([("x", "a", 0.25), ("b", "c", 1.0)], "b1 string, b2 string, sim double")
    io.write_pairs(model, str(tmp_path / "m"), fmt)
    assert rows(io.read_cf_model(spark, str(tmp_path / "m"), fmt=fmt)) == [("a", "x", 0.25), ("b", "c", 1.0)]
    with pytest.raises(ValueError):
        io.write_pairs(model.withColumnRenamed("b1", "z"), str(tmp_path / "n"))


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_content_model_round_trip(spark, tmp_path, fmt):
    profile = "word string, tfidf double, rank int"
    businesses = spark.createDataFrame([("b", "x", 1.0, 1), ("b", "y", 0.5, 2)], f"business_id string, {profile}")
    users = spark.createDataFrame([("u", "y", 0.5, 1)], f"user_id string, {profile}")
    path = str(tmp_path / "model")
    io.write_content_model(text.content_model(businesses, users), path, fmt)
    biz, usr = io.read_content_model(spark, path, fmt)
    assert rows(biz) == [("b", ["x", "y"])] and rows(usr) == [("u", ["y"])]
    if fmt == "json":
        records = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
        assert {"type": "biz", "biz_id": "b", "fvec": ["x", "y"]} in records
        assert {"type": "user", "user_id": "u", "fvec": ["y"]} in records


def test_predictions_and_scores(spark, tmp_path):
    stars = spark.createDataFrame([("u", "b", 3.5)], "user_id string, business_id string, stars double")
    io.write_predictions(stars, str(tmp_path / "p"))
    assert [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "p")).collect()] == [
        {"user_id": "u", "business_id": "b", "stars": 3.5}
    ]
    io.write_predictions(stars.withColumnRenamed("stars", "sim"), str(tmp_path / "s"))
    assert "sim" in spark.read.json(str(tmp_path / "s")).columns


def test_materialize_uses_the_folder_the_cluster_names(spark):
    df = spark.range(5)
    kept = materialize(df)
    assert rows(kept) == rows(df)
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in kept.inputFiles())


LINES = [
    '{"user_id": "u1", "business_id": "b1", "stars": 4.0, "text": "good"}',
    '{"user_id": "u2", "stars": 1.0}',
    '{"user_id": "u3", "business_id": "b3"',
    "",
    "not json",
    '{"user_id": "u4", "business_id": "b4", "stars": "many"}',
    '{"user_id": "u5", "business_id": "b5", "more": 1}',
]


def test_dropped_test_pairs_are_counted_in_the_same_pass(spark, tmp_path):
    path = tmp_path / "lines"
    path.write_text("\n".join(LINES[:3] + LINES[5:]))
    counts = Observation()
    kept = io.read_test_pairs(spark, str(path), counts=counts)
    assert rows(kept) == [("u1", "b1"), ("u4", "b4"), ("u5", "b5")]
    assert counts.get == {"n_rows": 5, "n_bad": 2}
    counts = Observation()
    assert io.read_reviews(spark, str(path), ("user_id", "business_id"), "drop", counts).count() == 3
    assert counts.get["n_bad"] == 2


def test_bad_lines_are_kept_beside_the_rows(spark, tmp_path):
    path = tmp_path / "lines"
    path.write_text("\n".join(LINES))
    good, bad, counts = io.split_lines(spark, str(path), str(tmp_path / "out"))
    assert rows(good) == [("u1", "b1", 4.0, "good"), ("u5", "b5", None, None)]
    assert sorted(r.line for r in bad.collect()) == sorted(LINES[1:6])
    assert counts == {"n_rows": 7, "n_bad": 5}


def test_candidates_are_counted_in_the_run_that_verifies_them(spark):
    made = [(b, u) for b in range(12) for u in range(b, b + 6)]
    members = spark.createDataFrame(made, "business_id long, user_id long")
    family = minhash.hash_family(8, 1)
    signatures = minhash.minhash_signatures(members, family=family)
    for per_band in (1, 2):
        counts = Observation()
        found = minhash.similar_pairs_lsh(members, threshold=0.5, family=family, rows_per_band=per_band, start="buckets", counts=counts)
        assert 0 < found.count() <= counts.get["n_candidates"] == minhash.lsh_pairs(signatures, "business_id", 8, per_band).count()


def test_tables_are_deleted_by_their_owner(spark):
    before = materialize(spark.range(3))
    with own_tables(spark):
        inside = materialize(spark.range(5))
        with own_tables(spark):
            inner = materialize(spark.range(7))
        assert inside.count() == 5
    assert before.count() == 3
    for gone in (inside, inner):
        assert not os.path.exists(gone.inputFiles()[0].removeprefix("file://"))
    with pytest.raises(ZeroDivisionError), own_tables(spark):
        left = materialize(spark.range(2))
        raise ZeroDivisionError
    assert not os.path.exists(left.inputFiles()[0].removeprefix("file://"))


def test_shuffle_files_go_with_the_plan_that_made_a_table(spark):
    def held():
        return {f for d in glob.glob(f"{tempfile.gettempdir()}/blockmgr-*") for f in glob.glob(f"{d}/*/shuffle_*.data")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    for given in (None, "false"):
        if given:
            spark.conf.set(key, given)
        before, was = held(), spark.conf.get(key, None)
        kept = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
        for _ in range(50):
            if not (left := held() - before):
                break
            time.sleep(0.1)
        assert not left and kept.count() == 7
        assert (spark.conf.get(key, None) or "false") == (was or "false") == "false"  # unset or, once Spark knows it, its default
    spark.conf.unset(key)
    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().collect()
    assert held() - before  # the folder is the right one
