import math

import pytest

from kindred.operators import text
from kindred.plans import content
from tests.conftest import rows


def reviews(spark, made):
    return spark.createDataFrame(made, "user_id string, business_id string, text string")


REVIEWS = [
    ("u1", "b1", "Good food, GOOD service!"),
    ("u2", "b1", "the food"),
    ("u1", "b2", "Bad food"),
    ("u3", "b3", "the the 123"),
]


def test_words_are_letters_only_and_line_breaks_fuse(spark):
    made = [("u", "b", "Crème brûlée2go!\nthe end\tx Straße")]
    assert rows(text.review_tokens(reviews(spark, made)).select("word")) == [
        ("brûléegothe",),
        ("crème",),
        ("endx",),
        ("straße",),
    ]
    split = text.review_tokens(reviews(spark, made), newline_as_space=True).select("word")
    assert rows(split) == [("brûléego",), ("crème",), ("end",), ("straße",), ("the",), ("x",)]


def test_stopwords_as_list_or_table(spark):
    expected = [("b1", "food", 2), ("b1", "good", 2), ("b1", "service", 1), ("b2", "bad", 1), ("b2", "food", 1)]
    assert rows(text.word_counts(reviews(spark, REVIEWS), ["the"])) == expected
    table = spark.createDataFrame([("the",), ("zzz",)], "word string")
    assert rows(text.word_counts(reviews(spark, REVIEWS), table)) == expected


def test_tf_and_idf(spark):
    df = reviews(spark, REVIEWS)
    counts = text.word_counts(df, ["the"])
    assert rows(text.term_frequency(counts))[0] == ("b1", "food", 1.0)
    # b3 holds no word, and still is one of three businesses.
    found = {r["word"]: (r["df"], r["idf"]) for r in text.idf(counts, df).collect()}
    assert found["food"] == (2, pytest.approx(math.log2(3 / 2)))
    assert found["bad"] == (1, pytest.approx(math.log2(3)))
    scored = {(r[0], r[1]): r[2] for r in text.tfidf(counts, df).collect()}
    assert scored["b1", "service"] == pytest.approx(0.5 * math.log2(3), abs=1e-9)


def test_profiles_are_cut_by_score_then_word(spark):
    df = reviews(spark, [("u", "b", "pear apple fig"), ("v", "c", "kiwi")])
    profiles = text.business_profiles(text.tfidf(text.word_counts(df), df), k=2)
    assert [r["word"] for r in profiles.filter("business_id = 'b'").orderBy("rank").collect()] == ["apple", "fig"]


def test_a_word_in_every_business_stays(spark):
    df = reviews(spark, [("u", "b", "same"), ("v", "c", "same")])
    assert rows(text.tfidf(text.word_counts(df), df)) == [("b", "same", 0.0), ("c", "same", 0.0)]


def test_user_profile_takes_the_best_score_of_a_word(spark):
    df = reviews(spark, [("u", "b1", ""), ("u", "b2", "")])
    profiles = spark.createDataFrame(
        [("b1", "x", 0.1, 2), ("b1", "y", 0.5, 1), ("b2", "x", 0.9, 1)],
        "business_id string, word string, tfidf double, rank int",
    )
    assert rows(text.user_profiles(df, profiles)) == [("u", "x", 0.9, 1), ("u", "y", 0.5, 2)]
    assert rows(text.user_profiles(df, profiles, k=1)) == [("u", "x", 0.9, 1)]


def test_scores_of_known_unknown_and_repeated_rows(spark):
    businesses = spark.createDataFrame([("b", ["x", "y"]), ("e", [])], "business_id string, fvec array<string>")
    users = spark.createDataFrame([("u", ["x", "z", "w"])], "user_id string, fvec array<string>")
    pairs = spark.createDataFrame(
        [("u", "b"), ("u", "b"), ("u", "nobody"), ("new", "b"), ("u", "e")], "user_id string, business_id string"
    )
    scores = text.content_scores(pairs, businesses, users)
    sim = round(1 / math.sqrt(6), 9)
    assert rows(scores) == [("new", "b", 0.0), ("u", "b", sim), ("u", "b", sim), ("u", "e", 0.0), ("u", "nobody", 0.0)]
    assert rows(text.content_predict(scores)) == [("u", "b", sim), ("u", "b", sim)]


def test_model_holds_both_kinds_and_splits_again(spark):
    model = content.train_content_model(reviews(spark, REVIEWS), ["the"])
    businesses, users = text.split_content_model(model)
    assert {r["business_id"] for r in businesses.collect()} == {"b1", "b2"}
    assert {r["user_id"]: set(r["fvec"]) for r in users.collect()}["u1"] == {"good", "food", "service", "bad"}
    pairs = spark.createDataFrame([("u2", "b1"), ("u3", "b1")], "user_id string, business_id string")
    assert rows(content.predict_content(pairs, businesses, users)) == [("u2", "b1", 1.0)]
