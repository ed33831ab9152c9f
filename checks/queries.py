"""The registered queries: each runs one operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from checks.inputs import ORDER, STOPWORDS
from kindred.operators import evaluate, minhash, neighbours, pairs, text
from kindred.operators import ratings as rated
from kindred.plans import content
from kindred.session import materialize

Query = Callable[[SparkSession, str], DataFrame]

# Signature hashes of the item and the user queries; the checking SQL inlines the same tables.
ITEM_FAMILY = minhash.hash_family(minhash.ITEM_HASHES, seed=20260801)
USER_FAMILY = minhash.hash_family(minhash.USER_HASHES, seed=20260802)
LOW_FLOOR = 48
LOW_CHUNK = 10
# Values the operators have not rounded are rounded once, for the comparison.
DIGITS = 6


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rated.entity_members(inputs.ratings(spark, sf_dir))


def _signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.minhash_signatures(_members(spark, sf_dir), family=ITEM_FAMILY)


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rated.dedup_ratings(inputs.ratings(spark, sf_dir), ORDER)


# -- ratings and exact pairs ---------------------------------------------------------------------


def entity_sets(spark, sf_dir):
    return _members(spark, sf_dir)


def cooccurrence_pairs(spark, sf_dir):
    shared = pairs.overlap_pairs(_members(spark, sf_dir), "business_id", "user_id", min_overlap=3)
    return shared.select(F.col("a").alias("b1"), F.col("b").alias("b2"), "n")


def jaccard_pairs(spark, sf_dir):
    return pairs.jaccard_pairs(_members(spark, sf_dir))


def similar_pairs_exact(spark, sf_dir):
    return pairs.similar_pairs(_members(spark, sf_dir))


def dedup_ratings(spark, sf_dir):
    return _latest(spark, sf_dir)


def distinct_user_ratings(spark, sf_dir):
    return rated.distinct_user_ratings(inputs.ratings(spark, sf_dir))


def user_rating_stats(spark, sf_dir):
    return _rounded(rated.user_rating_stats(inputs.ratings(spark, sf_dir)), "mean_stars")


def min_support_items(spark, sf_dir):
    return rated.min_support_items(inputs.ratings(spark, sf_dir))


def supported_ratings(spark, sf_dir):
    raw = inputs.ratings(spark, sf_dir)
    return rated.keep_supported(raw, rated.dedup_ratings(raw, ORDER), min_ratings=30)


def pair_moments(spark, sf_dir):
    moments = pairs.pair_moments(_latest(spark, sf_dir))
    return moments.withColumnsRenamed({"a": "b1", "b": "b2"})


def pearson_pairs(spark, sf_dir):
    sims = pairs.pearson_pairs(pairs.pair_moments(_latest(spark, sf_dir)))
    return sims.withColumnsRenamed({"a": "b1", "b": "b2"})


# The same with floors that the given tables reach: many users are hot, and many lists are long.


def similar_pairs_hot(spark, sf_dir):
    return pairs.similar_pairs(_members(spark, sf_dir), hot_floor=LOW_FLOOR)


def cooccurrence_pairs_hot(spark, sf_dir):
    shared = pairs.overlap_pairs(_members(spark, sf_dir), "business_id", "user_id", min_overlap=3, hot_floor=LOW_FLOOR)
    return shared.select(F.col("a").alias("b1"), F.col("b").alias("b2"), "n")


def pair_moments_hot(spark, sf_dir):
    moments = pairs.pair_moments(_latest(spark, sf_dir), hot_floor=LOW_FLOOR)
    return moments.withColumnsRenamed({"a": "b1", "b": "b2"})


# -- MinHash and LSH -----------------------------------------------------------------------------


def encode_ids(spark, sf_dir):
    return minhash.encode_ids(inputs.ratings(spark, sf_dir), "user_id")


def minhash_signatures(spark, sf_dir):
    return _signatures(spark, sf_dir).select("business_id", F.posexplode("signature").alias("pos", "value"))


def _groups(spark, sf_dir, rows_per_band):
    groups = minhash.lsh_candidates(
        _signatures(spark, sf_dir), "business_id", minhash.ITEM_HASHES, rows_per_band
    )
    return groups.withColumn("bucket", F.concat_ws(",", F.col("bucket").cast("array<string>")))


def lsh_candidates(spark, sf_dir):
    return _groups(spark, sf_dir, 1)


def lsh_candidates_banded(spark, sf_dir):
    return _groups(spark, sf_dir, 2)


def lsh_stats(spark, sf_dir):
    return minhash.lsh_stats(_signatures(spark, sf_dir), "business_id", minhash.ITEM_HASHES)


def lsh_candidate_pairs(spark, sf_dir):
    return minhash.lsh_candidate_pairs(_members(spark, sf_dir), min_overlap=0, family=ITEM_FAMILY)


def similar_pairs_lsh(spark, sf_dir):
    return minhash.similar_pairs_lsh(_members(spark, sf_dir), family=ITEM_FAMILY)


def similar_pairs_lsh_banded(spark, sf_dir):
    found = minhash.similar_pairs_lsh(_members(spark, sf_dir), family=ITEM_FAMILY, rows_per_band=2, bucketed=False)
    return found


def lsh_precision_recall(spark, sf_dir):
    members = materialize(_members(spark, sf_dir))
    truth = materialize(pairs.similar_pairs(members, raw=members))
    found = minhash.similar_pairs_lsh(members, family=ITEM_FAMILY)
    return _rounded(evaluate.precision_recall(found, truth), "precision", "recall")


def user_cf_model_lsh(spark, sf_dir):
    return neighbours.user_cf_model_lsh(inputs.ratings(spark, sf_dir), ORDER, USER_FAMILY)


def user_cf_model_lsh_banded(spark, sf_dir):
    ratings = inputs.ratings(spark, sf_dir)
    return neighbours.user_cf_model_lsh(ratings, ORDER, USER_FAMILY, rows_per_band=2, bucketed=False)


# -- collaborative filtering ---------------------------------------------------------------------


def item_cf_model(spark, sf_dir):
    return neighbours.item_cf_model(inputs.ratings(spark, sf_dir), ORDER)


def user_cf_model_exact(spark, sf_dir):
    return neighbours.user_cf_model_exact(inputs.ratings(spark, sf_dir), ORDER)


def _item_predictions(train, test, **options):
    model = materialize(neighbours.item_cf_model(train, ORDER))
    return neighbours.item_cf_predict(test, train, model, **options)


def _user_predictions(train, test, **options):
    model = materialize(neighbours.user_cf_model_exact(train, ORDER))
    return neighbours.user_cf_predict(test, train, model, ORDER, **options)


def item_cf_predict(spark, sf_dir):
    return _rounded(_item_predictions(*inputs.train_and_test(spark, sf_dir)), "stars")


def user_cf_predict(spark, sf_dir):
    return _rounded(_user_predictions(*inputs.train_and_test(spark, sf_dir)), "stars")


def item_cf_predict_ranked(spark, sf_dir):
    return _rounded(_item_predictions(*inputs.train_and_test(spark, sf_dir), chunk=LOW_CHUNK), "stars")


def user_cf_predict_ranked(spark, sf_dir):
    return _rounded(_user_predictions(*inputs.train_and_test(spark, sf_dir), chunk=LOW_CHUNK), "stars")


def item_cf_rmse(spark, sf_dir):
    train, test = inputs.train_and_test(spark, sf_dir)
    return _rounded(evaluate.rmse(_item_predictions(train, test), test), "rmse")


def user_cf_rmse(spark, sf_dir):
    train, test = inputs.train_and_test(spark, sf_dir)
    return _rounded(evaluate.rmse(_user_predictions(train, test), test), "rmse")


# -- text ----------------------------------------------------------------------------------------


def _counts(spark, sf_dir):
    return text.word_counts(inputs.reviews(spark, sf_dir), STOPWORDS)


def _tfidf(spark, sf_dir):
    return text.tfidf(_counts(spark, sf_dir), inputs.reviews(spark, sf_dir))


def _profiles(spark, sf_dir):
    businesses = materialize(text.business_profiles(_tfidf(spark, sf_dir)))
    return businesses, text.user_profiles(inputs.reviews(spark, sf_dir), businesses)


def review_tokens(spark, sf_dir):
    tokens = text.review_tokens(inputs.reviews(spark, sf_dir), STOPWORDS)
    return tokens.groupBy("business_id").agg(
        F.count(F.lit(1)).alias("n_tokens"), F.sum(F.length("word")).alias("n_letters")
    )


def word_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


def term_frequency(spark, sf_dir):
    return _rounded(text.term_frequency(_counts(spark, sf_dir)), "tf")


def idf(spark, sf_dir):
    return _rounded(text.idf(_counts(spark, sf_dir), inputs.reviews(spark, sf_dir)), "idf")


def tfidf(spark, sf_dir):
    return _tfidf(spark, sf_dir)


def business_profiles(spark, sf_dir):
    return text.business_profiles(_tfidf(spark, sf_dir))


def user_profiles(spark, sf_dir):
    return _profiles(spark, sf_dir)[1]


def content_model_union(spark, sf_dir):
    model = text.content_model(*_profiles(spark, sf_dir))
    return model.select("type", "biz_id", "user_id", F.posexplode("fvec").alias("pos", "word"))


def _scores(spark, sf_dir):
    reviews = inputs.reviews(spark, sf_dir)
    businesses, users = text.split_content_model(materialize(content.train_content_model(reviews, STOPWORDS)))
    return text.content_scores(inputs.content_targets(spark, sf_dir), businesses, users)


def content_scores(spark, sf_dir):
    return _scores(spark, sf_dir)


def content_predict(spark, sf_dir):
    return text.content_predict(_scores(spark, sf_dir))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        entity_sets,
        cooccurrence_pairs,
        jaccard_pairs,
        similar_pairs_exact,
        dedup_ratings,
        distinct_user_ratings,
        user_rating_stats,
        min_support_items,
        supported_ratings,
        pair_moments,
        pearson_pairs,
        similar_pairs_hot,
        cooccurrence_pairs_hot,
        pair_moments_hot,
        encode_ids,
        minhash_signatures,
        lsh_candidates,
        lsh_candidates_banded,
        lsh_stats,
        lsh_candidate_pairs,
        similar_pairs_lsh,
        similar_pairs_lsh_banded,
        lsh_precision_recall,
        user_cf_model_lsh,
        user_cf_model_lsh_banded,
        item_cf_model,
        user_cf_model_exact,
        item_cf_predict,
        user_cf_predict,
        item_cf_predict_ranked,
        user_cf_predict_ranked,
        item_cf_rmse,
        user_cf_rmse,
        review_tokens,
        word_counts,
        term_frequency,
        idf,
        tfidf,
        business_profiles,
        user_profiles,
        content_model_union,
        content_scores,
        content_predict,
    )
}
