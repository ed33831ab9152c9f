"""Words of reviews: counts, TF-IDF, profiles and profile overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.expressions import SIM_DIGITS, set_cosine, words
from kindred.operators.minhash import dense_ids
from kindred.operators.skew import count_by, repeat_rows, spread_join

BUSINESS_WORDS = 200
USER_WORDS = 500


def _without_stopwords(df: DataFrame, stopwords: DataFrame | Sequence[str]) -> DataFrame:
    if isinstance(stopwords, DataFrame):
        return df.join(stopwords.select("word").distinct(), "word", "left_anti")
    return df.filter(~F.col("word").isin(list(stopwords))) if stopwords else df


def review_tokens(
    reviews: DataFrame,
    stopwords: DataFrame | Sequence[str] = (),
    business: str = "business_id",
    text: str = "text",
    newline_as_space: bool = False,
) -> DataFrame:
    """(business, word), one row per occurrence, stopwords left out.

    Each review is split by itself; a blank would stand between the reviews of a business, so no
    word crosses from one to the next and the texts need not be joined up.
    """
    tokens = reviews.select(business, F.explode(words(F.col(text), newline_as_space)).alias("word"))
    return _without_stopwords(tokens, stopwords).select(business, "word")


def word_counts(
    reviews: DataFrame,
    stopwords: DataFrame | Sequence[str] = (),
    business: str = "business_id",
    text: str = "text",
    newline_as_space: bool = False,
) -> DataFrame:
    """(business, word, n). Stopwords are dropped after counting, from far fewer rows."""
    counts = count_by(review_tokens(reviews, (), business, text, newline_as_space), business, "word")
    return _without_stopwords(counts, stopwords).select(business, "word", "n")


def term_frequency(counts: DataFrame, business: str = "business_id") -> DataFrame:
    """(business, word, tf): the count over the greatest count of the business."""
    tops = counts.groupBy(business).agg(F.max("n").alias("_top"), F.count(F.lit(1)).alias("_words"))
    weights = tops.select(business, F.col("_words").alias("n"))
    return spread_join(counts, tops.drop("_words"), [business], weights=weights).select(
        business, "word", (F.col("n") / F.col("_top")).alias("tf")
    )


def idf(counts: DataFrame, reviews: DataFrame, business: str = "business_id") -> DataFrame:
    """(word, df, idf): log2(businesses / businesses holding the word).

    Businesses whose reviews hold no word count as well.
    """
    total = reviews.select(F.countDistinct(business)).scalar()
    held = count_by(counts, "word", name="df")
    return held.select("word", "df", F.log2(total / F.col("df")).alias("idf"))


def tfidf(counts: DataFrame, reviews: DataFrame, business: str = "business_id") -> DataFrame:
    """(business, word, tfidf), rounded so that ranks do not hang on the last bit."""
    weighted = idf(counts, reviews, business)
    joined = spread_join(
        term_frequency(counts, business),
        weighted.select("word", "idf"),
        ["word"],
        weights=weighted.select("word", F.col("df").alias("n")),
    )
    return joined.select(business, "word", F.round(F.col("tf") * F.col("idf"), SIM_DIGITS).alias("tfidf"))


def _top_words(scored: DataFrame, key: str, k: int) -> DataFrame:
    best = Window.partitionBy(key).orderBy(F.desc("tfidf"), "word")
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def business_profiles(scored: DataFrame, k: int = BUSINESS_WORDS, business: str = "business_id") -> DataFrame:
    """(business, word, tfidf, rank): the ``k`` best words; equal scores by word."""
    return _top_words(scored, business, k).select(business, "word", "tfidf", "rank")


def user_profiles(
    reviews: DataFrame,
    profiles: DataFrame,
    k: int = USER_WORDS,
    user: str = "user_id",
    business: str = "business_id",
) -> DataFrame:
    """(user, word, tfidf, rank): the words of all reviewed businesses, the ``k`` best of them.

    A word's score is its best over the user's businesses. A business profile is short, so it
    travels as one array.
    """
    visits = reviews.select(user, business).distinct()
    packed = profiles.groupBy(business).agg(F.collect_list(F.struct("word", "tfidf")).alias("_words"))
    unioned = (
        spread_join(visits, packed, [business], weights=count_by(visits, business))
        .select(user, F.inline("_words"))
        .groupBy(user, "word")
        .agg(F.max("tfidf").alias("tfidf"))
    )
    return _top_words(unioned, user, k).select(user, "word", "tfidf", "rank")


def profile_vectors(profiles: DataFrame, key: str) -> DataFrame:
    """(key, fvec): the words of a profile as one array in rank order, at most k long."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", "word")))
    return profiles.groupBy(key).agg(ranked.alias("_ranked")).select(
        key, F.transform("_ranked", lambda w: w["word"]).alias("fvec")
    )


def content_model(
    businesses: DataFrame, users: DataFrame, user: str = "user_id", business: str = "business_id"
) -> DataFrame:
    """(type, biz_id, user_id, fvec): both kinds of profile in one table."""
    biz = profile_vectors(businesses, business).select(F.lit("biz").alias("type"), F.col(business).alias("biz_id"), "fvec")
    usr = profile_vectors(users, user).select(F.lit("user").alias("type"), F.col(user).alias("user_id"), "fvec")
    return biz.unionByName(usr, allowMissingColumns=True).select("type", "biz_id", "user_id", "fvec")


def split_content_model(
    model: DataFrame, user: str = "user_id", business: str = "business_id"
) -> tuple[DataFrame, DataFrame]:
    """The business vectors and the user vectors of a content model."""
    kind = F.col("type")
    return (
        model.filter(kind == "biz").select(F.col("biz_id").alias(business), "fvec"),
        model.filter(kind == "user").select(F.col("user_id").alias(user), "fvec"),
    )


def content_scores(
    pairs: DataFrame,
    businesses: DataFrame,
    users: DataFrame,
    user: str = "user_id",
    business: str = "business_id",
) -> DataFrame:
    """(user, business, sim) per test row; 0 where either profile is missing or empty.

    ``businesses`` and ``users`` are profile vectors. A repeated test row is scored once. Words are numbered by
    those of the businesses first, so a test row carries numbers from one join to the next, the shorter vector
    first; a user's other words count for its size only. A hot key's rows are split by the runtime.
    """
    targets = count_by(pairs, user, business, name="_copies")
    words = businesses.select(F.explode("fvec").alias("word"))
    numbers = dense_ids(words, "word")[0].select("word", F.col("idx").cast("int").alias("_word"))
    biz = _numbered(businesses, business, numbers, "_biz")
    usr = _numbered(users, user, numbers, "_usr")
    joined = targets.join(biz, business, "left").join(usr, user, "left")
    shared = F.size(F.array_intersect("_usr.words", "_biz.words"))
    sim = set_cosine(shared, F.col("_usr.size"), F.col("_biz.size"))
    scored = joined.select(user, business, F.round(sim, SIM_DIGITS).alias("sim"), "_copies")
    return repeat_rows(scored, "_copies")


def _numbered(vectors: DataFrame, key: str, numbers: DataFrame, name: str) -> DataFrame:
    """(key, name): the size of each vector and the numbers of its words."""
    words = vectors.select(key, F.explode("fvec").alias("word")).join(numbers, "word")
    held = words.groupBy(key).agg(F.collect_list("_word").alias("_words"))
    none = F.array().cast("array<int>")
    return vectors.select(key, F.size("fvec").alias("_size")).join(held, key, "left").select(
        key, F.struct(F.col("_size").alias("size"), F.coalesce("_words", none).alias("words")).alias(name)
    )


def content_predict(scores: DataFrame, min_sim: float = 0.01) -> DataFrame:
    return scores.filter(F.col("sim") >= min_sim)
