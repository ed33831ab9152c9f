"""Content-based recommendation: word profiles and their overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from kindred.operators import text
from kindred.session import materialize


def train_content_model(
    reviews: DataFrame,
    stopwords: DataFrame | Sequence[str] = (),
    business_words: int = text.BUSINESS_WORDS,
    user_words: int = text.USER_WORDS,
    newline_as_space: bool = False,
) -> DataFrame:
    """(type, biz_id, user_id, fvec) from reviews (user_id, business_id, text)."""
    counts = text.word_counts(reviews, stopwords, newline_as_space=newline_as_space)
    # Read twice below, and short: at most business_words rows per business.
    businesses = materialize(text.business_profiles(text.tfidf(counts, reviews), business_words))
    users = text.user_profiles(reviews, businesses, user_words)
    return text.content_model(businesses, users)


def predict_content(
    pairs: DataFrame, businesses: DataFrame, users: DataFrame, min_sim: float = 0.01
) -> DataFrame:
    """(user_id, business_id, sim) of the test rows scoring at least ``min_sim``."""
    return text.content_predict(text.content_scores(pairs, businesses, users), min_sim)
