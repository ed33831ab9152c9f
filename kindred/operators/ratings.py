"""Aggregations over raw rating rows (user, item, stars)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.skew import count_by, spread_join


def dedup_ratings(
    ratings: DataFrame,
    order_cols: Sequence[str] = (),
    user: str = "user_id",
    item: str = "business_id",
    stars: str = "stars",
) -> DataFrame:
    """One rating per (user, item): the last by ``order_cols``, the greatest stars last of all."""
    order = F.struct(*order_cols, stars)
    return ratings.groupBy(user, item).agg(F.max_by(stars, order).alias(stars))


def distinct_user_ratings(
    ratings: DataFrame, user: str = "user_id", item: str = "business_id", stars: str = "stars"
) -> DataFrame:
    """Distinct (user, item, stars): two different stars for one item stay two rows."""
    return ratings.select(user, item, stars).distinct()


def user_rating_stats(ratings: DataFrame, user: str = "user_id", stars: str = "stars") -> DataFrame:
    """Sum, count and mean over the raw rows of each user, repeats included."""
    return ratings.groupBy(user).agg(
        F.sum(stars).alias("sum_stars"), F.count(stars).alias("n_ratings"), F.avg(stars).alias("mean_stars")
    )


def entity_members(ratings: DataFrame, entity: str = "business_id", element: str = "user_id") -> DataFrame:
    """The element set of each entity, as distinct (entity, element) rows.

    The sets stay in long form: an entity rated by a third of all users never becomes one array.
    """
    return ratings.select(entity, element).distinct()


def min_support_items(ratings: DataFrame, min_ratings: int = 3, item: str = "business_id") -> DataFrame:
    """Items with at least ``min_ratings`` raw rows (repeats count)."""
    return count_by(ratings, item, name="n_ratings").filter(F.col("n_ratings") >= min_ratings)


def keep_supported(
    ratings: DataFrame, rows: DataFrame, min_ratings: int = 3, item: str = "business_id"
) -> DataFrame:
    """``rows`` whose item has at least ``min_ratings`` rows in ``ratings``."""
    counts = count_by(ratings, item)
    supported = counts.filter(F.col("n") >= min_ratings).select(item)
    return spread_join(rows, supported, [item], weights=counts)
