"""Collaborative filtering by mode: "item_based" or "user_based"."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators import neighbours

MODES = ("item_based", "user_based")


def _check(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def _with_stars(ratings: DataFrame) -> DataFrame:
    """The ratings; a row without stars, which no model could use, is an error instead of a silent loss."""
    refused = F.raise_error(F.lit("rating without stars")).cast("double")
    return ratings.withColumn("stars", F.when(F.col("stars").isNull(), refused).otherwise(F.col("stars")))


def cf_train(ratings: DataFrame, mode: str, order_cols: Sequence[str] = (), method: str = "exact", **options) -> DataFrame:
    """The similarity model of a mode; the user model by MinHash ("lsh") or in full ("exact")."""
    _check(mode)
    ratings = _with_stars(ratings)
    if mode == "item_based":
        return neighbours.item_cf_model(ratings, order_cols, **options)
    if method not in ("lsh", "exact"):
        raise ValueError(f"method must be 'lsh' or 'exact', not {method!r}")
    build = neighbours.user_cf_model_lsh if method == "lsh" else neighbours.user_cf_model_exact
    return build(ratings, order_cols, **options)


def cf_predict(
    targets: DataFrame, ratings: DataFrame, model: DataFrame, mode: str, order_cols: Sequence[str] = (), **options
) -> DataFrame:
    """(user_id, business_id, stars) for the target rows that have neighbours."""
    _check(mode)
    ratings = _with_stars(ratings)
    if mode == "item_based":
        return neighbours.item_cf_predict(targets, ratings, model, **options)
    return neighbours.user_cf_predict(targets, ratings, model, order_cols, **options)
