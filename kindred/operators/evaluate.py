"""Measures of predictions and of pair sets, as one-row tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rmse(predictions: DataFrame, truth: DataFrame, keys: Sequence[str] = ("user_id", "business_id")) -> DataFrame:
    """(n_truth, n_predicted, rmse) of predicted against true ``stars``, per truth row.

    Both sides are reduced to one row per key before they meet: the sums over the true stars of a
    key are enough for its squared errors.
    """
    keys = list(keys)
    stars = F.col("stars")
    true = truth.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(stars).alias("_s"), F.sum(stars * stars).alias("_ss")
    )
    guess = predictions.groupBy(*keys).agg(F.max("stars").alias("_p"))
    joined = true.join(guess, keys, "left")
    p = F.col("_p")
    errors = F.col("_ss") - 2 * p * F.col("_s") + F.col("_n") * p * p
    hit = p.isNotNull()
    totals = joined.agg(
        F.sum("_n").alias("n_truth"),
        F.coalesce(F.sum(F.when(hit, F.col("_n"))), F.lit(0)).alias("n_predicted"),
        F.sum(F.when(hit, errors)).alias("_errors"),
    )
    return totals.select("n_truth", "n_predicted", F.sqrt(F.try_divide("_errors", "n_predicted")).alias("rmse"))


def precision_recall(found: DataFrame, truth: DataFrame, keys: Sequence[str] = ("b1", "b2")) -> DataFrame:
    """(n_found, n_truth, n_hits, precision, recall) of two sets of pairs."""
    keys = list(keys)
    marked = found.select(*keys, F.lit(1).alias("_f"), F.lit(0).alias("_t")).unionByName(
        truth.select(*keys, F.lit(0).alias("_f"), F.lit(1).alias("_t"))
    )
    flags = marked.groupBy(*keys).agg(F.max("_f").alias("_f"), F.max("_t").alias("_t"))
    totals = flags.agg(
        F.coalesce(F.sum("_f"), F.lit(0)).alias("n_found"),
        F.coalesce(F.sum("_t"), F.lit(0)).alias("n_truth"),
        F.coalesce(F.sum(F.col("_f") * F.col("_t")), F.lit(0)).alias("n_hits"),
    )
    return totals.select(
        "*",
        F.try_divide("n_hits", "n_found").alias("precision"),
        F.try_divide("n_hits", "n_truth").alias("recall"),
    )
