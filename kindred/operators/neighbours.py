"""Collaborative filtering: similarity models and predictions from the nearest neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.expressions import jaccard
from kindred.operators.minhash import PRIME, USER_HASHES, hash_family, lsh_pairs, signed, with_shared_bands
from kindred.operators.pairs import HOT_FLOOR, looked_up, overlap_pairs, pair_moments, pearson_pairs, reaches, with_sizes
from kindred.operators.ratings import dedup_ratings, distinct_user_ratings, keep_supported, user_rating_stats
from kindred.operators.skew import CHUNK_ROWS, count_by, ranked, repeat_rows, spread_join
from kindred.session import materialize

ITEM_NEIGHBOURS = 5
USER_NEIGHBOURS = 20
FIRST_RANKS = 1_000  # of a long list of neighbours
# Weighted sums are rounded before they are compared with 0.
SUM_DIGITS = 9


def item_cf_model(
    ratings: DataFrame,
    order_cols: Sequence[str] = (),
    min_ratings: int = 3,
    min_overlap: int = 3,
    hot_floor: int = HOT_FLOOR,
) -> DataFrame:
    """(b1 < b2, sim): positive Pearson of items with enough rows and enough common raters.

    The support filter only prunes: ``min_overlap`` common raters need as many rows. So it is
    skipped unless it asks for more.
    """
    latest = dedup_ratings(ratings, order_cols)
    if min_ratings > min_overlap:
        latest = keep_supported(ratings, latest, min_ratings)
    sims = pearson_pairs(pair_moments(latest, "business_id", "user_id", "stars", min_overlap, hot_floor))
    return sims.filter(F.col("sim") > 0).select(F.col("a").alias("b1"), F.col("b").alias("b2"), "sim")


def _user_pairs(
    ratings: DataFrame, order_cols: Sequence[str], min_overlap: int, min_jaccard: float, hot_floor: int
) -> DataFrame:
    latest = materialize(dedup_ratings(ratings, order_cols))
    moments = pair_moments(latest, "user_id", "business_id", "stars", min_overlap, hot_floor, latest)
    likely = pearson_pairs(moments).filter(F.col("sim") > 0)
    # Set sizes are those of the distinct (user, item) rows.
    sized = with_sizes(likely, latest, "user_id")
    return sized.filter(jaccard(F.col("n"), F.col("size_a"), F.col("size_b")) >= min_jaccard)


def user_cf_model_exact(
    ratings: DataFrame,
    order_cols: Sequence[str] = (),
    min_overlap: int = 3,
    min_jaccard: float = 0.01,
    hot_floor: int = HOT_FLOOR,
) -> DataFrame:
    """(u1 < u2, sim): positive Pearson of all user pairs with enough items in common."""
    pairs = _user_pairs(ratings, order_cols, min_overlap, min_jaccard, hot_floor)
    return pairs.select(F.col("a").alias("u1"), F.col("b").alias("u2"), "sim")


def user_cf_model_lsh(
    ratings: DataFrame,
    order_cols: Sequence[str] = (),
    family: Sequence[tuple[int, int]] | None = None,
    rows_per_band: int = 1,
    prime: int = PRIME,
    bucketed: bool = True,
    min_overlap: int = 3,
    min_jaccard: float = 0.01,
    hot_floor: int = HOT_FLOOR,
    start: str | None = None,
) -> DataFrame:
    """As :func:`user_cf_model_exact`, of users whose item signatures meet in a band.

    The pairs with enough items in common are counted, tested for a shared band and for their Jaccard, and
    only those that are left look their ratings up for the moments. ``start`` is as in
    :func:`~kindred.operators.minhash.similar_pairs_lsh`: from "buckets" the candidates come first.
    """
    if start not in (None, "buckets", "elements"):
        raise ValueError(f"start must be 'buckets' or 'elements', not {start!r}")
    family = hash_family(USER_HASHES, seed=1) if family is None else family
    latest = materialize(dedup_ratings(ratings, order_cols))
    user, item = "user_id", "business_id"
    signatures = materialize(signed(latest.select(user, item), user, item, family, prime, bucketed))
    if start == "buckets" or (start is None and rows_per_band > 1):
        candidates = lsh_pairs(signatures, user, len(family), rows_per_band).select("a", "b")
        likely = with_sizes(candidates, latest, user)
    else:
        shared = overlap_pairs(latest, user, item, None, min_overlap, hot_floor=hot_floor, raw=latest)
        met = with_shared_bands(shared, signatures, user, len(family), rows_per_band)
        sized = with_sizes(met.select("a", "b", F.col("n").alias("_n")), latest, user)
        likely = sized.filter(jaccard(F.col("_n"), F.col("size_a"), F.col("size_b")) >= min_jaccard).drop("_n")
    moments = looked_up(likely, latest, user, item, "stars")
    enough = moments.filter(reaches(F.col("n"), min_overlap, min_jaccard))
    return pearson_pairs(enough).filter(F.col("sim") > 0).select(F.col("a").alias("u1"), F.col("b").alias("u2"), "sim")


def _neighbour_rows(
    targets: DataFrame, known: DataFrame, model: DataFrame, given: str, anchor: str, top_n: int, chunk: int = CHUNK_ROWS
) -> DataFrame:
    """Per target (given, anchor) neighbours of the anchor that ``given`` holds a rating with, the best ``top_n`` among them.

    Item mode: given is the user, anchor the item, and the neighbours are items the user rated.
    User mode: given is the item, anchor the user, and the neighbours are users who rated it.
    A neighbour is in both the ratings of ``given`` and the model rows of ``anchor``. Each target starts from the
    shorter of the two lists, so it costs at most ``chunk`` rows where one of them has no more. Targets with two longer
    lists are joined by rank (:func:`_rank_join`). A list of more than ``chunk`` rows is never read as a whole.
    """
    left, right = [c for c in model.columns if c != "sim"]
    both = model.select(F.col(left).alias(anchor), F.col(right).alias("nbr"), "sim").unionByName(
        model.select(F.col(right).alias(anchor), F.col(left).alias("nbr"), "sim")
    )
    rated = known.withColumnRenamed(anchor, "nbr")
    held, near = count_by(rated, given, name="_held"), count_by(both, anchor, name="_near")
    sized = targets.join(held, given).join(near, anchor)
    short_held, short_near = F.col("_held") <= chunk, F.col("_near") <= chunk
    by_ratings = short_held & (~short_near | (F.col("_held") <= F.col("_near")))
    by_model = short_near & (~short_held | (F.col("_held") > F.col("_near")))
    long_near = near.filter(~short_near)
    if long_near.isEmpty():  # the model is a written table, so this is cheap
        short_lists = both
    else:
        short_lists = both.join(long_near, anchor, "left_anti")

    def take(route: Column) -> DataFrame:
        return sized.filter(route).drop("_held", "_near")

    pair = [anchor, "nbr"]
    few_ratings = rated.join(held.filter(~short_held), given, "left_anti")
    rows = take(by_ratings).join(few_ratings, given).join(both, pair)
    rows = rows.unionByName(take(by_model).join(short_lists, anchor).join(rated, [given, "nbr"]))
    if short_lists is not both:
        both_long = sized.filter(~short_held & ~short_near).drop("_held")
        rows = rows.unionByName(_rank_join(both_long, rated, both.join(long_near, anchor, "left_semi"), given, anchor, top_n, chunk))
    return rows


def _rank_join(
    targets: DataFrame, rated: DataFrame, both: DataFrame, given: str, anchor: str, top_n: int, chunk: int
) -> DataFrame:
    """Neighbour rows of targets (given, anchor, _near, ...) whose two lists are both long.

    The model rows of an anchor are ranked by falling similarity. Round by round each target looks up the next ranks
    among its ratings, four times as many as before, until it has ``top_n`` rows, which no later rank can beat, or its
    list ends. A user with many ratings has rated most of the nearest items, so few ranks do.
    """
    lists = materialize(ranked(both.select(anchor, "nbr", "sim"), [anchor], [F.desc("sim"), F.col("nbr")], "_rank"))
    key, low, high = [given, anchor], 0, min(chunk, FIRST_RANKS)
    left = materialize(targets.withColumn("_found", F.lit(0).cast("long")))
    rounds = []
    while not left.isEmpty():
        ranks = lists.filter((F.col("_rank") > low) & (F.col("_rank") <= high)).drop("_rank")
        found = materialize(left.drop("_near", "_found").join(ranks, anchor).join(rated, [given, "nbr"]))
        rounds.append(found)
        counted = left.join(count_by(found, *key, name="_new"), key, "left")
        total = F.col("_found") + F.coalesce("_new", F.lit(0))
        more = counted.withColumn("_found", total).drop("_new").filter((F.col("_found") < top_n) & (F.col("_near") > high))
        left, low, high = materialize(more), high, high * 4
    if not rounds:
        return targets.drop("_near").join(both, anchor).join(rated, [given, "nbr"]).limit(0)
    out = rounds[0]
    for found in rounds[1:]:
        out = out.unionByName(found)
    return out


def _nearest(rows: DataFrame, given: str, anchor: str, top_n: int) -> DataFrame:
    order = Window.partitionBy(given, anchor).orderBy(F.desc("sim"), "nbr", "stars")
    return rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= top_n)


def _weighted(rows: DataFrame, given: str, anchor: str, term: Column) -> DataFrame:
    return rows.groupBy(given, anchor).agg(
        F.round(F.sum(term * F.col("sim")), SUM_DIGITS).alias("_top"),
        F.round(F.sum(F.abs("sim")), SUM_DIGITS).alias("_weight"),
        F.max("_copies").alias("_copies"),
    )


def _finish(predicted: DataFrame, clip: tuple[float, float] | None) -> DataFrame:
    stars = F.col("stars")
    if clip:
        stars = F.greatest(F.lit(float(clip[0])), F.least(F.lit(float(clip[1])), stars))
    rows = predicted.select("user_id", "business_id", stars.alias("stars"), "_copies").filter(F.col("stars") != 0)
    return repeat_rows(rows, "_copies")


def item_cf_predict(
    targets: DataFrame,
    ratings: DataFrame,
    model: DataFrame,
    top_n: int = ITEM_NEIGHBOURS,
    clip: tuple[float, float] | None = None,
    chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """(user_id, business_id, stars) for the target rows that have a neighbour.

    The similarity-weighted mean of the user's ratings of the ``top_n`` items nearest the target.
    Repeated target rows are predicted once and repeated in the result. ``model`` is read several
    times: pass a saved or materialized one.
    """
    wanted = count_by(targets, "user_id", "business_id", name="_copies")
    rows = _neighbour_rows(wanted, distinct_user_ratings(ratings), model, "user_id", "business_id", top_n, chunk)
    best = _nearest(rows, "user_id", "business_id", top_n)
    sums = _weighted(best, "user_id", "business_id", F.col("stars"))
    usable = sums.filter((F.col("_top") != 0) & (F.col("_weight") != 0))
    return _finish(usable.withColumn("stars", F.try_divide("_top", "_weight")), clip)


def rating_deviations(ratings: DataFrame, order_cols: Sequence[str] = ()) -> DataFrame:
    """(user_id, business_id, stars, deviation) per distinct rating.

    The deviation is from the user's mean over the other raw rows, the last rating of the item left
    out; for a user with a single row, from the mean.
    """
    stats = user_rating_stats(ratings)
    per_item = ratings.groupBy("user_id", "business_id").agg(
        F.max_by("stars", F.struct(*order_cols, "stars")).alias("_own"),
        F.collect_set("stars").alias("_all"),  # one entry per star value
    )
    weights = stats.select("user_id", F.col("n_ratings").alias("n"))
    joined = spread_join(per_item, stats, ["user_id"], weights=weights)
    others = F.try_divide(F.col("sum_stars") - F.col("_own"), F.col("n_ratings") - 1)
    mean = F.when(F.col("n_ratings") > 1, others).otherwise(F.col("mean_stars"))
    rows = joined.select("user_id", "business_id", mean.alias("_mean"), F.explode("_all").alias("stars"))
    return rows.select("user_id", "business_id", "stars", (F.col("stars") - F.col("_mean")).alias("deviation"))


def user_cf_predict(
    targets: DataFrame,
    ratings: DataFrame,
    model: DataFrame,
    order_cols: Sequence[str] = (),
    top_n: int = USER_NEIGHBOURS,
    clip: tuple[float, float] | None = None,
    emit_zero_deviation: bool = False,
    chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """(user_id, business_id, stars): the user's mean plus the neighbours' weighted deviations.

    A target whose deviations sum to 0 has no prediction unless ``emit_zero_deviation``. ``model``
    is read several times: pass a saved or materialized one.
    """
    wanted = count_by(targets, "user_id", "business_id", name="_copies")
    known = rating_deviations(ratings, order_cols)
    rows = _neighbour_rows(wanted, known, model, "business_id", "user_id", top_n, chunk)
    best = _nearest(rows, "business_id", "user_id", top_n)
    sums = _weighted(best, "business_id", "user_id", F.col("deviation"))
    usable = sums.filter(F.col("_weight") != 0)
    if not emit_zero_deviation:
        usable = usable.filter(F.col("_top") != 0)
    means = user_rating_stats(ratings).select("user_id", "mean_stars")
    return _finish(usable.join(means, "user_id").withColumn("stars", F.col("mean_stars") + F.try_divide("_top", "_weight")), clip)
