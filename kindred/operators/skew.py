"""Joins and lookups that stay balanced when one key holds a large share of all rows.

The building block is a *heavy hitter* table: the ``limit`` most frequent keys above a floor. Its
size is bounded by construction, so it may be broadcast; and every key left out of it holds at most
``max(floor, rows / (limit + 1))`` rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from kindred.session import materialize

HOT_KEYS = 512  # kept as bits, 64 to a long
JOIN_KEYS = 10_000
CHUNK_ROWS = 100_000
PART_ROWS = 1_000_000


def heavy_hitters(counts: DataFrame, keys: Sequence[str], floor: int, limit: int = JOIN_KEYS) -> DataFrame:
    """The ``limit`` largest groups of a (keys, n) count table that have more than ``floor`` rows.

    The order is total (count, then key), so every evaluation picks the same groups.
    """
    return (
        counts.select(*keys, "n")
        .filter(F.col("n") > floor)
        .orderBy(F.desc("n"), *keys)
        .limit(limit)
    )


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def hot_keys(df: DataFrame, keys: Sequence[str], chunk: int = CHUNK_ROWS, limit: int = JOIN_KEYS) -> list[Row]:
    """The heavy hitters of ``df``, found by a job of its own; for inputs that are cheap to read."""
    return heavy_hitters(count_by(df, *keys), keys, chunk, limit).collect()


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    weights: DataFrame | None = None,
    hot: list[Row] | None = None,
    chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Equi-join of a skewed ``left`` (distinct rows) with a ``right`` of few rows per key.

    Keys with more than ``chunk`` rows on the left are cut into pieces by a hash of the whole row,
    and only their right rows are copied, once per piece. Which keys these are is told by
    ``weights``, a lazy (keys, n) table of left row counts, or by ``hot``, a result of
    :func:`hot_keys`. Without any hot key this is a plain join.
    """
    on = list(on)
    if weights is not None:
        largest = heavy_hitters(weights, on, chunk)
    elif hot:
        largest = left.sparkSession.createDataFrame(hot, left.select(*on, F.lit(0).cast("long").alias("n")).schema)
    else:
        return left.join(right, on, how)
    pieces_by_key = F.broadcast(largest.select(*on, F.ceil(F.col("n") / chunk).cast("int").alias("_pieces")))
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    left_salted = (
        left.join(pieces_by_key, on, "left")
        .withColumn("_piece", F.pmod(F.xxhash64(*left.columns), pieces).cast("int"))
        .drop("_pieces")
    )
    right_salted = (
        right.join(pieces_by_key, on, "left")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .drop("_pieces")
    )
    return left_salted.join(right_salted, [*on, "_piece"], how).drop("_piece")


def even_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Equi-join of a ``left`` that is cheap to count, in parts of about ``PART_ROWS`` of its rows; few of them share a key.

    The runtime joins parts until they hold 64 MB, some 5 million narrow rows, and has no more of them than the session's
    shuffle partitions, however long the input. With fewer rows than ``PART_ROWS`` a core it is left alone, as it makes
    a part a core then, or copies a small side.
    """
    rows = left.count()
    if rows > PART_ROWS * left.sparkSession.sparkContext.defaultParallelism:
        n_parts = math.ceil(rows / PART_ROWS)
        left, right = left.repartition(n_parts, on), right.repartition(n_parts, on)
    return left.join(right, on)


def salted_join(left: DataFrame, right: DataFrame, on: str, salt_by: str, how: str = "left", pieces: int = 32) -> DataFrame:
    """Equi-join where every key is cut into the same number of pieces.

    For a left side too costly to count first; ``right`` has one narrow row per key.
    """
    left_salted = left.withColumn("_piece", F.pmod(F.xxhash64(salt_by), F.lit(pieces)).cast("int"))
    right_salted = right.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    return left_salted.join(right_salted, [on, "_piece"], how).drop("_piece")


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``df`` with the place (from 1) of each row among those of its keys, without bringing a key to one task.

    The rows are sorted into value ranges of (keys, order) and written once with their range. A place is that within
    the range, plus what the ranges before hold of the key: a few rows a key are summed up for that.
    """
    placed = materialize(df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()))
    here = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = count_by(placed, *keys, "_part").select(*keys, "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_ahead"))
    numbered = placed.withColumn("_here", here).join(counts, [*keys, "_part"])
    return numbered.withColumn(name, F.col("_here") + F.col("_ahead")).drop("_part", "_here", "_ahead")


def repeat_rows(df: DataFrame, copies: str, step: int = 10_000) -> DataFrame:
    """Emit each row ``copies`` times; two nested sequences keep the helper arrays short."""
    outer = F.sequence(F.lit(0), F.floor((F.col(copies) - 1) / step))
    inner = F.sequence(F.lit(1), F.least(F.lit(step), F.col(copies) - F.col("_outer") * step))
    return (
        df.withColumn("_outer", F.explode(outer))
        .withColumn("_inner", F.explode(inner))
        .drop("_outer", "_inner", copies)
    )


def spread_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Shuffle an input of fewer splits than cores, such as one small file; else leave it alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(4 * cores, *keys) if df.rdd.getNumPartitions() < cores else df
