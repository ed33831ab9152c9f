"""MinHash signatures and locality-sensitive hashing of sets in long form."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kindred.functions.expressions import SIM_DIGITS, jaccard, linear_hash
from kindred.operators.pairs import (
    EPS,
    HOT_FLOOR,
    block_columns,
    count_pairs,
    id_base,
    lists_of,
    looked_up,
    overlap_pairs,
    overlaps_of,
    pairs_to_come,
    reaches,
    similar_pairs,
    sorted_groups,
    with_sizes,
)
from kindred.operators.skew import CHUNK_ROWS, count_by, heavy_hitters, spread_join
from kindred.session import materialize

# The hash primes, the ranges of the hash coefficients a and b (the upper bounds grow
# by COEFFICIENT_STEP with each further hash), and the signature lengths.
PRIME = 10**9 + 7
A_RANGE = (900_000_017, 900_000_040)
B_RANGE = (900_030_697, 1_105_876_108)
COEFFICIENT_STEP = 10_000_000
ITEM_HASHES = 100
USER_HASHES = 70

BLOCK_ROWS = 1_000
BUCKET = ["band", "bucket"]


def hash_family(
    n: int,
    seed: int,
    a_range: tuple[int, int] = A_RANGE,
    b_range: tuple[int, int] = B_RANGE,
    step: int = COEFFICIENT_STEP,
) -> list[tuple[int, int]]:
    """``n`` coefficient pairs (a, b), the same for the same seed."""
    draw = random.Random(seed)
    return [
        (draw.randint(a_range[0], a_range[1] + i * step), draw.randint(b_range[0], b_range[1] + i * step))
        for i in range(n)
    ]


def encode_ids(df: DataFrame, column: str, rows_per_range: int | None = None) -> DataFrame:
    """(column, idx): dense indexes 0..n-1 of the distinct ids, in ascending id order."""
    return dense_ids(df, column, rows_per_range)[0]


def dense_ids(df: DataFrame, column: str, rows_per_range: int | None = None) -> tuple[DataFrame, int]:
    """The indexes of :func:`encode_ids`, and how many there are.

    One range shuffle sorts the distinct ids and is written once with each id's range and place; an index is
    the place shifted by the sizes of the ranges below, of which the driver reads one number a range. Any
    cuts give the same indexes. ``rows_per_range`` asks for that many ids a range in place of the session's
    number of shuffle partitions.
    """
    ids = df.select(column).filter(F.col(column).isNotNull()).distinct()
    if rows_per_range is None:
        ranged = ids.repartitionByRange(column)
    else:
        ranged = ids.repartitionByRange(max(1, math.ceil(ids.count() / rows_per_range)), column)
    # counts from 0 within a partition, whose number is in the bits from 33 up
    placed = materialize(ranged.sortWithinPartitions(column).select(column, F.monotonically_increasing_id().alias("_at")))
    part = F.shiftright("_at", 33).cast("int").alias("part")
    sizes = {r["part"]: r["n"] for r in count_by(placed.select(part), "part").collect()}
    starts = list(itertools.accumulate([0] + [sizes.get(i, 0) for i in range(max(sizes, default=-1))]))
    start = F.element_at(F.array(*[F.lit(x).cast("long") for x in starts]), part + 1)
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(column, (start + place).alias("idx")), sum(sizes.values())


def minhash(
    coded: DataFrame,
    entity: str,
    family: Sequence[tuple[int, int]],
    prime: int = PRIME,
    buckets: int | None = None,
    weights: DataFrame | None = None,
    chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """(entity, signature): per hash the least value over the entity's element indexes ``idx``.

    All hashes of a row are columns of one aggregate, so no row is copied. Rows meet by entity before they
    are aggregated, as an entity spread over many tasks would leave a whole signature in each; one of more
    than ``chunk`` rows is cut into pieces first, whose signatures are combined. ``weights`` is a lazy
    (entity, n) table of the rows of each entity, where there is a cheaper one than by counting them.
    """
    m = None if buckets is None else F.lit(buckets).cast("long")
    kind = "int" if prime < 1 << 31 else "long"
    names = [f"_h{i}" for i in range(len(family))]
    hashes = [linear_hash(F.col("idx"), F.lit(a).cast("long"), F.lit(b).cast("long"), prime, m).cast(kind) for a, b in family]
    large = heavy_hitters(count_by(coded, entity) if weights is None else weights, [entity], chunk)
    pieces = F.broadcast(large.select(entity, F.ceil(F.col("n") / chunk).cast("int").alias("_pieces")))
    piece = F.pmod(F.xxhash64("idx"), F.coalesce("_pieces", F.lit(1))).cast("int")
    # below the prime, so that a product with a coefficient stays within a long for any number of ids
    reduced = (F.col("idx") % F.lit(prime).cast("long")).alias("idx")
    cut = coded.join(pieces, entity, "left").select(entity, piece.alias("_piece"), reduced).repartition(entity, "_piece")
    parts = cut.groupBy(entity, "_piece").agg(*[F.min(h).alias(n) for h, n in zip(hashes, names)])
    whole = parts.groupBy(entity).agg(*[F.min(n).alias(n) for n in names])
    return whole.select(entity, F.array(*names).cast("array<long>").alias("signature"))


def minhash_signatures(
    members: DataFrame,
    entity: str = "business_id",
    element: str = "user_id",
    family: Sequence[tuple[int, int]] | None = None,
    prime: int = PRIME,
    bucketed: bool = True,
) -> DataFrame:
    """Signatures of sets given as distinct (entity, element) rows.

    With ``bucketed`` the hashes are taken modulo (number of elements - 1), at least 1. Without it
    fewer unrelated sets agree by accident. ``members`` are written once, as they are read several times.
    """
    family = hash_family(ITEM_HASHES, seed=1) if family is None else family
    return signed(materialize(members.select(entity, element)), entity, element, family, prime, bucketed)


def signed(
    members: DataFrame, entity: str, element: str, family: Sequence[tuple[int, int]], prime: int = PRIME, bucketed: bool = True
) -> DataFrame:
    """:func:`minhash_signatures` of members that are cheap to read."""
    ids, n = dense_ids(members, element)
    # One narrow row an element; where an element is hot, the runtime splits its partition of members.
    coded = members.join(ids, element).select(entity, "idx")
    return minhash(coded, entity, family, prime, max(n - 1, 1) if bucketed else None, count_by(members, entity))


def bands(signature: Column, length: int, rows_per_band: int = 1) -> Column:
    """Array of bands; each is an array of ``rows_per_band`` consecutive signature values."""
    starts = F.sequence(F.lit(1), F.lit(length), F.lit(rows_per_band))
    return F.transform(starts, lambda i: F.slice(signature, i, F.lit(rows_per_band)))


def lsh_buckets(signatures: DataFrame, entity: str, length: int, rows_per_band: int = 1) -> DataFrame:
    """(band, bucket, entity): one row per entity and band."""
    return signatures.select(
        entity, F.posexplode(bands(F.col("signature"), length, rows_per_band)).alias("band", "bucket")
    ).select("band", "bucket", entity)


def lsh_candidates(signatures: DataFrame, entity: str, length: int, rows_per_band: int = 1) -> DataFrame:
    """Candidate groups (band, bucket, entity, n_members): the members of every shared bucket.

    Two entities are candidates if they stand in one group. The groups say this in one row per
    member; written out as pairs, a bucket with a third of all entities would be quadratic.
    """
    entries = lsh_buckets(signatures, entity, length, rows_per_band)
    counts = count_by(entries, "band", "bucket")
    shared = counts.filter(F.col("n") > 1).select("band", "bucket", F.col("n").alias("n_members"))
    return spread_join(entries, shared, ["band", "bucket"], weights=counts).select(
        "band", "bucket", entity, "n_members"
    )


def lsh_stats(signatures: DataFrame, entity: str, length: int, rows_per_band: int = 1) -> DataFrame:
    """Per band: entities, buckets, single-member buckets, the largest bucket, and candidate pairs.

    Pairs are counted from bucket sizes, without listing any.
    """
    counts = count_by(lsh_buckets(signatures, entity, length, rows_per_band), "band", "bucket")
    n = F.col("n")
    return counts.groupBy("band").agg(
        F.sum(n).alias("n_entities"),
        F.count(F.lit(1)).alias("n_buckets"),
        F.sum((n == 1).cast("long")).alias("n_single"),
        F.max(n).alias("largest_bucket"),
        F.sum((n * (n - 1) / 2).cast("long")).alias("n_pairs"),
    )


def with_shared_bands(
    pairs: DataFrame,
    signatures: DataFrame,
    entity: str,
    length: int,
    rows_per_band: int = 1,
    left: str = "a",
    right: str = "b",
) -> DataFrame:
    """The pairs that are LSH candidates, with ``n_bands``, the number of bands they share."""
    for side, name in ((left, "_sig_a"), (right, "_sig_b")):
        pairs = pairs.join(signatures.select(F.col(entity).alias(side), F.col("signature").alias(name)), side)
    if rows_per_band == 1:
        first, second = F.col("_sig_a"), F.col("_sig_b")
    else:
        first, second = (bands(F.col(c), length, rows_per_band) for c in ("_sig_a", "_sig_b"))
    agree = F.zip_with(first, second, lambda x, y: x == y)
    return (
        pairs.withColumn("n_bands", F.size(F.filter(agree, lambda same: same)))
        .drop("_sig_a", "_sig_b")
        .filter(F.col("n_bands") > 0)
    )


def lsh_pairs(
    signatures: DataFrame, entity: str, length: int, rows_per_band: int = 1, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(a < b, n_bands): every pair of entities that stand in one bucket, once, with the number of bands they share.

    All pairs of a bucket are candidates, and so are written out: bands of one row, in which unrelated entities
    meet often, are better tested on pairs that are known otherwise (:func:`with_shared_bands`).
    """
    base = id_base(signatures, entity)
    groups, n_pairs = bucket_groups(signatures, entity, length, rows_per_band, block_rows, base)
    lists = lists_of(groups, BUCKET, [], True, base=base).drop("_lo", "_hi")
    return count_pairs(lists, [], {"n_bands": F.count(F.lit(1)).cast("int")}, n_pairs, base=base)


def bucket_groups(
    signatures: DataFrame, entity: str, length: int, rows_per_band: int = 1, block_rows: int = BLOCK_ROWS, base: int | None = None
) -> tuple[DataFrame, float]:
    """All buckets as :func:`~kindred.operators.pairs.sorted_groups`, and the number of the entries of their lists.

    A job counts the buckets. They are self-joined in blocks of about ``block_rows`` members, so that one with a
    third of all entities is dealt out over many tasks.
    """
    entries = lsh_buckets(signatures.filter(F.col(entity).isNotNull()), entity, length, rows_per_band).withColumnRenamed(entity, "id")
    if rows_per_band == 1:
        entries = entries.withColumn("bucket", F.get("bucket", F.lit(0)))
    met = Observation()
    counts = count_by(entries, *BUCKET).observe(met, pairs_to_come().alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    large = materialize(counts.filter(F.col("n") > block_rows).withColumnRenamed("n", "_n"))
    rows = entries.join(large, BUCKET, "left").withColumn("_n", F.coalesce("_n", F.lit(1)))
    n_pairs = met.get["n"]
    blocked = block_columns(rows, "_n", block_rows)
    return sorted_groups(blocked, BUCKET, [], True, [], met.get["rows"] + n_pairs, base), n_pairs


def verified(
    candidates: DataFrame, members: DataFrame, entity: str, element: str, min_overlap: int = 1, threshold: float = 0.0
) -> DataFrame:
    """The pairs of ``candidates`` (a, b, ...) with their overlap ``n`` and sizes, that reach both bounds.

    Pairs whose sizes alone rule out the threshold go first.
    """
    sized = with_sizes(candidates, members, entity)
    small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    if threshold > 0:
        sized = sized.filter(small >= F.lit(threshold) * large - EPS)
    return looked_up(sized, members, entity, element).filter(reaches(F.col("n"), min_overlap, threshold))


def lsh_candidate_pairs(
    members: DataFrame,
    entity: str = "business_id",
    element: str = "user_id",
    min_overlap: int = 1,
    family: Sequence[tuple[int, int]] | None = None,
    rows_per_band: int = 1,
    prime: int = PRIME,
    bucketed: bool = True,
    hot_floor: int = HOT_FLOOR,
) -> DataFrame:
    """(b1 < b2, n, n_bands) of the LSH candidates that share ``n`` elements, at least ``min_overlap``.

    With ``min_overlap`` of 0 these are all candidates, from their buckets; those that share no element meet by
    accident of the hashes. With 1 or more the pairs that share so many elements come first.
    """
    family = hash_family(ITEM_HASHES, seed=1) if family is None else family
    members = materialize(members.select(entity, element))
    signatures = signed(members, entity, element, family, prime, bucketed)
    if min_overlap > 0:
        shared = overlap_pairs(members, entity, element, min_overlap=min_overlap, hot_floor=hot_floor, raw=members)
        met = with_shared_bands(shared, materialize(signatures), entity, len(family), rows_per_band)
    else:
        base = id_base(members, entity)
        groups, n_pairs = bucket_groups(materialize(signatures), entity, len(family), rows_per_band, base=base)
        met = overlaps_of(groups, BUCKET, n_pairs, members, entity, element, hot_floor, base)
        met = met.withColumn("n_bands", F.col("n_met").cast("int"))
    return met.select(F.col("a").alias("b1"), F.col("b").alias("b2"), "n", "n_bands")


def similar_pairs_lsh(
    members: DataFrame,
    entity: str = "business_id",
    element: str = "user_id",
    threshold: float = 0.05,
    family: Sequence[tuple[int, int]] | None = None,
    rows_per_band: int = 1,
    prime: int = PRIME,
    bucketed: bool = True,
    hot_floor: int = HOT_FLOOR,
    raw: DataFrame | None = None,
    start: str | None = None,
    counts: Observation | None = None,
) -> DataFrame:
    """(b1 < b2, sim) of LSH candidates with Jaccard of at least ``threshold``.

    ``start`` says what comes first: "buckets", whose pairs are then verified, or "elements", whose pairs reach
    the threshold and are then tested for a shared band. The result is the same. By default bands of several rows
    start from buckets. With bands of one row more pairs meet in some bucket by accident than share an element
    at all, so these start from elements. ``raw`` is read for hot elements only, and may be left out.
    ``counts`` observes n_candidates, the pairs that come first, in the run that gives the result.
    """
    if start not in (None, "buckets", "elements"):
        raise ValueError(f"start must be 'buckets' or 'elements', not {start!r}")
    family = hash_family(ITEM_HASHES, seed=1) if family is None else family
    members = materialize(members.select(entity, element))
    signatures = signed(members, entity, element, family, prime, bucketed)
    if start == "buckets" or (start is None and rows_per_band > 1):
        candidates = lsh_pairs(materialize(signatures), entity, len(family), rows_per_band).select("a", "b")
        if counts is not None:
            candidates = candidates.observe(counts, F.count(F.lit(1)).alias("n_candidates"))
        found = verified(candidates, members, entity, element, threshold=threshold)
        sim = F.round(jaccard(F.col("n"), F.col("size_a"), F.col("size_b")), SIM_DIGITS)
        return found.select(F.col("a").alias("b1"), F.col("b").alias("b2"), sim.alias("sim"))
    pairs = similar_pairs(members, entity, element, threshold, hot_floor, members)
    if counts is not None:
        pairs = pairs.observe(counts, F.count(F.lit(1)).alias("n_candidates"))
    met = with_shared_bands(pairs, signatures, entity, len(family), rows_per_band, "b1", "b2")
    return met.select("b1", "b2", "sim")
