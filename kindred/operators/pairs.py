"""Exact pairs of entities by the elements they share.

Input is the long form of sets: one row per (entity, element), optionally with a number such as
stars. A pair is found through the elements it shares, never by comparing all entities:

* *Light* elements are self-joined and counted per pair. A row meets all others of its element as one list,
  and these lists, not pairs, are shuffled: they go to the first entity of their pairs, into as many parts as the
  pairs need (``PART_PAIRS``), and become pairs there, where they are counted. The lists carry the numbers, so no
  second look at the sets is needed. One in d sets costs about d * d / 2 entries; d is bounded by ``hot_floor``
  only while at most ``HOT_KEYS`` elements exceed that.
* *Hot* elements (at most ``HOT_KEYS`` = 512, the most frequent ones above ``hot_floor``) are never
  self-joined by themselves. Every entity holds them as a bit mask of as many longs as they need, whose
  overlap is added to the pairs found through light elements that can still qualify. A pair that qualifies by hot elements
  alone is found by a prefix filter: classes of equal masks are matched by the rarest hot element they
  share, which stands among the first ``held - needed + 1`` of both, and only pairs that do reach the
  thresholds are written out, each exactly once.

The result is complete for any skew: nothing is dropped, capped or sampled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from kindred.functions.expressions import SIM_DIGITS, jaccard, pearson
from kindred.operators.skew import CHUNK_ROWS, HOT_KEYS, count_by, heavy_hitters, spread_join
from kindred.session import materialize

HOT_FLOOR = 5_000
PART_PAIRS = 2_000_000  # of one part, where they are counted
LIST_PAIRS = 8_000_000  # of one part, where the lists are made; fewer and longer blocks are shuffled than with PART_PAIRS
ROUND_PAIRS = 3_000_000_000  # of one round, whose lists are on disk at one time
MIN_PAIRS = 50_000  # of one part, where there are fewer parts than cores
SLACK = 1e-9  # of the rounding of a product
EPS = 1e-12


def block_columns(rows: DataFrame, n: str, block_rows: int) -> DataFrame:
    """Cut each group into blocks of about ``block_rows`` and place a row in every block pair."""
    blocks = F.greatest(F.ceil(F.col(n) / block_rows).cast("int"), F.lit(1))
    return (
        rows.withColumn("_blocks", blocks)
        .withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("_lo", F.least("_own", "_other"))
        .withColumn("_hi", F.greatest("_own", "_other"))
        .drop(n, "_blocks", "_other")
    )


def _n_parts(df: DataFrame, entries: float, of_one: int) -> int:
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(entries / of_one), min(cores, math.ceil(entries / MIN_PAIRS)))


def group_lists(
    rows: DataFrame,
    keys: list[str],
    carried: list[str],
    blocked: bool,
    keep: Callable[[Column], Column] | None = None,
    own: Sequence[str] = (),
    entries: float | None = None,
    base: int | None = None,
) -> DataFrame:
    """Of the pairs a < b of the rows with equal keys one row per a, with ``bs``, the list of b.

    The carried columns stand beside: those of a with the end ``_a``, those of b in lists with the end ``_bs``. The
    columns ``own`` are given for a only. ``keep`` tests the size of b against a; it holds for an interval of sizes. The
    rows are sorted once, and the list of a is what stands behind it (rows of a itself too, if it repeats). If
    ``blocked``, these are the rows of two blocks (:func:`block_columns`), else all rows of the keys.

    A group of rows grows to its square here. So the rows are dealt into parts of about ``LIST_PAIRS`` of the ``entries``,
    the rows and the pairs to come; the runtime, which goes by the size of the rows, would take too few.

    With a ``base`` (:func:`id_base`) an id b takes three bytes in place of eight, as ``low_bs`` and ``high_bs``.
    """
    groups = sorted_groups(rows, keys, carried, blocked, own, entries, base)
    return lists_of(groups, keys, carried, blocked, keep, own, base)


def sorted_groups(
    rows: DataFrame, keys: list[str], carried: list[str], blocked: bool, own: Sequence[str], entries: float | None, base: int | None
) -> DataFrame:
    """The groups of :func:`group_lists`, of two rows or more, with their rows sorted by id as ``_rows``."""
    shared, block = (["_lo", "_hi"], ["_own"]) if blocked else ([], [])
    entry = F.struct(*(["id"] if base is None else _halves(F.col("id"), base)), *carried, *own, *block)
    rows = rows.filter(F.col("id").isNotNull())
    if entries is not None:
        rows = rows.repartition(_n_parts(rows, entries, LIST_PAIRS), *keys, *shared)
    lists = rows.groupBy(*keys, *shared).agg(F.sort_array(F.collect_list(entry)).alias("_rows"))
    return lists.filter(F.size("_rows") > 1)


def lists_of(
    lists: DataFrame,
    keys: list[str],
    carried: list[str],
    blocked: bool,
    keep: Callable[[Column], Column] | None = None,
    own: Sequence[str] = (),
    base: int | None = None,
    dealt: tuple[int, int] | None = None,
) -> DataFrame:
    """The lists of :func:`group_lists` from its groups; with ``dealt`` (i, n) those of the i-th of n shares of the first entities."""
    block = ["_own"] if blocked else []
    arrays = ({"id": "bs"} if base is None else {"_high": "high_bs", "_low": "low_bs"}) | {c: f"{c}_bs" for c in carried}
    row = F.col("_row")
    whole, tests = [], []  # what holds for all rows of a list, and for one row b
    if keep is not None:
        sizes = F.col("_rows")["size"]
        lists = lists.withColumn("_least", F.array_min(sizes)).withColumn("_most", F.array_max(sizes))
        whole.append(keep(F.col("_least")) & keep(F.col("_most")))
        tests.append(lambda b: keep(b["size"]))
    if blocked:
        whole.append(F.col("_lo") == F.col("_hi"))
        tests.append(lambda b: (F.col("_lo") == F.col("_hi")) | (b["_own"] != F.col("_own_a")))
    bounds = [c for c in lists.columns if c not in keys]
    met = lists.select(*bounds, *[F.col("_rows")[c].alias(n) for c, n in arrays.items()], F.posexplode("_rows").alias("_at", "_row"))
    first = row["id"] if base is None else _whole(row["_low"], row["_high"], base)
    firsts = {"a": first} | {f"{c}_a": row[c] for c in [*carried, *own, *block]}
    met = met.withColumns(firsts).filter(F.size("_rows") > F.col("_at") + 1)
    if dealt is not None:
        met = met.filter(F.pmod(F.xxhash64("a"), F.lit(dealt[1])) == dealt[0])

    def behind(rows: str) -> Column:
        return F.slice(rows, F.col("_at") + 2, F.size("_rows"))

    out = {n: behind(n) for n in arrays.values()}
    if tests:
        kept = F.filter(behind("_rows"), lambda b: reduce(and_, [t(b) for t in tests]))
        out = {n: F.when(reduce(and_, whole), out[n]).otherwise(kept[c]) for c, n in arrays.items()}
    met = met.select(*[c for c in firsts if c != "_own_a"], *[e.alias(n) for n, e in out.items()])
    return met.filter(F.size(next(iter(out))) > 0) if tests else met


def id_base(ids: DataFrame, column: str) -> int | None:
    """The least of the ids, if they are longs within 2^24 of it; a job reads them."""
    if ids.schema[column].dataType != LongType():
        return None
    least, most = ids.agg(F.min(column), F.max(column)).first()
    return least if least is not None and most - least < 1 << 24 else None


def _halves(number: Column, base: int) -> list[Column]:
    """A number from ``base`` on as the bits above 16 and those below, less what makes them a tinyint and a smallint; in its order."""
    above = number.cast("long") - F.lit(base).cast("long")
    low = above.bitwiseAND(F.lit(0xFFFF).cast("long")) - (1 << 15)
    return [(F.shiftright(above, 16) - (1 << 7)).cast("tinyint").alias("_high"), low.cast("smallint").alias("_low")]


def _whole(low: Column, high: Column, base: int) -> Column:
    return (high.cast("long") + (1 << 7)) * (1 << 16) + low.cast("long") + F.lit(base + (1 << 15)).cast("long")


def pairs_to_come() -> Column:
    """The number of pairs in groups of ``n`` rows each, as an aggregate."""
    n = F.col("n").cast("double")
    return F.coalesce(F.sum(n * (n - 1) / 2), F.lit(0.0))


def count_pairs(
    lists: DataFrame,
    keys: list[str],
    measures: dict[str, Column],
    n_pairs: float,
    heavy: DataFrame | None = None,
    base: int | None = None,
) -> DataFrame:
    """The ``measures`` of each pair (a, b), over all of the lists of :func:`group_lists` in which it stands.

    The lists are dealt by a, into parts of about ``PART_PAIRS`` of the ``n_pairs`` entries, and are not pairs before.
    ``keys`` are columns beside a that depend on it. The lists of an entity in ``heavy`` (a, n), which is of bounded
    size, are cut into entries and dealt by b too. ``base`` is that of the lists.
    """
    arrays = [c for c in lists.columns if c.endswith("bs")]
    others = [c for c in lists.columns if c not in arrays]
    by = ["a"]
    if heavy is not None:
        pieces = F.broadcast(heavy.select("a", F.ceil(F.col("n") / CHUNK_ROWS).cast("int").alias("_pieces")))
        entry = F.transform(F.arrays_zip(*arrays), lambda x: F.struct(*[F.array(x[c]).alias(c) for c in arrays]))
        parts = F.when(F.col("_pieces").isNull(), F.array(F.struct(*arrays))).otherwise(entry)
        lists = lists.join(pieces, "a", "left").select(*others, "_pieces", F.explode(parts).alias("_part"))
        lists = lists.select(*others, "_pieces", *[F.col("_part")[c].alias(c) for c in arrays])
        first = [F.get(c, F.lit(0)) for c in (["bs"] if base is None else ["low_bs", "high_bs"])]
        piece = F.pmod(F.xxhash64(*first), F.col("_pieces")).cast("int")
        lists = lists.select(*others, *arrays, F.coalesce(piece, F.lit(0)).alias("_piece"))
        by, others = ["a", "_piece"], [*others, "_piece"]
    met = lists.repartition(_n_parts(lists, n_pairs, PART_PAIRS), *by).select(*others, F.inline(F.arrays_zip(*arrays)))
    b = F.col("bs") if base is None else _whole(F.col("low_bs"), F.col("high_bs"), base)
    met = met.withColumn("b", b).drop("bs", "low_bs", "high_bs")
    return met.filter(F.col("a") < F.col("b")).groupBy(*by, *keys, "b").agg(*[e.alias(c) for c, e in measures.items()]).drop("_piece")


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v - 2**64 if v >= 2**63 else v).cast("long") for v in values])


# Of a place in a long: its bit, and all places before it.
_BIT = [1 << i for i in range(64)]
_BEFORE = [(1 << i) - 1 for i in range(64)]


def _masks(n_hot: int) -> list[str]:
    return [f"mask{w}" for w in range(-(-n_hot // 64))]


def _set_places(mask: Column) -> Column:
    """The places of the bits of a long, ascending."""
    return F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit(mask, i) == 1)


def reaches(overlap: Column, min_overlap: int, min_jaccard: float) -> Column:
    enough = overlap >= min_overlap
    if min_jaccard > 0:
        enough = enough & (jaccard(overlap, F.col("size_a"), F.col("size_b")) >= min_jaccard)
    return enough


class _Sets(NamedTuple):
    """The rows (id, via, ...) of sets, and what is to be known of them beforehand."""

    members: DataFrame
    hot: list  # from rare to frequent
    vias: DataFrame | None  # (via, n) of the light elements that are cut into blocks
    n_rows: int
    n_pairs: float  # met at the light elements
    heavy: DataFrame | None  # (a, n) of the entities with more than CHUNK_ROWS rows
    sizes: DataFrame  # (id, size)
    narrow: dict[str, str]  # the types that hold all ids and values, where they are shorter than their own
    base: int | None  # of the ids, where they travel in three bytes


def _counted_sets(rows: DataFrame, entity: str, element: str, value: str | None, hot_floor: int, raw: DataFrame | None) -> _Sets:
    def sets(df: DataFrame) -> DataFrame:
        numbers = [F.col(value).cast("double").alias("v")] if value and df is rows else []
        return df.select(F.col(entity).alias("id"), F.col(element).alias("via"), *numbers)

    members = sets(rows)
    if raw is None:
        members = materialize(members)
    counted = (members if raw is None or raw is rows else sets(raw)).select("id", "via")
    degrees = materialize(counted.groupingSets([["id"], ["via"]], "id", "via").agg(F.grouping("id").alias("_by_via"), F.count(F.lit(1)).alias("n")))
    vias = degrees.filter((F.col("_by_via") == 1) & F.col("via").isNotNull()).select("via", "n")
    ids = degrees.filter(F.col("_by_via") == 0).select("id", "n")
    largest = heavy_hitters(vias, ["via"], hot_floor, limit=HOT_KEYS + 1).collect()
    hot = largest[:HOT_KEYS]
    n_rows, n_pairs = vias.agg(F.coalesce(F.sum("n"), F.lit(0)), pairs_to_come()).first()
    narrow = {}
    if ids.schema["id"].dataType == LongType() and ids.agg(_all(F.col("id").between(-(1 << 31), (1 << 31) - 1))).first()[0]:
        narrow["id"] = "int"
    base = id_base(ids, "id")
    if "v" in members.columns and (raw is None or raw is rows):
        if members.agg(_all((F.rint("v") == F.col("v")) & F.col("v").between(-128, 127))).first()[0]:
            narrow["v"] = "tinyint"
    n_pairs -= sum(r["n"] * (r["n"] - 1) / 2 for r in hot)
    heavy = heavy_hitters(ids.withColumnRenamed("id", "a"), ["a"], CHUNK_ROWS)
    return _Sets(
        members,
        [r["via"] for r in reversed(hot)],
        vias.filter(F.col("n") > hot_floor) if len(largest) > HOT_KEYS else None,
        n_rows,
        n_pairs,
        None if heavy.isEmpty() else heavy,
        ids.withColumnRenamed("n", "size") if raw is None or raw is rows else count_by(members, "id", name="size"),
        narrow,
        base,
    )


def _all(test: Column) -> Column:
    """Whether ``test`` holds for all rows in which it is not null, as an aggregate."""
    return F.coalesce(F.min(test), F.lit(True))


def _light_lists(
    sets: _Sets, members: DataFrame, carried: list[str], hot_floor: int, keep: Callable[[Column], Column] | None = None, own: Sequence[str] = ()
) -> DataFrame:
    groups = _light_groups(sets, members, carried, hot_floor, own)
    return lists_of(groups, ["via"], carried, sets.vias is not None, keep, own, sets.base)


def _light_groups(sets: _Sets, members: DataFrame, carried: list[str], hot_floor: int, own: Sequence[str] = ()) -> DataFrame:
    light = members.filter(F.col("via").isNotNull())
    if sets.hot:
        light = light.filter(~F.col("via").isin(sets.hot))
    if sets.vias is not None:
        counted = light.join(sets.vias.withColumnRenamed("n", "_n"), "via", "left").withColumn("_n", F.coalesce("_n", F.lit(1)))
        light = block_columns(counted, "_n", hot_floor)
    return sorted_groups(light, ["via"], carried, sets.vias is not None, own, sets.n_rows + sets.n_pairs, sets.base)


def overlap_pairs(
    rows: DataFrame,
    entity: str,
    element: str,
    value: str | None = None,
    min_overlap: int = 1,
    min_jaccard: float = 0.0,
    hot_floor: int = HOT_FLOOR,
    raw: DataFrame | None = None,
) -> DataFrame:
    """Pairs (a < b) sharing at least ``min_overlap`` elements and with Jaccard >= ``min_jaccard``.

    ``rows`` holds each (entity, element) once. Output: a, b, n (shared elements); size_a and
    size_b if ``min_jaccard`` is positive; with ``value`` also the moments sx, sy, sxx, syy, sxy
    of the two values over the shared elements.

    Planning writes ``rows``, as they are read several times, and counts the rows of each entity and each element. With
    ``raw`` they are not written: it holds the rows that ``rows`` were made from, and is counted instead, as repeats do
    no harm there. It is ``rows`` itself if these are cheap to read.
    """
    sets = _counted_sets(rows, entity, element, value, hot_floor, raw)
    members, hot = sets.members, sets.hot
    sized = min_jaccard > 0
    size_keep = None
    if sized:
        sizes = sets.sizes
        members = spread_join(members, sizes, ["id"], weights=sizes.select("id", F.col("size").alias("n")))

        def size_keep(size: Column) -> Column:
            small, large = F.least(F.col("size_a"), size), F.greatest(F.col("size_a"), size)
            return small >= F.lit(min_jaccard) * large - EPS

    carried = (["v"] if value else []) + (["size"] if sized else [])
    first_keys = ["size_a"] if sized else []
    light, own = members, []
    if hot:
        if sized or raw is not None:
            members = materialize(members)  # read by the profiles and by the light elements
        masks = _masks(len(hot))
        profiles = _hot_profiles(members, hot, value, sized)
        held = profiles.select("id", _total_bits([F.col(m) for m in masks]).alias("held"))
        light, own = members.join(held, "id", "left").withColumn("held", F.coalesce("held", F.lit(0))), ["held"]

    # Whole numbers are shuffled in as few bytes as hold them, and counted as what they were.
    kind = light.schema["id"].dataType
    short = light.withColumns({c: F.col(c).cast(t) for c, t in sets.narrow.items()})
    lists = _light_lists(sets, short, carried, hot_floor, size_keep, own).withColumn("a", F.col("a").cast(kind))
    x, y = F.col("v_a").cast("double"), F.col("v_bs").cast("double")
    measures = {"n": F.count(F.lit(1))}
    if value:
        measures |= {"sx": F.sum(x), "sy": F.sum(y), "sxx": F.sum(x * x), "syy": F.sum(y * y), "sxy": F.sum(x * y)}
    keys = first_keys + (["held_a"] if hot else [])
    found = count_pairs(lists.drop("size_bs"), keys, measures, sets.n_pairs, sets.heavy, sets.base)
    found = found.withColumn("b", F.col("b").cast(kind))

    # What the first entity alone rules out, whatever the pair shares among the hot elements.
    needed = F.lit(float(min_overlap))
    if sized:
        needed = F.greatest(needed, F.col("size_a") * F.lit(min_jaccard * (1 - SLACK)))
    found = found.filter(F.col("n") + (F.col("held_a") if hot else F.lit(0)) >= needed).drop("held_a")
    if sized:
        found = found.join(sizes.select(F.col("id").alias("b"), F.col("size").alias("size_b")), "b")
    pair_keys = ["a", "b"] + (["size_a", "size_b"] if sized else [])
    pairs = found.select(*pair_keys, *measures)
    if hot:
        alone = _hot_only_pairs(profiles, masks, min_overlap, min_jaccard, hot_floor)
        zeros = [F.lit(0).cast(t).alias(c) for c, t in pairs.dtypes if c in measures]
        both = pairs.unionByName(alone.select(*pair_keys, *zeros))
        pairs = both.groupBy(*pair_keys).agg(*[F.sum(c).alias(c) for c in measures])
        pairs = _add_hot_moments(pairs, profiles, masks, bool(value))
    return pairs.filter(reaches(F.col("n"), min_overlap, min_jaccard))


def overlaps_of(
    groups: DataFrame,
    keys: list[str],
    n_pairs: float,
    rows: DataFrame,
    entity: str,
    element: str,
    hot_floor: int = HOT_FLOOR,
    base: int | None = None,
) -> DataFrame:
    """(a, b, n_met, n): every pair that stands in one of the blocked ``groups``, in how many, and how many elements it shares.

    Their lists are dealt and counted together with those of the elements, so that the pairs are not joined. ``rows``
    are read several times. ``base`` is that of the groups, the :func:`id_base` of all entities.

    Of more than ``ROUND_PAIRS`` entries the lists would need more disk than all the rest, and than the pairs that come of
    them. So the groups are written, and the first entities are dealt into rounds, one after another; of these only the pairs stay.
    """
    sets = _counted_sets(rows, entity, element, None, hot_floor, rows)._replace(base=base)
    light = _light_groups(sets, sets.members, [], hot_floor)
    n_rounds = max(1, math.ceil((n_pairs + sets.n_pairs) / ROUND_PAIRS))
    if n_rounds > 1:
        groups, light = materialize(groups), materialize(light)

    def counted(dealt: tuple[int, int] | None) -> DataFrame:
        given = lists_of(groups, keys, [], True, base=base, dealt=dealt).drop("_lo", "_hi").withColumn("_given", F.lit(1).cast("long"))
        shared = lists_of(light, ["via"], [], sets.vias is not None, base=base, dealt=dealt).withColumn("_given", F.lit(0).cast("long"))
        measures = {"n_met": F.sum("_given"), "n": F.sum(1 - F.col("_given"))}
        lists = given.unionByName(shared.select(given.columns))
        return count_pairs(lists, [], measures, (n_pairs + sets.n_pairs) / n_rounds, sets.heavy, base).filter(F.col("n_met") > 0)

    if n_rounds == 1:
        pairs = counted(None)
    else:
        pairs = reduce(DataFrame.unionByName, [_written(counted((i, n_rounds)), base) for i in range(n_rounds)])
    if sets.hot:
        pairs = _add_hot_moments(pairs, _hot_profiles(sets.members, sets.hot, None, False), _masks(len(sets.hot)), False)
    return pairs


def _written(pairs: DataFrame, base: int | None) -> DataFrame:
    """The pairs (a, b, ...) as a table that is small on disk: a comes in runs, and b as bytes, which have few values."""
    others = [c for c in pairs.columns if c not in ("a", "b")]
    pairs = pairs.sortWithinPartitions("a")
    if base is None:
        return materialize(pairs)
    above = F.col("b") - F.lit(base).cast("long")
    places = {f"_byte{i}": 8 * i for i in range(3)}
    one = F.lit(255).cast("long")
    kept = materialize(
        pairs.select("a", *[(F.shiftright(above, at).bitwiseAND(one) - 128).cast("tinyint").alias(c) for c, at in places.items()], *others)
    )
    b = sum(((F.col(c).cast("long") + 128) * (1 << at) for c, at in places.items()), F.lit(base).cast("long"))
    return kept.select("a", b.alias("b"), *others)


def _ranks(mask: Column, word: int) -> Column:
    return F.transform(_set_places(mask), lambda i: i + 64 * word)


def _hot_profiles(members: DataFrame, hot: list, value: str | None, sized: bool) -> DataFrame:
    """Per entity the masks of its hot elements by rank (0 is the rarest), and their values in the order of the ranks."""
    kind = members.select("via").schema.fields[0].dataType.simpleString()
    ranks = members.sparkSession.createDataFrame([(x, i) for i, x in enumerate(hot)], f"via {kind}, rank int")
    held = members.join(F.broadcast(ranks), "via")  # at most HOT_KEYS rows
    place = F.get(_longs(_BIT), F.col("rank") % 64)
    word = F.floor(F.col("rank") / 64)
    columns = [F.bit_or(F.when(word == w, place).otherwise(F.lit(0).cast("long"))).alias(m) for w, m in enumerate(_masks(len(hot)))]
    if value:
        in_order = F.sort_array(F.collect_list(F.struct("rank", "v")))
        columns.append(F.transform(in_order, lambda x: x["v"]).alias("values"))
    return held.groupBy("id", *(["size"] if sized else [])).agg(*columns)


def _total_bits(masks: list[Column]) -> Column:
    return sum((F.bit_count(m) for m in masks[1:]), F.bit_count(masks[0]))


def _hot_only_pairs(
    profiles: DataFrame, masks: list[str], min_overlap: int, min_jaccard: float, block_rows: int
) -> DataFrame:
    """Pairs that reach the thresholds by their hot elements alone, each once.

    Whether they do depends on the masks and set sizes only. So the entities are grouped into
    classes of equal masks and size, the classes are matched, and just the matching ones are
    written out: every pair of their members is a result.

    The rarest shared hot element keys a match. It stands among the first ``held - needed + 1``
    entries of both masks, as ``needed`` entries are shared.
    """
    needed = F.lit(max(min_overlap, 1))
    label = list(masks)
    if min_jaccard > 0:
        label += ["size"]
        needed = F.greatest(needed, F.ceil(F.col("size") * F.lit(min_jaccard) - EPS).cast("int"))
    held = _total_bits([F.col(m) for m in masks])
    members = profiles.select("id", *label).filter(held >= needed)
    classes = count_by(members, *label)
    large = F.broadcast(
        heavy_hitters(classes, label, block_rows).select(*label, F.ceil(F.col("n") / block_rows).cast("int").alias("_blocks"))
    )
    blocks = F.coalesce(F.col("_blocks"), F.lit(1))

    ranks = F.flatten(F.array(*[_ranks(F.col(m), w) for w, m in enumerate(masks)]))
    prefix = F.slice(ranks, F.lit(1), held - needed + 1)
    keyed = classes.join(large, label, "left").select(*label, "n", blocks.alias("blocks"), F.explode(prefix).alias("key"))

    def side(name: str) -> DataFrame:
        return keyed.select("key", *[F.col(c).alias(f"{c}_{name}") for c in [*label, "n", "blocks"]])

    common = [F.col(f"{m}_a").bitwiseAND(F.col(f"{m}_b")) for m in masks]
    word, place = F.floor(F.col("key") / 64), F.col("key") % 64
    rarest = F.lit(True)  # no common bit below the key
    for w, bits in enumerate(common):
        here = bits.bitwiseAND(F.get(_longs(_BEFORE), place)) == 0
        rarest &= F.when(word == w, here).when(word > w, bits == 0).otherwise(True)
    label_a, label_b = ([f"{c}_{name}" for c in label] for name in ("a", "b"))
    order_a, order_b = F.struct(*[F.col(c).alias(c[:-2]) for c in label_a]), F.struct(*[F.col(c).alias(c[:-2]) for c in label_b])
    matched = (
        side("a")
        .join(side("b"), "key")
        .filter((order_a < order_b) | ((order_a == order_b) & (F.col("n_a") > 1)))
        .filter(reaches(_total_bits(common), min_overlap, min_jaccard))
        .filter(rarest)
        .select(*label_a, *label_b, "blocks_b", F.explode(F.sequence(F.lit(0), F.col("blocks_a") - 1)).alias("_block_a"))
        .withColumn("_block_b", F.explode(F.sequence(F.lit(0), F.col("blocks_b") - 1)))
    )
    placed = members.join(large, label, "left").withColumn("_block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    for name, names in (("a", label_a), ("b", label_b)):
        one = placed.select(
            F.col("id").alias(f"id_{name}"), F.col("_block").alias(f"_block_{name}"),
            *[F.col(c).alias(n) for c, n in zip(label, names)],
        )
        matched = matched.join(one, [*names, f"_block_{name}"])
    rising = F.col("id_a") < F.col("id_b")
    sizes = []
    if min_jaccard > 0:
        sizes = [
            F.when(rising, F.col("size_a")).otherwise(F.col("size_b")).alias("size_a"),
            F.when(rising, F.col("size_b")).otherwise(F.col("size_a")).alias("size_b"),
        ]
    return matched.filter((order_a < order_b) | rising).select(
        F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"), *sizes
    )


def _add_hot_moments(pairs: DataFrame, profiles: DataFrame, masks: list[str], with_values: bool) -> DataFrame:
    carried = masks + (["values"] if with_values else [])
    columns = pairs.columns
    for side in ("a", "b"):
        one = profiles.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in carried])
        pairs = pairs.join(one, side, "left")
    none = F.lit(0).cast("long")  # where a side has no hot element
    common = [F.coalesce(F.col(f"{m}_a").bitwiseAND(F.col(f"{m}_b")), none) for m in masks]
    added = {"n": _total_bits(common).cast("long")}
    if with_values:
        pairs = pairs.withColumn("_shared", _shared_values(masks, common))

        def total(term) -> Column:
            return F.aggregate("_shared", F.lit(0.0), lambda acc, p: acc + term(p["x"], p["y"]))

        added |= {
            "sx": total(lambda x, y: x),
            "sy": total(lambda x, y: y),
            "sxx": total(lambda x, y: x * x),
            "syy": total(lambda x, y: y * y),
            "sxy": total(lambda x, y: x * y),
        }
    return pairs.select(*[(F.col(c) + added[c]).alias(c) if c in added else F.col(c) for c in columns])


def _shared_values(masks: list[str], common: list[Column]) -> Column:
    """The values of both sides at the common hot elements; a value's index is the number of bits before its own."""
    words = []
    ahead = {side: F.lit(0) for side in "ab"}
    for m, bits in zip(masks, common):
        words.append(_shared_in_word(m, bits, ahead))
        ahead = {side: ahead[side] + F.bit_count(F.col(f"{m}_{side}")) for side in "ab"}
    return F.flatten(F.array(*words))


def _shared_in_word(mask: str, bits: Column, ahead: dict[str, Column]) -> Column:
    def value(side: str, i: Column) -> Column:
        before = F.col(f"{mask}_{side}").bitwiseAND(F.get(_longs(_BEFORE), i))
        return F.get(F.col(f"values_{side}"), ahead[side] + F.bit_count(before))

    found = F.transform(_set_places(bits), lambda i: F.struct(value("a", i).alias("x"), value("b", i).alias("y")))
    return F.when(bits != 0, found).otherwise(F.array().cast("array<struct<x:double,y:double>>"))


def similar_pairs(
    members: DataFrame,
    entity: str = "business_id",
    element: str = "user_id",
    threshold: float = 0.05,
    hot_floor: int = HOT_FLOOR,
    raw: DataFrame | None = None,
) -> DataFrame:
    """All pairs (b1 < b2, sim) with Jaccard of at least ``threshold``; equality counts."""
    pairs = overlap_pairs(members, entity, element, min_jaccard=threshold, hot_floor=hot_floor, raw=raw)
    sim = F.round(jaccard(F.col("n"), F.col("size_a"), F.col("size_b")), SIM_DIGITS)
    return pairs.select(F.col("a").alias("b1"), F.col("b").alias("b2"), sim.alias("sim"))


def jaccard_pairs(
    members: DataFrame,
    entity: str = "business_id",
    element: str = "user_id",
    min_overlap: int = 3,
    hot_floor: int = HOT_FLOOR,
    raw: DataFrame | None = None,
) -> DataFrame:
    """Intersection, union and Jaccard of the pairs sharing at least ``min_overlap`` elements."""
    pairs = overlap_pairs(members, entity, element, None, min_overlap, hot_floor=hot_floor, raw=raw)
    sized = with_sizes(pairs, members, entity)
    union = F.col("size_a") + F.col("size_b") - F.col("n")
    return sized.select(
        F.col("a").alias("b1"),
        F.col("b").alias("b2"),
        F.col("n").alias("n_intersection"),
        union.alias("n_union"),
        F.round(F.col("n") / union, SIM_DIGITS).alias("sim"),
    )


def with_sizes(pairs: DataFrame, members: DataFrame, entity: str) -> DataFrame:
    """Add the set sizes of both sides of a pair table.

    An entity in many pairs makes a large partition of pairs, which the runtime splits; nothing is copied ahead.
    """
    sizes = count_by(members, entity, name="size")
    for side in ("a", "b"):
        pairs = pairs.join(sizes.select(F.col(entity).alias(side), F.col("size").alias(f"size_{side}")), side)
    return pairs


def looked_up(sized: DataFrame, rows: DataFrame, entity: str, element: str, value: str | None = None) -> DataFrame:
    """The pairs of ``sized`` (a, b, size_a, size_b) that share elements, with their number ``n``.

    With ``value`` also with the moments of the values over the shared elements. The elements of the smaller
    set of a pair are looked up in the larger one, so a pair costs as many rows as its smaller set has. These rows
    hold the two entities and the element only; the sizes, which are those of ``rows``, come back once per pair.
    """
    first = F.col("size_a") <= F.col("size_b")
    few, many = F.when(first, F.col("a")).otherwise(F.col("b")), F.when(first, F.col("b")).otherwise(F.col("a"))

    def side(name: str, number: str) -> DataFrame:
        numbers = [F.col(value).cast("double").alias(number)] if value else []
        return rows.select(F.col(entity).alias(name), F.col(element).alias("_via"), *numbers)

    found = sized.select(few.alias("_few"), many.alias("_many")).join(side("_few", "_u"), "_few")
    found = found.join(side("_many", "_v"), ["_many", "_via"])
    measures = {"n": F.count(F.lit(1))}
    if value:
        rising = F.col("_few") < F.col("_many")
        x, y = F.when(rising, F.col("_u")).otherwise(F.col("_v")), F.when(rising, F.col("_v")).otherwise(F.col("_u"))
        measures |= {"sx": F.sum(x), "sy": F.sum(y), "sxx": F.sum(x * x), "syy": F.sum(y * y), "sxy": F.sum(x * y)}
    counted = found.groupBy("_few", "_many").agg(*[e.alias(c) for c, e in measures.items()])
    pairs = counted.select(F.least("_few", "_many").alias("a"), F.greatest("_few", "_many").alias("b"), *measures)
    return with_sizes(pairs, rows, entity).select("a", "b", "size_a", "size_b", *measures)


def pair_moments(
    ratings: DataFrame,
    entity: str = "business_id",
    element: str = "user_id",
    stars: str = "stars",
    min_overlap: int = 3,
    hot_floor: int = HOT_FLOOR,
    raw: DataFrame | None = None,
) -> DataFrame:
    """n, Sx, Sy, Sxx, Syy, Sxy over the common entries of each pair with enough of them."""
    return overlap_pairs(ratings, entity, element, stars, min_overlap, hot_floor=hot_floor, raw=raw)


def pearson_pairs(moments: DataFrame) -> DataFrame:
    """(a, b, n, sim): Pearson over the common entries, 0 unless positive."""
    columns = [F.col(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]
    return moments.select("a", "b", "n", pearson(*columns).alias("sim"))
