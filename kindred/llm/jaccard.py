"""N-gram Jaccard join with Bayesian candidate pruning.

Documents with equal sets of word shingles are one class, and only a class's first row goes on. Classes
that agree in one of ``BANDS`` bands of MinHash values are candidates. A pair's values are compared some
at a time: after each step the posterior of its similarity, from a uniform prior and the agreements so
far, is looked up, and the pair is dropped when the chance of reaching the threshold is below
``TOLERANCE``. What is left is verified exactly on the shingles.

No pair is written out. First the buckets are compared: in a bucket each class is linked to one earlier
class it may still match, which gives connected families in linear size. Then each family meets
as a whole, in blocks, so each of its pairs is compared once, in the memory of one task; what leaves it
is each class's number of links and a spanning forest of them. A large bucket or family is dealt out as
pairs of blocks. Only its own size is squared there, as is the number of links that are asked for.

Chances: a pair at the threshold is missed by all bands with probability (1 - 0.8**5)**40 = 1.2e-7, and
dropped wrongly with at most about ``TOLERANCE``.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import bytesops as B
from kindred.llm.components import components
from kindred.llm.tables import KEY, KEY_SCHEMA, Scratch, keyed

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 5
TOLERANCE = 1e-6
STEP = 20  # MinHash values compared before the posterior is asked again
BLOCK = 256  # classes of a block
BLOCK_BYTES = 4 << 20  # shingles of a block


def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20261201)
    return (rng.integers(0, 1 << 63, n, dtype=np.uint64) << B.U(1)) | B.U(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def signatures(shingles: np.ndarray, cuts: np.ndarray, n_hashes: int) -> np.ndarray:
    """Eight bits of each MinHash value (multiply-shift) of the non-empty sets between consecutive ``cuts``.

    Unequal values agree in a 256th of all cases, which only ever adds candidates.
    """
    a, b = _family(n_hashes)
    out = np.empty((len(cuts) - 1, n_hashes), np.uint8)
    for i in range(n_hashes):
        out[:, i] = np.minimum.reduceat(shingles * a[i] + b[i], cuts[:-1]) >> B.U(24) & B.U(255)
    return out


def posterior_floor(threshold: float, tolerance: float, n_hashes: int, step: int) -> list[int]:
    """Fewest agreements after ``step``, 2 ``step``, ... values with which a pair stays a candidate.

    With m of n agreements and a uniform prior the similarity is Beta(m + 1, n - m + 1), so its chance of
    reaching the threshold t is the chance of at most m successes among n + 1 trials of probability t.
    """
    floors = []
    for n in range(step, n_hashes + 1, step):
        below, chance = 0, 0.0
        for m in range(n + 1):
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if chance >= tolerance:
                break
            below = m + 1
        floors.append(below)
    return floors


def _shingle_sets(texts: B.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each text's begin.

    A text with fewer words than a shingle has one of all its words, without words none.
    """
    words = B.words(texts, ~B.BLANK)
    values = B.range_hashes(texts, words.start, words.end)
    n = np.diff(words.offsets)
    low = np.arange(len(values))
    high = np.minimum(low + size, words.offsets[words.doc + 1])
    use = (high - low == size) | (low == words.offsets[words.doc])
    hashes, doc = B.Rolling(values, 1)(low[use], high[use]), words.doc[use]
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    fresh = np.append(True, (np.diff(hashes) != 0) | (np.diff(doc) != 0))[: len(hashes)]
    hashes, doc = hashes[fresh], doc[fresh]
    return hashes, np.searchsorted(doc, np.arange(len(n) + 1))


_SIGNED = f"{KEY_SCHEMA}, n_shingles int, s1 long, s2 long, signature binary"


def _signature_batches(size: int, n_hashes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in B.chunks(batch.column("text")):
                hashes, cuts = _shingle_sets(texts, size)
                full = np.flatnonzero(np.diff(cuts))
                n = np.diff(cuts)
                found = signatures(hashes, np.append(cuts[:-1][full], len(hashes)), n_hashes) if len(full) else None
                whole = [B.hashes(hashes, cuts[:-1], cuts[1:], k) for k in (2, 3)]
                rows = [None] * len(n)
                for i, at in enumerate(full.tolist()):
                    rows[at] = found[i].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(k).slice(texts.first, len(n)) for k in KEY],
                        pa.array(n.astype(np.int32)),
                        *[pa.array(B.signed(w)) for w in whole],
                        pa.array(rows, pa.binary()),
                    ],
                    names=[*KEY, "n_shingles", "s1", "s2", "signature"],
                )

    return run


def _band_batches(bands: int, rows: int):
    """A row for each class and band with the hash of its values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                values = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint8)
                values = values.reshape(part.num_rows, bands, rows)
                mixed = np.zeros(values.shape[:2], B.U)
                for i in range(rows):
                    mixed = B.mix(mixed + values[:, :, i] + B.U(i + 1))
                node = np.repeat(part.column("node").to_numpy(), bands)
                band = np.tile(np.arange(bands, dtype=np.int32), part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array(band), pa.array(B.signed(mixed.ravel()))], names=["node", "band", "bucket"]
                )

    return run


def _survivors(left: np.ndarray, right: np.ndarray, floors: list[int], step: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows whose agreements never fall below the floor of a step."""
    i, j = (x.ravel() for x in np.indices((len(left), len(right))))
    agree = np.zeros(len(i), np.int32)
    for k, floor in enumerate(floors):
        here = slice(k * step, (k + 1) * step)
        for at in range(0, len(i), 1 << 16):
            part = slice(at, at + (1 << 16))
            agree[part] += (left[i[part], here] == right[j[part], here]).sum(axis=1, dtype=np.int32)
        stay = agree >= floor
        i, j, agree = i[stay], j[stay], agree[stay]
    return i, j


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict, bool]]:
    """Of each row the columns of its two lists, and whether it is one block met with itself."""
    for batch in batches:
        for i in range(batch.num_rows):
            sides = []
            for name in ("list", "others"):
                value = batch.column(name)[i]
                sides.append({f.name: value.values.field(f.name).to_pylist() for f in value.type.value_type} if value.is_valid else None)
            yield sides[0], sides[1] or sides[0], sides[1] is None


def _signature_rows(side: dict, n_hashes: int) -> np.ndarray:
    return np.frombuffer(b"".join(side["signature"]), np.uint8).reshape(-1, n_hashes)


def _meeting_batches(floors: list[int], step: int, n_hashes: int):
    """Rows of two blocks of one bucket: each member, and one it may match where there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, two, _ in _sides(batches):
            nodes, others = (np.array(side["node"], np.int64) for side in (one, two))
            i, j = _survivors(_signature_rows(one, n_hashes), _signature_rows(two, n_hashes), floors, step)
            pairs = np.stack([nodes[i], others[j]], axis=1)
            pairs = _forest(pairs[pairs[:, 0] != pairs[:, 1]])
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return run


def _forest(pairs: np.ndarray) -> np.ndarray:
    """A spanning forest of the graph with these edges: for each node but the smallest, an edge to that."""
    if not len(pairs):
        return pairs.reshape(0, 2)
    nodes, flat = np.unique(pairs, return_inverse=True)
    a, b = flat.reshape(pairs.shape).T
    root = np.arange(len(nodes))
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            break
        root = new
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return np.stack([nodes[child], nodes[root[child]]], axis=1)


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of two blocks, by products of 0/1 matrices."""
    sides = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s])) for s in (left, right)]
    common = np.intersect1d(*[np.unique(values) for values, _ in sides], assume_unique=True)
    out = np.zeros((len(left), len(right)))
    for first in range(0, len(common), 8192):
        columns = common[first : first + 8192]
        tables = []
        for (values, row), n in zip(sides, out.shape):
            at = np.minimum(np.searchsorted(columns, values), len(columns) - 1)
            hit = columns[at] == values
            table = np.zeros((n, len(columns)), np.float32)
            table[row[hit], at[hit]] = 1
            tables.append(table)
        out += tables[0] @ tables[1].T
    return out


def _linked(left: list[np.ndarray], right: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs reach the threshold, counted exactly."""
    if not len(i):
        return np.zeros(0, bool)
    rows, columns = np.unique(i), np.unique(j)
    shared = _shared([left[x] for x in rows], [right[y] for y in columns])
    shared = shared[np.searchsorted(rows, i), np.searchsorted(columns, j)]
    size = np.array([len(x) for x in left])[i] + np.array([len(y) for y in right])[j]
    return shared >= threshold * (size - shared) - 1e-9


_LINKS = "node long, n_links long, a long, b long"


def _family_batches(threshold: float, floors: list[int], step: int, n_hashes: int):
    """Rows of two blocks of one family: links of each member to the other block, and a forest of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, two, same in _sides(batches):
            nodes, others = (np.array(side["node"], np.int64) for side in (one, two))
            copies, others_copies = (np.array(side["copies"], np.int64) for side in (one, two))
            i, j = _survivors(_signature_rows(one, n_hashes), _signature_rows(two, n_hashes), floors, step)
            once = nodes[i] < others[j] if same else np.ones(len(i), bool)
            i, j = i[once], j[once]
            sets = [[np.frombuffer(x, B.U) for x in side["shingles"]] for side in (one, two)]
            hit = _linked(*sets, i, j, threshold)
            i, j = i[hit], j[hit]
            n_left = np.bincount(i, others_copies[j], len(nodes)).astype(np.int64)
            n_right = np.bincount(j, copies[i], len(others)).astype(np.int64)
            members = np.concatenate([nodes[n_left > 0], others[n_right > 0]])
            counts = np.concatenate([n_left[n_left > 0], n_right[n_right > 0]])
            forest = _forest(np.stack([nodes[i], others[j]], axis=1))
            gap = [pa.nulls(len(members), pa.int64())] * 2, [pa.nulls(len(forest), pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(members), gap[1][0]]),
                    pa.concat_arrays([pa.array(counts), gap[1][1]]),
                    pa.concat_arrays([gap[0][0], pa.array(forest[:, 0])]),
                    pa.concat_arrays([gap[0][1], pa.array(forest[:, 1])]),
                ],
                names=["node", "n_links", "a", "b"],
            )

    return run


def _shingle_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in B.chunks(batch.column("text")):
                hashes, cuts = _shingle_sets(texts, size)
                n = len(cuts) - 1
                sets = [hashes[cuts[i] : cuts[i + 1]].tobytes() for i in range(n)]
                kept = [batch.column(k).slice(texts.first, n) for k in ("node", "root", "copies", "signature")]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(sets, pa.binary())], names=["node", "root", "copies", "signature", "shingles"]
                )

    return run


def block_pairs(members: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """All pairs of blocks of a group as rows of two lists, ``list`` and ``others``.

    ``members`` has the group's ``key``, its number of blocks ``n_blocks``, the member's ``block`` (from 0)
    and the columns to list. A block is listed once for each block with members that it meets; where it
    meets itself, ``others`` is null.
    """
    listed = F.struct(*columns).alias("item")
    first = members.select(*key, F.col("block").alias("x"), F.explode(F.sequence("block", F.col("n_blocks") - 1)).alias("y"), listed)
    second = members.filter("block > 0").select(
        *key, F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("x"), F.col("block").alias("y"), listed
    )
    lists = first.groupBy(*key, "x", "y").agg(F.collect_list("item").alias("list"))
    others = second.groupBy(*key, "x", "y").agg(F.collect_list("item").alias("others"))
    # a block may have no members: a null then stands for nothing to meet, not for the block itself
    met = lists.join(others, [*key, "x", "y"], "left").filter("x = y OR others IS NOT NULL")
    return met.select("list", "others")


def join(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    tolerance: float = TOLERANCE,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """Every row of ``docs`` by doc_id (and _id, _key) with n_shingles, class_id, copy_id and n_links.

    Rows are linked if the Jaccard similarity of their sets of ``words``-word shingles is at least
    ``threshold``; n_links counts the linked rows, copies included, without the row itself. class_id is
    the smallest number of a connected group, which is the smallest doc_id in it where ids are unique
    and not null (the group of a null id is numbered as the lowest). copy_id is the same for rows with
    equal sets. Rows without words have no links and are a class of their own (class_id: their id).
    Null texts are empty and repeated rows copies. Texts may be of any length, other columns are ignored, whatever
    their names, and an empty table gives no rows.
    """
    scratch, n_hashes = Scratch(docs.sparkSession), bands * rows
    floors = posterior_floor(threshold, tolerance, n_hashes, STEP)
    docs = keyed(docs)
    signed = scratch.keep(docs.select(*KEY, "text").mapInArrow(_signature_batches(words, n_hashes), _SIGNED))
    identity = ["n_shingles", "s1", "s2"]
    # one row for each set, numbered by its smallest id; ids may repeat, so equal numbers are told apart
    first = signed.filter("n_shingles > 0").groupBy(*identity).agg(
        F.min(F.struct(*KEY)).alias("place"), F.count(F.lit(1)).alias("copies"), F.any_value("signature").alias("signature")
    )
    first = scratch.keep(first)
    owners = first.groupBy(F.col("place._id").alias("owner")).agg(F.min(F.struct(*identity)).alias("least"))
    mine = F.struct(*identity) == F.col("least")
    classes = scratch.keep(
        first.join(owners, F.col("place._id") == F.col("owner")).select(
            *identity,
            "place",
            "copies",
            "signature",
            F.when(mine, F.col("owner")).otherwise(F.xxhash64("owner", *identity)).alias("node"),
        )
    )
    scratch.drop(first)
    banded = scratch.keep(
        classes.select("node", "signature").mapInArrow(_band_batches(bands, rows), "node long, band int, bucket long")
    )
    buckets = banded.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = buckets.select("band", "bucket", F.ceil(F.col("n") / block).cast("int").alias("n_blocks"))
    met = scratch.keep(banded.join(buckets, ["band", "bucket"]))
    scratch.drop(banded)
    own_block = F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int").alias("block")
    met = met.join(classes.select("node", "signature"), "node").select("*", own_block)
    maybe = block_pairs(met, ["band", "bucket"], ["node", "signature"])
    maybe = scratch.keep(maybe.mapInArrow(_meeting_batches(floors, STEP, n_hashes), "a long, b long").distinct())
    roots = components(maybe, scratch)
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    known = classes.select("node", "place.*", "copies", "signature").join(roots, "node")
    full = scratch.keep(
        docs.select(*KEY, "text").join(known, KEY).drop(*KEY).dropDuplicates(["node"]).mapInArrow(
            _shingle_batches(words), "node long, root long, copies long, signature binary, shingles binary"
        )
    )
    weights = full.groupBy("root").agg(F.sum(F.length("shingles")).alias("bytes"))
    blocks = sizes.join(weights, "root").select(
        "root", F.ceil(F.greatest(F.col("n") / block, F.col("bytes") / BLOCK_BYTES)).cast("int").alias("n_blocks")
    )
    members = full.join(blocks, "root").select("*", own_block)
    pairs = block_pairs(members, ["root"], ["node", "copies", "signature", "shingles"])
    found = scratch.keep(pairs.mapInArrow(_family_batches(threshold, floors, STEP, n_hashes), _LINKS))
    links = found.filter("node IS NOT NULL").groupBy("node").agg(F.sum("n_links").alias("n_links"))
    linked = components(found.filter("a IS NOT NULL"), scratch)
    out = (
        classes.drop("signature", "place")
        .join(links, "node", "left")
        .join(linked, "node", "left")
        .select(
            *identity,
            F.col("node").alias("copy_id"),
            F.coalesce("root", "node").alias("class_id"),
            (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    rows_of = signed.drop("signature")
    named = rows_of.join(out, identity, "left")
    empty = F.col("n_shingles") == 0
    return named.select(
        F.when(F.col("_id") != F.lit(-(1 << 63)), F.col("_id")).alias("doc_id"),
        *KEY,
        F.col("n_shingles").cast("long").alias("n_shingles"),
        F.when(empty, F.col("_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(empty, F.col("_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.when(empty, F.lit(0).cast("long")).otherwise(F.col("n_links")).alias("n_links"),
    )
