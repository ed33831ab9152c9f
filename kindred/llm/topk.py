"""Exact top-k search by inner product, block at a time.

Rows are sorted by the nearest of ``PIVOTS`` rows and cut into blocks. A component of a vector is a term; a block keeps
the largest and smallest value of each, and the sum of what these allow bounds the score of any of its rows. Every
query first scores its own block, whose k-th score is its floor. Then it takes the other blocks by falling bound and
scores them through their forward index, the matrix of the block; each k-th score raises the floor, and the first
bound below it ends the search.

Blocks travel in groups and queries in packs. A group of blocks and a part of the packs meet in one task by an
equality join, and only the best k of each query go on; no row is made for a query and a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.tables import Scratch

K = 5
BLOCK = 1024
PACK = 256
FIRST = 2  # blocks a query scores between two looks at its floor
GROUP = 64  # blocks that meet packs in one task
PACKS = 64  # packs that meet them there
PIVOTS = 64
SCALE = 256
EVERY = 50
LIMIT = 1 << 53  # below this, sums of products are exact as doubles

_BLOCKS = "block long, n int, d int, ids binary, vectors binary, most binary, least binary"
_PACKS = "pack long, n int, d int, ids binary, places binary, floors array<long>, vectors binary"


def _matrix(raw: bytes, n: int, d: int) -> np.ndarray:
    return np.frombuffer(raw, np.int64).reshape(n, d)


def _packed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors, ``size`` rows at a time, shorter vectors filled up with zeros."""
    ids: list[int] = []
    rows: list[np.ndarray] = []
    for batch in batches:
        lists = batch.column("vector")
        values, cuts = lists.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
        for i, vec_id in enumerate(batch.column("vec_id").to_pylist()):
            ids.append(vec_id)
            rows.append(values[cuts[i] : cuts[i + 1]])
            if len(ids) == size:
                yield _filled(ids, rows)
                ids, rows = [], []
    if ids:
        yield _filled(ids, rows)


def _filled(ids: list[int], rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    out = np.zeros((len(rows), max(map(len, rows))), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return np.array(ids, np.int64), out


def _block_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for number, (ids, matrix) in enumerate(_packed(batches, size)):
            parts = [ids, matrix, matrix.max(axis=0), matrix.min(axis=0)]
            yield pa.RecordBatch.from_pylist(
                [dict(zip("block n d ids vectors most least".split(), [base + number, *matrix.shape, *[p.tobytes() for p in parts]]))],
                pa.schema([("block", pa.int64()), ("n", pa.int32()), ("d", pa.int32())] + [(c, pa.binary()) for c in ("ids", "vectors", "most", "least")]),
            )

    return run


def _cell_batches(pivots: np.ndarray):
    """The nearest pivot of each vector, so that close vectors come to lie in the same blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                _, matrix = next(_packed(iter([part]), part.num_rows))
                d = max(matrix.shape[1], pivots.shape[1])
                x, y = (np.pad(m.astype(float), ((0, 0), (0, d - m.shape[1]))) for m in (matrix, pivots))
                cells.append(((y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)).argmin(axis=1).astype(np.int32))
            cell = pa.array(np.concatenate(cells) if cells else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([cell, batch.column("vec_id"), batch.column("vector")], names=["cell", "vec_id", "vector"])

    return run


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The ``k`` best of (-score, id), ascending."""
    if len(scores) > 4 * k and scores.dtype != object:
        at = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        scores, ids = scores[at], ids[at]
    return sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist()))[:k]


def _pack_batches(every: int, size: int, k: int):
    """Packs of queries with where each stands and its ``k``-th score within its own block, if that has so many."""
    schema = pa.schema(
        [("pack", pa.int64()), ("n", pa.int32()), ("d", pa.int32()), ("ids", pa.binary()), ("places", pa.binary())]
        + [("floors", pa.list_(pa.int64())), ("vectors", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        held: list[tuple[int, tuple[int, int], int | None, np.ndarray]] = []

        def packed():
            vectors = np.zeros((len(held), max(len(h[-1]) for h in held)), np.int64)
            for i, h in enumerate(held):
                vectors[i, : len(h[-1])] = h[-1]
            ids, places = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64)
            row = [base + number, *vectors.shape, ids.tobytes(), places.tobytes(), [h[2] for h in held], vectors.tobytes()]
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, row))], schema)

        for batch in batches:
            for row in batch.to_pylist():
                ids, matrix = np.frombuffer(row["ids"], np.int64), _matrix(row["vectors"], row["n"], row["d"])
                queries = np.flatnonzero(ids % every == 0)
                scores = _exact(matrix[queries], matrix.T)
                for i, at in enumerate(queries.tolist()):
                    best = _top(np.delete(scores[i], at), np.delete(ids, at), k)
                    floor = -best[-1][0] if len(best) == k and abs(best[-1][0]) < 1 << 63 else None
                    held.append((int(ids[at]), (row["block"], at), floor, matrix[at]))
                    if len(held) == size:
                        yield packed()
                        held, number = [], number + 1
        if held:
            yield packed()

    return run


def _exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The product of two integer matrices: in doubles where these are exact, in whole numbers of any size
    where 64 bits may not do."""
    d = min(left.shape[1], right.shape[0])
    left, right = left[:, :d], right[:d]
    most = max(1, d) * float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0))
    if most < LIMIT:
        return (left.astype(np.float64) @ right.astype(np.float64)).astype(np.int64)
    if most >= 2.0**63:
        return left.astype(object) @ right.astype(object)
    return left @ right


def _search_pack(row: dict, blocks: list[tuple[int, np.ndarray, np.ndarray]], most, least, k: int, step: int):
    """The best of each query of a pack among the blocks of a group, and how many blocks were scored for them.

    A query takes its blocks by falling bound, ``step`` at a time, and stops at the first one below its floor: the
    greater of that from its own block and the ``k``-th score here so far. A block equal to it may hold a smaller id.
    """
    queries = _matrix(row["vectors"], row["n"], row["d"])
    places = np.frombuffer(row["places"], np.int64).reshape(-1, 2)
    bound = _exact(np.maximum(queries, 0), most) + _exact(np.minimum(queries, 0), least)
    order = np.argsort(-bound, axis=1, kind="stable")
    floors: list[int | None] = list(row["floors"])
    best: list[list[tuple[int, int]]] = [[] for _ in floors]
    active, scored = list(range(len(floors))), 0
    for first in range(0, len(blocks), step):
        wanted: dict[int, list[int]] = {}
        still = []
        for i in active:
            for b in order[i, first : first + step].tolist():
                if floors[i] is not None and bound[i, b] < floors[i]:
                    break
                wanted.setdefault(b, []).append(i)
            else:
                still.append(i)
        for b, sel in wanted.items():
            number, ids, matrix = blocks[b]
            scores = _exact(queries[sel], matrix.T)
            scored += len(sel)
            for i, mine in zip(sel, scores):
                at = np.arange(len(ids)) if floors[i] is None else np.flatnonzero(mine >= floors[i])
                if places[i, 0] == number:
                    at = at[at != places[i, 1]]
                if len(at):
                    best[i] = sorted(best[i] + _top(mine[at], ids[at], k))[:k]
                    if len(best[i]) == k:
                        floors[i] = max(-best[i][-1][0], floors[i]) if floors[i] is not None else -best[i][-1][0]
        active = still
        if not active:
            break
    return best, scored


def _group_table(k: int, step: int):
    """Rows of the best by pack and place; one with place -1 says how many of how many (query, block) were scored."""
    schema = pa.schema([(c, pa.int64()) for c in ("pack", "place", "query_id", "vec_id", "score")])

    def run(packs: pa.Table, group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        blocks = [(r["block"], np.frombuffer(r["ids"], np.int64), _matrix(r["vectors"], r["n"], r["d"])) for r in rows]
        most, least = np.zeros((2, max((r["d"] for r in rows), default=1), len(rows)), np.int64)
        for i, r in enumerate(rows):  # where a vector is shorter it counts as filled up with zeros
            most[: r["d"], i], least[: r["d"], i] = (np.frombuffer(r[c], np.int64) for c in ("most", "least"))
        out: list[tuple] = []
        for row in packs.to_pylist() if rows else []:
            best, scored = _search_pack(row, blocks, most, least, k, step)
            ids = np.frombuffer(row["ids"], np.int64).tolist()
            out += [(row["pack"], p, ids[p], j, -s) for p, found in enumerate(best) for s, j in found]
            out.append((row["pack"], -1, None, scored, len(rows) * row["n"]))
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)], schema=schema)

    return run


def find(
    vectors: DataFrame,
    k: int = K,
    every: int = EVERY,
    block: int = BLOCK,
    pack: int = PACK,
    first: int = FIRST,
    scale: int = SCALE,
    group: int = GROUP,
) -> DataFrame:
    """What the groups of blocks give: pack, place, query_id, vec_id, score, as :func:`search` ranks them.

    Rows with place -1 tell for a pack and group how many (query, block) were scored (vec_id) of how many (score).
    """
    scratch = Scratch(vectors.sparkSession)
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("vector"),
    )
    turn = F.xxhash64("vec_id", "vector")
    pivots = [r.vector for r in scratch.keep(valid.orderBy(turn, "vec_id", "vector").limit(PIVOTS)).collect()]
    pivots = _filled([0] * len(pivots), [np.array(v, np.int64) for v in pivots])[1] if pivots else np.zeros((1, 1))
    # the row number only spreads rows of one id; the blocks are written before anything reads them
    tasks = -(-valid.count() // (8 * block)) or 1
    celled = valid.mapInArrow(_cell_batches(pivots), "cell int, vec_id long, vector array<long>")
    order = ["cell", "vec_id", "row"]
    ranged = celled.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(tasks, *order)
    blocks = scratch.keep(
        ranged.sortWithinPartitions(*order).select("vec_id", "vector").mapInArrow(_block_batches(block), _BLOCKS)
    )
    fewer = max(1, 8 * block * tasks // (every * pack))
    packs = scratch.keep(
        blocks.select("block", "n", "d", "ids", "vectors").coalesce(fewer).mapInArrow(_pack_batches(every, pack, k), _PACKS)
    )
    # groups of blocks and parts of packs: each pair of these meets in one task, whose memory both bound
    groups, parts = -(-blocks.count() // group) or 1, -(-packs.count() // PACKS) or 1

    def each(n: int, name: str):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    part, place = F.pmod(F.xxhash64("pack"), F.lit(parts)).cast("int"), F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")
    left = packs.select("*", part.alias("part"), each(groups, "grouped")).groupBy("part", "grouped")
    right = blocks.select("*", place.alias("grouped"), each(parts, "part")).groupBy("part", "grouped")
    return left.cogroup(right).applyInArrow(
        _group_table(k, first), "pack long, place long, query_id long, vec_id long, score long"
    )


def search(
    vectors: DataFrame,
    k: int = K,
    every: int = EVERY,
    block: int = BLOCK,
    pack: int = PACK,
    first: int = FIRST,
    scale: int = SCALE,
    group: int = GROUP,
) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` highest scores of every query, ties to the smaller vec_id.

    Components x become floor(scale * x), and a score is the integer inner product; where lengths differ
    the shorter vector counts as filled up with zeros. Queries are the rows whose vec_id is divisible by
    ``every``; candidates are all other rows, also those with the same id. Rows with a null id, a null
    vector, or a null or non-finite component take no part. Repeated rows are rows of their own. Other columns
    are ignored, whatever their names; an empty table gives no rows. A result score beyond 64 bits raises an error.
    """
    found = find(vectors, k, every, block, pack, first, scale, group).filter("place >= 0")
    order = Window.partitionBy("pack", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def scored_share(found: DataFrame) -> float:
    """Which part of all (query, block) pairs of a result of :func:`find` was scored; the bounds ruled out the rest."""
    scored, pairs = found.filter("place < 0").agg(F.sum("vec_id"), F.sum("score")).first()
    return (scored or 0) / (pairs or 1)
