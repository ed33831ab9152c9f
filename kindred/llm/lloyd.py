"""Vector code compression: product codes fitted by active-entry Lloyd rounds.

Vectors become whole numbers and are cut into equal parts; every part position has a codebook, and a vector's
code is the index of the nearest entry for each of its parts. A round assigns all parts and moves every entry
to the floor of its parts' mean. Each part keeps its assigned entry and the exact distance to it. Where that
entry stayed fixed in the last update, no other fixed entry can have come closer, so only the entries that
moved are compared with the stored distance; where it moved, the part is scanned against the whole codebook.
Ties go to the lower index in both.

Tasks hold one batch of vectors and the codebooks, ``entries`` vectors in all. The sums of an update are added
up within a task first, so a third of all rows in one entry shuffles no more than any other entry. The driver
reads the first ``entries`` vectors and one sum for each entry and component. Rounds are written to the shared folder.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.tables import Scratch
from kindred.operators.skew import count_by, spread_join

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
CHUNK = 1_000  # rows of one label that a task joins
_STATE = "vec_id long, label string, v array<int>, code binary, best binary, error long"


class Compressed(NamedTuple):
    """``rows``: vec_id, label, code (binary, one byte a part), error; ``codebooks``: parts x entries x width."""

    rows: DataFrame
    codebooks: np.ndarray


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of every row of ``x`` to every entry, in whole numbers."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)[None, :]


def scan(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row and its distance; the lowest index of those equally near."""
    d = distances(x, entries)
    nearest = d.argmin(axis=1)
    return nearest, d[np.arange(len(x)), nearest]


def reassign(
    x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, best: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries after the entries ``moved``, from the last ones and their distances."""
    code, best = code.copy(), best.copy()
    active = np.flatnonzero(moved)
    if not len(active):
        return code, best
    lost = np.flatnonzero(moved[code])
    held = np.flatnonzero(~moved[code])
    if len(lost):
        code[lost], best[lost] = scan(x[lost], entries)
    if len(held):
        near, d = scan(x[held], entries[active])
        near = active[near]
        closer = (d < best[held]) | ((d == best[held]) & (near < code[held]))
        code[held[closer]], best[held[closer]] = near[closer], d[closer]
    return code, best


def _matrix(column: pa.Array, n: int, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, width)


def _assign_batches(codebooks: np.ndarray, moved: np.ndarray | None):
    parts, _, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column("v"), n, parts * width).reshape(n, parts, width)
            code, best = np.empty((n, parts), np.int64), np.empty((n, parts), np.int64)
            if moved is not None:
                code[:] = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, parts)
                best[:] = np.frombuffer(b"".join(batch.column("best").to_pylist()), "<i8").reshape(n, parts)
            for p in range(parts):
                if moved is None:
                    code[:, p], best[:, p] = scan(x[:, p], codebooks[p])
                else:
                    code[:, p], best[:, p] = reassign(x[:, p], codebooks[p], moved[p], code[:, p], best[:, p])
            codes, bests = code.astype(np.uint8), best.astype("<i8")
            packed = [pa.array([row.tobytes() for row in a], pa.binary()) for a in (codes, bests)]
            kept = [batch.column(c) for c in ("vec_id", "label", "v")]
            names = ["vec_id", "label", "v", "code", "best", "error"]
            yield pa.RecordBatch.from_arrays([*kept, *packed, pa.array(best.sum(axis=1))], names=names)

    return run


def _sum_batches(parts: int, entries: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column("v"), n, parts * width).reshape(n * parts, width)
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, parts)
            at = (code.astype(np.int64) + entries * np.arange(parts)).ravel()
            counts += np.bincount(at, minlength=len(counts))
            order = np.argsort(at, kind="stable")
            first = np.flatnonzero(np.diff(at[order], prepend=-1))
            sums[at[order][first]] += np.add.reduceat(x[order], first, axis=0)
        used = np.flatnonzero(counts)
        if len(used):
            columns = [pa.array(used), pa.array(counts[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["at", "n", "sums"])

    return run


def _update(state: DataFrame, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codebooks moved to the floors of the means, and which entries changed."""
    parts, entries, width = codebooks.shape
    partial = state.select("v", "code").mapInArrow(_sum_batches(parts, entries, width), "at long, n long, sums array<long>")
    exact = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    new = codebooks.copy()
    for row in partial.groupBy("at").agg(F.sum("n").alias("n"), *exact).collect():
        new[row["at"] // entries, row["at"] % entries] = [int(row[f"s{i}"]) // row["n"] for i in range(width)]
    return new, (new != codebooks).any(axis=2)


def _whole(embeddings: DataFrame, column: str, parts: int) -> DataFrame:
    """vec_id, label (as text) and v, of the vectors that take part."""
    vector = F.col(column)
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), vector.alias("raw"), finite.alias("ok")
    ).filter(F.col("ok"))
    first = rows.filter((F.size("raw") > 0) & (F.size("raw") % parts == 0)).agg(
        F.min(F.struct(F.col("vec_id").isNull().alias("last"), "vec_id", F.size("raw").alias("d"))).alias("m")
    )
    found = first.first()["m"]
    d = found["d"] if found else parts
    most = math.isqrt((1 << 61) // d)  # up to here every sum of squares is a long
    scaled = F.transform("raw", lambda x: F.floor(x.cast("double") * SCALE))
    rows = rows.filter(F.size("raw") == d).filter(F.forall("raw", lambda x: F.abs(x.cast("double")) * SCALE < min(most, 1 << 30)))
    return rows.select("vec_id", "label", F.transform(scaled, lambda x: x.cast("int")).alias("v"))


def compress(
    embeddings: DataFrame, column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Compressed:
    """Codes of all vectors of ``embeddings`` (vec_id, label and ``column``), and the codebooks (at most 256 entries).

    A vector that is null or holds a null, NaN or infinity is dropped; so is one whose length is not that of the
    smallest vec_id with a length that ``parts`` divide, and one with a component of such size that a squared
    distance might not be a long (2**19 at 64 components). Rows may repeat, and count as often as they stand there.
    A null vec_id is kept and comes after all others in the choice of first entries, rows of one vec_id in the order
    of their numbers. With fewer vectors than ``entries`` the codebooks are as short. No vectors give no rows. Other
    columns are ignored, whatever their names.
    """
    scratch = Scratch(embeddings.sparkSession)
    whole = _whole(embeddings, column, parts)
    first = scratch.keep(whole.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries))
    seeds = [r["v"] for r in first.orderBy(F.col("vec_id").asc_nulls_last(), "v").collect()]
    width = len(seeds[0]) // parts if seeds else 1
    codebooks = np.array(seeds, np.int64).reshape(len(seeds), parts, width).transpose(1, 0, 2).copy()
    state = scratch.keep(whole.mapInArrow(_assign_batches(codebooks, None), _STATE))
    for _ in range(rounds if seeds else 0):
        codebooks, moved = _update(state, codebooks)
        before, state = state, scratch.keep(state.mapInArrow(_assign_batches(codebooks, moved), _STATE))
        scratch.drop(before)
    scratch.drop(first)
    return Compressed(state.select("vec_id", "label", "code", "error"), codebooks)


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of the components of all entries, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def label_errors(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``rows`` with label_error, the error summed over the rows of a label; nulls are one label."""
    label = F.coalesce(F.concat(F.lit("="), "label"), F.lit(""))
    marked = rows.withColumns({"_label": label, "_row": F.monotonically_increasing_id()})
    sums = marked.groupBy("_label").agg(F.sum("error").alias("label_error"))
    return spread_join(marked, sums, ["_label"], weights=count_by(marked, "_label"), chunk=chunk).drop("_label", "_row")
