"""Suffix-array dedup with two-stage sorting.

A window of ``LENGTH`` bytes goes if it also starts earlier. To bring equal windows together, each
window belongs to the smallest-hashed run of ``SEED`` bytes in it, its anchor; equal windows have
equal anchors, and the windows of one anchor are one short segment of the text. Segments whose anchor
stands only once are out. Occurrences of an anchor with equal bytes as far as a window reaches form a
class, of which only the first goes on; the windows of the others all start earlier too.

The first segments of an anchor's classes meet in one task and are laid one behind the other. There a
suffix array is built in two stages: suffixes smaller than their successors are sorted directly, to a
depth of ``LENGTH`` bytes; the others are induced from them by one scan over the buckets of first
bytes. Windows whose adjacent common prefix reaches ``LENGTH`` are equal; all but the first go.

An anchor with more than ``CROWD`` classes, such as the edge of a passage that half of all documents
share, is not put into one task. Its windows are compared by two 64-bit hashes, ``STRIDE`` consecutive
ones at a time, and one by one only within the first of each kind of these. Both have a partial step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import bytesops as B
from kindred.llm.tables import KEY, KEY_SCHEMA, Scratch, keyed

LENGTH = 100
SEED = 32
CROWD = 2048  # classes of one anchor that one task sorts at most
STRIDE = 8  # consecutive windows of a crowded anchor that are compared at once
SORTED_BYTES = 1 << 19  # bytes of one suffix array, more only for a single anchor


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``data`` in the order of their suffixes, exact to ``depth`` bytes.

    Stage one sorts the suffixes smaller than their successors by their bytes. Stage two goes through
    the buckets of first bytes upwards: in each, the remaining suffixes are ordered by the rank of
    their successors, which lie in this bucket or an earlier one, and stand before the sorted ones.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    padded = np.concatenate([data, np.zeros(depth, np.uint8)])
    step = np.sign(np.diff(data.astype(np.int16)))
    step = np.append(step, -1)  # the last suffix is larger than the empty one
    turn = np.where(step != 0, np.arange(n), n)
    turn = np.minimum.accumulate(turn[::-1])[::-1]
    smaller = step[turn] > 0
    direct = np.flatnonzero(smaller)
    rows = np.lib.stride_tricks.sliding_window_view(padded, depth)
    if len(direct):
        direct = direct[np.argsort(np.ascontiguousarray(rows[direct]).view(f"S{depth}").ravel(), kind="stable")]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    out, done = np.empty(n, np.int64), 0
    induced = np.flatnonzero(~smaller)
    induced = induced[np.argsort(data[induced], kind="stable")]
    cuts = np.searchsorted(data[induced], np.arange(257))
    sorted_cuts = np.searchsorted(data[direct], np.arange(257))

    def place(found: np.ndarray) -> None:
        nonlocal done
        rank[found] = np.arange(done, done + len(found))
        out[done : done + len(found)] = found
        done += len(found)

    for byte in range(256):
        bucket = induced[cuts[byte] : cuts[byte + 1]]
        if len(bucket):
            after = np.append(data, 0)[bucket + 1] if bucket[-1] == n - 1 else data[bucket + 1]
            run = (after == byte) & (bucket + 1 < n)
            wave = bucket[~run]
            wave = wave[np.argsort(rank[wave + 1], kind="stable")]
            while len(wave):  # one more equal byte in front, in the order just found
                place(wave)
                wave = wave[wave > 0] - 1
                wave = wave[(data[wave] == byte)]
        if sorted_cuts[byte] < sorted_cuts[byte + 1]:
            place(direct[sorted_cuts[byte] : sorted_cuts[byte + 1]])
    return out


def equal_groups(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Group numbers along ``order``: a new one wherever the adjacent common prefix is under ``length``."""
    rows = np.lib.stride_tricks.sliding_window_view(data, length)
    fresh = np.ones(len(order), bool)
    for first in range(1, len(order), 1 << 15):
        here = slice(first, min(first + (1 << 15), len(order)))
        before = slice(first - 1, here.stop - 1)
        common = rows[order[here]] == rows[order[before]]
        fresh[here] = ~common.all(axis=1)
    return np.cumsum(fresh)


def _later(group: np.ndarray, ids: np.ndarray, keys: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which windows have a first one of their group elsewhere."""
    by = np.lexsort((start, keys, ids, group))
    head = np.flatnonzero(np.append(True, np.diff(group[by]) != 0)) if len(by) else by
    first = by[np.repeat(head, np.diff(np.append(head, len(by))))]
    same = (ids[by] == ids[first]) & (keys[by] == keys[first]) & (start[by] == start[first])
    out = np.zeros(len(group), bool)
    out[by] = ~same
    return out


def _seed_batches(length: int, seed: int, full: bool):
    reach = length - seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in B.chunks(batch.column("text")):
                if len(texts.data) < length:
                    continue
                grams = B.gram_hashes(texts.data, seed, 1)
                starts = np.arange(len(texts.data) - length + 1)
                ends = texts.offsets[np.searchsorted(texts.offsets, starts, "right")]
                at = B.winnow(grams, reach + 1, starts + length <= ends)
                anchor = pa.array(B.signed(grams[at]))
                if not full:
                    yield pa.RecordBatch.from_arrays([anchor], names=["anchor"])
                    continue
                doc = np.searchsorted(texts.offsets, at, "right") - 1
                low = np.maximum(at - reach, texts.offsets[doc])
                high = np.minimum(at + length, texts.offsets[doc + 1])
                around = B.Rolling(texts.data, 2)(low, high) ^ B.mix((at - low).astype(B.U))
                rows = pa.array(texts.first + doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        anchor,
                        pa.array(B.signed(around)),
                        *[batch.column(k).take(rows) for k in KEY],
                        pa.array(at - texts.offsets[doc]),
                    ],
                    names=["anchor", "around", *KEY, "at"],
                )

    return run


_SEGMENTS = f"anchor long, {KEY_SCHEMA}, start long, n int, segment binary, crowded boolean, w1 long, w2 long"


def _segment_batches(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in B.chunks(batch.column("text")):
                lists = batch.column("places").slice(texts.first, len(texts.offsets) - 1)
                doc = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
                items = lists.flatten()
                base = texts.offsets[doc]
                at = items.field("at").to_numpy(zero_copy_only=False) + base
                crowded = items.field("crowded").to_numpy(zero_copy_only=False)
                grams = B.gram_hashes(texts.data, seed, 1)
                owner, start = B.chosen_by(grams, at, base, texts.offsets[doc + 1] - length, length - seed + 1)
                order = np.lexsort((start, owner))
                owner, start = owner[order], start[order]
                # a segment is all windows of a place, or those of one stride where its anchor is crowded
                stride = np.where(crowded[owner], (at[owner] - start) // STRIDE, 0)
                fresh = np.append(True, (np.diff(owner) != 0) | (np.diff(stride) != 0))[: len(owner)]
                head = np.flatnonzero(fresh)
                size = np.diff(np.append(head, len(owner)))
                who, begin = owner[head], start[head]
                raw = texts.data.tobytes()
                segments = [raw[b : b + n + length - 1] for b, n in zip(begin.tolist(), size.tolist())]
                rows = pa.array(texts.first + doc[who])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(B.signed(grams[at[who]])),
                        *[batch.column(k).take(rows) for k in KEY],
                        pa.array(begin - base[who]),
                        pa.array(size.astype(np.int32)),
                        pa.array(segments, pa.binary()),
                        pa.array(crowded[who]),
                        *[pa.array(B.signed(B.Rolling(texts.data, k)(begin, begin + size + length - 1))) for k in (2, 3)],
                    ],
                    names=["anchor", *KEY, "start", "n", "segment", "crowded", "w1", "w2"],
                )

    return run


def _alone_batches(length: int):
    """Every window of some segments by itself: its hashes and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in B.chunks(batch.column("segment")):
                size = batch.column("n").slice(texts.first, len(texts.offsets) - 1).to_numpy()
                owner = np.repeat(np.arange(len(size)), size)
                within = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
                low = texts.offsets[owner] + within
                rows = pa.array(texts.first + owner)
                start = batch.column("start").take(rows).to_numpy() + within
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array(B.signed(B.Rolling(texts.data, k)(low, low + length))) for k in (2, 3)],
                        *[batch.column(k).take(rows) for k in KEY],
                        pa.array(start),
                    ],
                    names=["w1", "w2", *KEY, "start"],
                )

    return run


def _repeats(part: pa.Table, length: int) -> pa.RecordBatch:
    """Later windows among whole anchors, by a suffix array over their segments."""
    segments = part.column("segment").combine_chunks().cast(pa.large_binary())
    texts = next(B.chunks(segments, 1 << 62))
    size = part.column("n").to_numpy()
    ids, begin = (part.column(k).to_numpy() for k in ("_id", "start"))
    key = part.column("_key").combine_chunks()
    keys = pc.rank(key, tiebreaker="dense").to_numpy()
    owner = np.repeat(np.arange(len(size)), size)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    window_at = np.full(len(texts.data), -1, np.int64)
    window_at[texts.offsets[:-1][owner] + within] = np.arange(len(owner))
    order = suffix_array(texts.data, length)
    order = order[window_at[order] >= 0]
    group = equal_groups(texts.data, order, length)
    window = window_at[order]
    start = begin[owner[window]] + within[window]
    home = owner[window]
    later = _later(group, ids[home], keys[home], start)
    home, start = home[later], start[later]
    by = np.lexsort((start, home))
    home, start = home[by], start[by]
    joined = (np.diff(home) == 0) & (np.diff(start) == 1)
    head = np.flatnonzero(np.append(True, ~joined)) if len(home) else home
    tail = np.append(head[1:], len(home)) - 1 if len(home) else home
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[home[head]]), key.take(pa.array(home[head])), pa.array(start[head]), pa.array(start[tail] + length)],
        names=[*KEY, "low", "high"],
    )


def _sorted_batches(length: int):
    """Over segments that come sorted by anchor: whole anchors, a bounded number of bytes at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                anchor = batch.column("anchor").to_numpy()
                room = np.cumsum(batch.column("n").to_numpy() + length - 1)
                used = sum(h.column("n").to_numpy().sum() + (length - 1) * h.num_rows for h in held)
                full = int(np.searchsorted(room, max(SORTED_BYTES - used, 0)))
                if full >= batch.num_rows:
                    held.append(batch)
                    break
                # the anchor at the boundary is taken whole
                last = held[-1].column("anchor")[-1].as_py() if held and full == 0 else anchor[max(full - 1, 0)]
                end = int(np.searchsorted(anchor, last, "right"))
                held.append(batch.slice(0, end))
                batch = batch.slice(end)
                if batch.num_rows:
                    yield _repeats(pa.Table.from_batches(held), length)
                    held = []
        if held:
            yield _repeats(pa.Table.from_batches(held), length)

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, seed: int = SEED, crowd: int = CROWD) -> DataFrame:
    """Byte ranges [low, high) of ``keyed`` documents covered by windows that also start earlier.

    Columns _id, _key, low, high; ranges may overlap. Earlier is a smaller id (null first), then,
    for different texts under one id, a smaller text key, then an earlier start. Copies of one row
    are one document here. Texts that are null or shorter than a window give none.
    """
    scratch = Scratch(docs.sparkSession)
    anchors = docs.select("text").mapInArrow(_seed_batches(length, seed, False), "anchor long")
    shared = scratch.keep(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"))
    seeds = docs.select(*KEY, "text").mapInArrow(
        _seed_batches(length, seed, True), f"anchor long, around long, {KEY_SCHEMA}, at long"
    )
    seeds = scratch.keep(seeds.join(shared, "anchor", "left_semi"))
    scratch.drop(shared)
    place = F.struct(*KEY, "at")
    classes = scratch.keep(
        seeds.groupBy("anchor", "around").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("place"))
    )
    many = classes.filter("copies > 1").select("anchor", "around", "place")
    whole = (
        seeds.join(many, ["anchor", "around"])
        .filter(place != F.col("place"))
        .select(
            *KEY,
            F.greatest(F.col("at") - (length - seed), F.lit(0)).alias("low"),
            (F.col("at") + length).alias("high"),
        )
    )
    mixed = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    places = (
        classes.join(mixed, "anchor")
        .select("place.*", (F.col("kinds") > crowd).alias("crowded"))
        .groupBy(*KEY)
        .agg(F.collect_set(F.struct("at", "crowded")).alias("places"))
    )
    segments = scratch.keep(
        docs.select(*KEY, "text").join(places, KEY).mapInArrow(_segment_batches(length, seed), _SEGMENTS)
    )
    few = segments.filter("NOT crowded").select("anchor", *KEY, "start", "n", "segment")
    sorted_out = (
        few.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
            _sorted_batches(length), f"{KEY_SCHEMA}, low long, high long"
        )
    )
    place = F.struct(*KEY, "start")

    def later(rows: DataFrame, kinds: DataFrame, n) -> DataFrame:
        """What the ``n`` windows from each place cover that is not the first of its kind."""
        kinds = kinds.filter("copies > 1").select("w1", "w2", "place")
        spans = rows.join(kinds, ["w1", "w2"]).filter(place != F.col("place"))
        return spans.select(*KEY, F.col("start").alias("low"), (F.col("start") + n + length - 1).alias("high"))

    count = F.count(F.lit(1)).alias("copies")
    strides = segments.filter("crowded").select("w1", "w2", *KEY, "start", "n", "segment")
    kinds = scratch.keep(
        strides.groupBy("w1", "w2").agg(count, F.min(F.struct(*KEY, "start", "n", "segment")).alias("first")).select(
            "w1", "w2", "copies", "first", F.struct(*[F.col(f"first.{c}") for c in (*KEY, "start")]).alias("place")
        )
    )
    alone = scratch.keep(
        kinds.select("first.*").mapInArrow(_alone_batches(length), f"w1 long, w2 long, {KEY_SCHEMA}, start long")
    )
    crowds = later(strides.drop("segment"), kinds, F.col("n")).unionByName(
        later(alone, alone.groupBy("w1", "w2").agg(count, F.min(place).alias("place")), F.lit(1))
    )
    return whole.unionByName(sorted_out).unionByName(crowds)


def _cut_batches(kept_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in B.chunks(batch.column("text")):
                lists = batch.column("spans").slice(texts.first, len(texts.offsets) - 1)
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(len(lists)), counts)
                low, high = (lists.flatten().field(k).to_numpy(zero_copy_only=False) for k in ("low", "high"))
                high = np.minimum(high + texts.offsets[doc], texts.offsets[doc + 1])
                gone = B.covered(len(texts.data), low + texts.offsets[doc], high)
                first = np.zeros(len(gone) + 1, bool)
                first[texts.offsets] = True
                begins = gone.copy()
                begins[1:] &= ~gone[:-1] | first[1:-1]
                n_gone, n_runs = (
                    np.diff(np.concatenate([[0], np.cumsum(x)])[texts.offsets]).astype(np.int64) for x in (gone, begins)
                )
                kept = []
                for i in range(len(lists)):
                    here = slice(texts.offsets[i], texts.offsets[i + 1])
                    kept.append((texts.data[here][~gone[here]] if n_gone[i] else texts.data[here]).tobytes())
                out = {
                    "doc_id": batch.column("doc_id").slice(texts.first, len(lists)),
                    "n_bytes": pa.array(np.diff(texts.offsets).astype(np.int64)),
                    "n_removed": pa.array(n_gone),
                    "n_spans": pa.array(n_runs),
                    "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                }
                if kept_bytes:
                    out["kept"] = pa.array(kept, pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    return run


def drop_repeats(
    docs: DataFrame, length: int = LENGTH, seed: int = SEED, crowd: int = CROWD, kept_bytes: bool = True
) -> DataFrame:
    """Every row of ``docs`` by doc_id, with n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, kept.

    A byte goes if a string of ``length`` bytes covers it that also starts earlier (``repeated_spans``
    says what is earlier); all are judged on the input. Kept bytes are joined; cuts may fall inside a
    character, so they are binary. A null text is empty; ids may be null or repeat, and rows with one id and text
    are copies of one document, which does not repeat itself by them. Texts may be of any length, other columns are
    ignored, whatever their names, and an empty table gives no rows.
    """
    docs = keyed(docs)
    spans = repeated_spans(docs, length, seed, crowd).groupBy(*KEY)
    spans = spans.agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    cut = docs.join(spans, KEY, "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return cut.mapInArrow(_cut_batches(kept_bytes), schema + ", kept binary" * kept_bytes)
