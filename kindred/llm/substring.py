"""Substring dedup by seed and extend.

Seeds are winnowed anchors: of every ``WINDOW`` consecutive words, the run of ``SEED`` words with the
smallest hash. Equal windows choose equal anchors, so documents are joined on anchors only, a
fourteenth of all places. A match is then extended both ways as far as a window can reach:

* occurrences of an anchor with equal words on both sides, all a window can hold, are one class. In a
  class of two or more every window across the anchor is repeated, so none is looked at again;
* an anchor with several classes is extended from one occurrence of each: the windows that chose the
  anchor are compared by two 64-bit hashes.

Classes, not occurrences, are compared, so copies are never paired. A passage in many documents gives
one class for its inside and, near its ends, one row per document and window. All grouping has a
partial step; the joins back are equality joins, which adaptive execution splits where skewed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import bytesops as B
from kindred.llm.tables import KEY, KEY_SCHEMA, Scratch, keyed

WINDOW = 35
SEED = 10


def _word_values(texts: B.Texts, words: B.Words, which: int) -> np.ndarray:
    return B.range_hashes(texts, words.start, words.end, which)


def _keys(batch: pa.RecordBatch, rows: np.ndarray) -> list[pa.Array]:
    rows = pa.array(rows)
    return [batch.column(k).take(rows) for k in KEY]


def _seed_batches(window: int, seed: int, full: bool):
    reach = window - seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in B.chunks(batch.column("text")):
                words = B.words(texts, ~B.BLANK)
                if len(words.start) < window:
                    continue
                values = _word_values(texts, words, 0)
                grams = B.gram_hashes(values, seed, 1)
                whole = words.doc[: len(values) - window + 1] == words.doc[window - 1 :]
                at = B.winnow(grams, reach + 1, whole)
                anchor = pa.array(B.signed(grams[at]))
                if not full:
                    yield pa.RecordBatch.from_arrays([anchor], names=["anchor"])
                    continue
                doc = words.doc[at]
                low = np.maximum(at - reach, words.offsets[doc])
                high = np.minimum(at + window, words.offsets[doc + 1])
                around = B.Rolling(values, 2)(low, high) ^ B.mix((at - low).astype(B.U))
                yield pa.RecordBatch.from_arrays(
                    [
                        anchor,
                        pa.array(B.signed(around)),
                        *_keys(batch, texts.first + doc),
                        pa.array((at - words.offsets[doc]).astype(np.int32)),
                    ],
                    names=["anchor", "around", *KEY, "at"],
                )

    return run


def _window_batches(window: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("places")
            for texts in B.chunks(batch.column("text")):
                words = B.words(texts, ~B.BLANK)
                one, two = (_word_values(texts, words, w) for w in (0, 3))
                grams = B.gram_hashes(one, seed, 1)
                lists = places.slice(texts.first, len(texts.offsets) - 1)
                doc = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
                at = lists.flatten().to_numpy(zero_copy_only=False) + words.offsets[doc]
                low, high = words.offsets[doc], words.offsets[doc + 1] - window
                owner, start = B.chosen_by(grams, at, low, high, window - seed + 1)
                home = doc[owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(B.signed(B.Rolling(one, 2)(start, start + window))),
                        pa.array(B.signed(B.Rolling(two, 3)(start, start + window))),
                        *_keys(batch, texts.first + home),
                        pa.array((start - words.offsets[home]).astype(np.int32)),
                    ],
                    names=["w1", "w2", *KEY, "low"],
                )

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Word ranges [low, high) of ``keyed`` documents that repeated windows cover, as _id, _key, low, high.

    Ranges may overlap. Texts that are null, empty or shorter than a window give none. A row that
    stands twice repeats itself, and so all its windows.
    """
    scratch = Scratch(docs.sparkSession)
    anchors = docs.select("text").mapInArrow(_seed_batches(window, seed, False), "anchor long")
    shared = scratch.keep(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"))
    seeds = docs.select(*KEY, "text").mapInArrow(
        _seed_batches(window, seed, True), f"anchor long, around long, {KEY_SCHEMA}, at int"
    )
    seeds = scratch.keep(seeds.join(shared, "anchor", "left_semi"))
    scratch.drop(shared)
    classes = scratch.keep(
        seeds.groupBy("anchor", "around").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct(*KEY, "at")).alias("place")
        )
    )
    # a class of two or more is repeated as far as a window reaches, which follows from the place alone
    many = classes.filter("copies > 1").select("anchor", "around")
    whole = seeds.join(many, ["anchor", "around"], "left_semi").select(
        *KEY,
        F.greatest(F.col("at") - (window - seed), F.lit(0)).alias("low"),
        (F.col("at") + window).alias("high"),
    )
    mixed = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("anchor")
    places = classes.join(mixed, "anchor", "left_semi").select("place.*")
    places = places.groupBy(*KEY).agg(F.collect_set("at").alias("places"))
    windows = scratch.keep(
        docs.select(*KEY, "text")
        .join(places, KEY)
        .mapInArrow(_window_batches(window, seed), f"w1 long, w2 long, {KEY_SCHEMA}, low int")
    )
    again = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w1", "w2")
    found = windows.join(again, ["w1", "w2"], "left_semi")
    return whole.unionByName(found.select(*KEY, "low", (F.col("low") + window).alias("high")))


def _cut_batches(kept_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in B.chunks(batch.column("text")):
                words = B.words(texts, ~B.BLANK)
                lists = batch.column("spans").slice(texts.first, len(texts.offsets) - 1)
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(len(lists)), counts)
                low, high = (lists.flatten().field(k).to_numpy(zero_copy_only=False) for k in ("low", "high"))
                high = np.minimum(high + words.offsets[doc], words.offsets[doc + 1])
                gone = B.covered(len(words.start), low + words.offsets[doc], high)
                before = np.concatenate([[0], np.cumsum(gone)])[words.offsets]
                raw, kept = texts.data.tobytes(), []
                for i in range(len(lists)):
                    keep = np.flatnonzero(~gone[words.offsets[i] : words.offsets[i + 1]]) + words.offsets[i]
                    ranges = zip(words.start[keep].tolist(), words.end[keep].tolist())
                    kept.append(b" ".join([raw[a:b] for a, b in ranges]))
                out = {
                    "doc_id": batch.column("doc_id").slice(texts.first, len(lists)),
                    "n_words": pa.array(np.diff(words.offsets).astype(np.int64)),
                    "n_removed": pa.array(np.diff(before).astype(np.int64)),
                    "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                }
                if kept_text:
                    out |= {k: batch.column(k).slice(texts.first, len(lists)) for k in KEY}
                    out["kept"] = pa.array(kept, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_pydict(out)

    return run


def drop_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, kept_text: bool = True) -> DataFrame:
    """Every row of ``docs`` by doc_id, with n_words, n_removed, kept_sha256 and, if wanted, the kept words.

    Words are runs of anything but blanks. A word goes if a window of ``window`` words covers it that
    also starts elsewhere, in any row or in the same one; all are judged on the input. Kept words are
    joined by one space. A null text has no words; ids may be null or repeat, and a repeated row is an occurrence of
    its own, so all its windows go. Texts may be of any length, other columns are ignored, whatever their names, and
    an empty table gives no rows.
    With ``kept_text`` the columns _id, _key (of the input row) and kept are added.
    """
    docs = keyed(docs)
    spans = repeated_spans(docs, window, seed).groupBy(*KEY).agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    cut = docs.join(spans, KEY, "left").select("doc_id", *KEY, "text", "spans")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return cut.mapInArrow(_cut_batches(kept_text), schema + f", {KEY_SCHEMA}, kept string" * kept_text)
