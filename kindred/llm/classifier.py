"""Quality classifier: document evidence with hierarchical empirical Bayes over hosts and paths.

A document's evidence is a logistic regression on the ``CHOSEN`` most telling of 65,536 hashed features:
its distinct words and a few shapes of its text. How telling a feature is follows from its counts over
all labelled documents; the regression is fitted on at most ``SAMPLE`` of them, taken by hash.

The share of good documents of a host is Beta-distributed around the global share, that of a path within
a host around the host's. Both strengths are estimated from the spread of the observed shares by the
method of moments, so a site with few labels keeps nearly its parent's share. The posterior mean of the
path moves the calibrated log odds of the document.

Features are computed once and written, 2 bytes each. Labels meet them by id; counts of buckets, hosts
and paths are grouped sums with a partial step. What the driver reads is bounded: one row for each bucket,
the sample's chosen features as bits, and the moments of each level.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm import bytesops as B
from kindred.llm.rules import SYMBOLS
from kindred.llm.tables import KEY, KEY_SCHEMA, Scratch, keyed

BUCKETS = 1 << 16
CHOSEN = 256
SAMPLE = 20_000  # labelled rows that the regression is fitted on
HOLD = 0.3  # squared weights are held down by half of this
KEEP = 0.5

_LOWER = np.arange(256, dtype=np.uint8) + 32 * B.table(spans=((0x41, 0x5A),)).astype(np.uint8)
_LETTER = B.table(spans=((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)))
_SHAPES = [B.table(*SYMBOLS.encode()), B.table(0x21), B.table(0x7C), B.table(spans=((0x41, 0x5A),)), B.table(spans=((0x30, 0x39),))]


class Model(NamedTuple):
    buckets: np.ndarray
    weights: np.ndarray
    offset: float
    share: float


def _features(texts: B.Texts) -> list[np.ndarray]:
    """Sorted distinct buckets of each text: words, and shares of marks and of repeated words by steps."""
    n = len(texts.offsets) - 1
    words = B.words(texts, _LETTER)
    lower = texts._replace(data=_LOWER[texts.data])
    bucket = (B.range_hashes(lower, words.start, words.end) >> B.U(48)).astype(np.int64)
    pairs = np.unique(words.doc * BUCKETS + bucket)
    doc, bucket = pairs // BUCKETS, pairs % BUCKETS
    cuts = np.searchsorted(doc, np.arange(n + 1))
    sizes = np.maximum(np.diff(texts.offsets), 1)
    shapes = [np.diff(np.concatenate([[0], np.cumsum(t[texts.data])])[texts.offsets]) / sizes for t in _SHAPES]
    shapes.append(np.diff(cuts) / np.maximum(np.diff(words.offsets), 1))
    steps = [np.ceil(np.log2(1 + 1000 * s)).astype(np.int64) + 32 * (k + 1) for k, s in enumerate(shapes)]
    hashed = (B.mix(np.stack(steps, axis=1).astype(B.U)) >> B.U(48)).astype(np.int64)
    return [np.unique(np.concatenate([bucket[cuts[i] : cuts[i + 1]], hashed[i]])) for i in range(n)]


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in B.chunks(batch.column("text")):
            found = [f.astype(np.uint16).tobytes() for f in _features(texts)]
            kept = [batch.column(k).slice(texts.first, len(found)) for k in ("doc_id", *KEY, "host", "path")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.binary())], names=["doc_id", *KEY, "host", "path", "features"])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Good and other labelled documents of each bucket, one row per bucket and task."""
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for features, good in zip(batch.column("features").to_pylist(), batch.column("good").to_pylist()):
            counts[int(good), np.frombuffer(features, np.uint16)] += 1
    at = np.flatnonzero(counts.sum(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(at.astype(np.int32)), pa.array(counts[1, at]), pa.array(counts[0, at])], names=["bucket", "good", "bad"]
    )


def _chosen(features: bytes, buckets: np.ndarray) -> np.ndarray:
    """Which of the sorted ``buckets`` are among the features."""
    found = np.frombuffer(features, np.uint16)
    if not len(buckets):
        return np.zeros(0, bool)
    at = np.minimum(np.searchsorted(buckets, found), len(buckets) - 1)
    out = np.zeros(len(buckets), bool)
    out[at[buckets[at] == found]] = True
    return out


def _bit_batches(buckets: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(_chosen(f, buckets)).tobytes() for f in batch.column("features").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(bits, pa.binary()), batch.column("good"), batch.column("turn")], names=["bits", "good", "turn"])

    return run


def _score_batches(model: Model, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("features").to_pylist()
            scores = [model.offset + float(model.weights[_chosen(f, model.buckets)].sum()) for f in lists]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array(scores, pa.float64())], names=[*keep, "evidence"])

    return run


def featurise(docs: DataFrame, scratch: Scratch, host: Column | None = None, path: Column | None = None) -> DataFrame:
    """doc_id, _id, _key, host, path and features of every row of ``docs`` (doc_id, text and, by default, source, lang).

    By default the host is the source up to a slash, and the path the part up to the next slash, or the
    language where there is none. Null parts count as empty.
    """
    host = F.substring_index("source", "/", 1) if host is None else host
    path = F.coalesce(F.nullif(F.split_part("source", F.lit("/"), F.lit(2)), F.lit("")), F.col("lang")) if path is None else path
    sited = docs.select("doc_id", "text", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    read = keyed(sited.select("doc_id", "text", "host", "path"), "host", "path")
    schema = f"doc_id long, {KEY_SCHEMA}, host string, path string, features binary"
    return scratch.keep(read.mapInArrow(_feature_batches, schema))


def labelled(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features with ``good``: quality 1 and not toxic in all labels of the id; null qualities do not count."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(good.cast("int")).alias("good"))
    return features.join(known, "doc_id")


def _logistic(x: np.ndarray, good: np.ndarray, hold: float) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic regression, by Newton steps halved until the fit improves."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    held = np.append(np.full(x.shape[1] - 1, hold), 1e-3)
    at = np.zeros(x.shape[1])

    def loss(at: np.ndarray) -> float:
        odds = x @ at
        return float(np.logaddexp(0, np.where(good, -odds, odds)).sum() + held @ at**2 / 2)

    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -50, 50)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(held)
        step, size = np.linalg.solve(curve, x.T @ (good - p) - held * at), 1.0
        while size > 1e-6 and loss(at + size * step) > loss(at):
            size /= 2
        at = at + size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return at[:-1], float(at[-1])


def fit(train: DataFrame, chosen: int = CHOSEN, sample: int = SAMPLE, hold: float = HOLD) -> Model:
    """The regression from rows with _id, _key, features and ``good``; without rows, all weights are 0."""
    counts = np.zeros((BUCKETS, 2))
    partial = train.select("features", "good").mapInArrow(_count_batches, "bucket int, good long, bad long")
    for row in partial.groupBy("bucket").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect():
        counts[row.bucket] = row.good, row.bad
    total = train.agg(F.count(F.lit(1)), F.sum("good")).first()
    n, n_good = total[0], total[1] or 0
    # how far the bad documents of a bucket are from what its size lets expect, in standard deviations
    share, seen = (n - n_good) / max(n, 1), counts.sum(axis=1)
    apart = np.abs(counts[:, 1] - seen * share) / np.sqrt(np.maximum(seen * share * (1 - share), 1e-9))
    apart[seen == 0] = 0
    buckets = np.sort(np.argsort(-apart, kind="stable")[:chosen])
    buckets = buckets[apart[buckets] > 0]
    if 0 < n_good < n:
        order = (F.conv(F.hex(F.substring("_key", 1, 4)), 16, 10).cast("long") - (1 << 31)).cast("int")
        turned = train.select("features", "good", F.xxhash64("_id", order).alias("turn"))
        bits = turned.mapInArrow(_bit_batches(buckets), "bits binary, good int, turn long")
        rows = _first(bits, n, sample).collect()
        x = np.unpackbits(np.frombuffer(b"".join(r.bits for r in rows), np.uint8).reshape(len(rows), -1), axis=1)
        weights, offset = _logistic(x[:, : len(buckets)].astype(float), np.array([r.good for r in rows], bool), hold)
    else:
        weights, offset = np.zeros(len(buckets)), float(np.log((n_good + 1) / (n - n_good + 1)))
    return Model(buckets, weights, offset, (n_good + 1) / (n + 2))


def _first(bits: DataFrame, n: int, sample: int) -> DataFrame:
    """The ``sample`` rows of ``bits`` (n rows) with the smallest turns, written, so that the driver reads no more.

    Turns are hashes, so those below a threshold hold the sample and little else; it rises until they do.
    """
    scratch, share = Scratch(bits.sparkSession), (sample + 8 * sample**0.5 + 100) / n
    while True:
        likely = bits if share >= 1 else bits.filter(F.col("turn") < int(share * 2.0**64) - (1 << 63))
        rows = scratch.keep(likely.orderBy("turn", "bits", "good").limit(sample))
        if share >= 1 or rows.count() == sample:
            return rows
        scratch.drop(rows)
        share *= 4


def _strength(groups: DataFrame, mean: Column) -> float:
    """Beta strength of shares (good, n) around ``mean`` by moments: how far they spread beyond chance.

    With s the sum of n (share - mean)^2 and v the sum of mean (1 - mean), chance alone gives s = v.
    """
    r = groups.agg(
        F.sum(F.col("n") * (F.col("good") / F.col("n") - mean) ** 2).alias("s"),
        F.sum(mean * (1 - mean)).alias("v"),
        F.sum(F.col("n") * mean * (1 - mean)).alias("w"),
    ).first()
    if not r.v or r.s <= r.v or r.w <= r.v:
        return 1e6
    between = (r.s - r.v) / (r.w - r.v)  # 1 / (strength + 1)
    return float(min(max(1 / between - 1, 1.0), 1e6))


def site_posteriors(train: DataFrame, share: float) -> tuple[DataFrame, DataFrame]:
    """Posterior shares of hosts (host, host_share) and of paths (host, path, site_share)."""
    counted = [F.sum("good").alias("good"), F.count(F.lit(1)).alias("n")]
    paths = train.groupBy("host", "path").agg(*counted)
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    k = _strength(hosts, F.lit(share))
    hosts = hosts.select("host", ((F.col("good") + k * share) / (F.col("n") + k)).alias("host_share"))
    within = paths.join(hosts, "host")
    j = _strength(within, F.col("host_share"))
    site = (F.col("good") + j * F.col("host_share")) / (F.col("n") + j)
    return hosts, within.select("host", "path", site.alias("site_share"))


def classify(
    docs: DataFrame, labels: DataFrame, keep: float = KEEP, host: Column | None = None, path: Column | None = None
) -> DataFrame:
    """Every row of ``docs`` by doc_id (and _id, _key) with its evidence, its site's share, p_good and kept.

    Fitted on all rows of ``labels`` (doc_id, quality, toxic) whose document is there. Texts that are null
    or empty have no words; their evidence is that of their shape. Ids may be null or repeat; rows of one id share
    its label. Texts may be of any length and other columns are ignored, whatever their names. Without
    labels every share is a half and everything is kept; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    features = featurise(docs, scratch, host, path)
    train = scratch.keep(labelled(features, labels).select(*KEY, "host", "path", "features", "good"))
    model = fit(train)
    hosts, sites = site_posteriors(train, model.share)
    columns = ["doc_id", *KEY, "host", "path"]
    scored = features.mapInArrow(
        _score_batches(model, columns), f"doc_id long, {KEY_SCHEMA}, host string, path string, evidence double"
    )
    share = F.coalesce("site_share", "host_share", F.lit(model.share))
    odds = F.col("evidence") + F.log(share / (1 - share)) - float(np.log(model.share / (1 - model.share)))
    return (
        scored.join(hosts, "host", "left")
        .join(sites, ["host", "path"], "left")
        .select(
            "doc_id",
            *KEY,
            F.round("evidence", 6).alias("evidence"),
            F.round(share, 6).alias("site_share"),
            F.round(1 / (1 + F.exp(-odds)), 6).alias("p_good"),
        )
        .withColumn("kept", F.col("p_good") >= keep)
    )
