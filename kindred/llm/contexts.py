"""Language-model scoring by context-tree weighting over bytes.

A text is its bytes with A-Z lower-cased and an end mark. Every byte is eight binary choices, the high bit first, and
each of the 255 nodes of that choice tree has a tree of contexts: the bytes before, the last one at the root's
children, down to ``DEPTH`` of them. A context with ``a`` zeros and ``b`` ones in the training texts has the
Krichevsky-Trofimov probability ``Pe = G(a + 1/2) G(b + 1/2) / (pi G(a + b + 1))``, and the weighted one
``Pw = Pe / 2 + (product of the children's Pw) / 2``, at full depth ``Pw = Pe``. What a context stops at with is
``Pe / 2 / Pw``, so a bit's probability is the mixture of the estimates of all depths along its context. A context
without training bits has no say; the next shorter one speaks for it.

How it runs: texts are dealt into chunks of ``CHUNK`` bytes. Each chunk asks once for every distinct context with its
next byte (a gram) and for every distinct word, and says how often they stand in its training texts. Counts are summed over
all chunks; ``Pw`` is computed from the leaves up in groups of grams that share the last two bytes; the two levels
above, at most 256 x 256 numbers, are summed up by the driver. The answers are joined back to the chunks that asked.
So every table grows with the distinct grams of a chunk and not with its bytes, no text is cut, and nothing that grows
with the corpus is broadcast or read by the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm import bytesops as B
from kindred.llm.tables import Scratch

DEPTH = 4
CHUNK = 8 << 20
PIECE = 1 << 19  # bytes of a chunk that are handled at once
SHARDS = 256  # groups of contexts at least, and
SHARD_GRAMS = 200_000  # grams in one on average at most
TOP = 2  # bytes of context that grams of one group share
MARK = 0xFF  # before and after a text; no byte of UTF-8
_LOWER = np.arange(256, dtype=np.uint8) + 32 * B.table(spans=((0x41, 0x5A),)).astype(np.uint8)
_HALF = math.log(0.5)
_ASKED = "chunk long, gram long, word binary, n long"


class Top(NamedTuple):
    """Probability of a 1, weight of stopping and count at each choice node, at the root and below each last byte."""

    one: np.ndarray
    stop: np.ndarray
    seen: np.ndarray


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x > 0, by Stirling's series eight places further up."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a zeros and b ones in any order."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - math.log(math.pi)


def _weigh(pe: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log Pw of a node with children, and the weight of stopping there."""
    pw = _HALF + np.logaddexp(pe, below)
    return pw, np.exp(np.minimum(_HALF + pe - pw, 0.0))


def grams(texts: B.Texts, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Every byte and end mark with the ``depth`` bytes before it, the last of them first, and the text it is in."""
    n = len(texts.offsets) - 1
    sizes, pad = np.diff(texts.offsets), depth + 1
    out = np.full(len(texts.data) + n * pad, MARK, np.uint8)
    told = np.ones(len(out), bool)
    told[((texts.offsets[:-1] + pad * np.arange(n))[:, None] + np.arange(depth)).ravel()] = False
    inside = told.copy()
    inside[texts.offsets[1:] + pad * np.arange(1, n + 1) - 1] = False
    out[inside] = _LOWER[texts.data]
    wide = out.astype(np.int64)
    keys = wide.copy()
    for back in range(1, pad):
        keys[back:] |= wide[:-back] << (8 * (pad - back))
    return keys[told], np.repeat(np.arange(n), sizes + 1)


def _words(texts: B.Texts) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of lower-cased texts as a dictionary, and the text of each."""
    inside = ~B.BLANK
    found = B.words(texts, inside)
    data = _LOWER[texts.data[inside[texts.data]]]
    offsets = np.append(0, np.cumsum(found.end - found.start)).astype(np.int32)
    array = pa.Array.from_buffers(pa.binary(), len(found.start), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return array.dictionary_encode(), found.doc.astype(np.int32)


def _release() -> None:
    """Give free memory back: other workers of the executor come next."""
    pa.default_memory_pool().release_unused()


def _deal_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number, filled = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            text = batch.column("text").fill_null(b"")
            at = np.empty(batch.num_rows, np.int64)
            for i, n in enumerate(pc.binary_length(text).to_pylist()):
                if filled and filled + n > size:
                    number, filled = number + 1, 0
                at[i] = base + number
                filled += n + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), text, pa.array(at)], names=["doc_id", "held_out", "text", "chunk"]
            )

    return run


def _ask_batches(depth: int):
    """Distinct grams and words of each chunk with their numbers in training texts."""
    schema = pa.schema([("chunk", pa.int64()), ("gram", pa.int64()), ("word", pa.binary()), ("n", pa.int64())])

    def asked(chunk: int, found: list, words: list) -> Iterator[pa.RecordBatch]:
        keys, place = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
        n = np.bincount(place, np.concatenate([c for _, c in found])).astype(np.int64)
        nothing = pa.nulls(len(keys), pa.binary())
        columns = [pa.array(np.full(len(keys), chunk)), pa.array(keys), nothing, pa.array(n)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)
        for t in pa.concat_tables(words).group_by("word").aggregate([("n", "sum")]).to_batches(1 << 16):
            m = t.num_rows
            columns = [pa.array(np.full(m, chunk)), pa.nulls(m, pa.int64()), t.column("word"), t.column("n_sum")]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, found, words = None, [], []
        for batch in batches:
            chunks = batch.column("chunk").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), len(chunks)]
            for low, high in zip(cuts, cuts[1:]):
                if high == low:
                    continue
                if current is not None and chunks[low] != current:
                    yield from asked(current, found, words)
                    found, words = [], []
                current = int(chunks[low])
                held = batch.column("held_out").slice(low, high - low).to_numpy(zero_copy_only=False)
                for texts in B.chunks(batch.column("text").slice(low, high - low), PIECE):
                    out = held[texts.first : texts.first + len(texts.offsets) - 1]
                    keys, doc = grams(texts, depth)
                    both, n = np.unique(keys << 1 | out[doc], return_counts=True)
                    found.append((both >> 1, np.where(both & 1, 0, n)))
                    coded, doc = _words(texts)
                    n = np.bincount(coded.indices.to_numpy(), ~out[doc], len(coded.dictionary)).astype(np.int64)
                    words.append(pa.table({"word": coded.dictionary, "n": n}))
                if len(found) > 16:  # so that a chunk holds its distinct grams only
                    keys, place = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                    found = [(keys, np.bincount(place, np.concatenate([c for _, c in found])).astype(np.int64))]
        if current is not None:
            yield from asked(current, found, words)
        _release()

    return run


def weigh_grams(keys: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From the leaves up to contexts of ``TOP`` bytes, for sorted grams that are all there is below these.

    Gives each gram's eight probabilities as its context of ``TOP`` bytes sees them (NaN without training bits there),
    and the logarithm of ``Pw`` summed by last byte and choice node.
    """
    rows, n = keys, counts.astype(float)
    to_row = np.arange(len(keys))
    p = np.zeros((len(keys), 8))
    above: list[tuple] = []
    for d in range(depth, TOP - 1, -1):
        if d < depth:
            rows, up = np.unique((rows >> 16 << 8) | (rows & 255), return_inverse=True)
            n = np.bincount(up, n, len(rows))
            to_row = up[to_row]
        now = []
        for k in range(8):
            prefix = rows >> (8 - k)
            fresh = np.diff(prefix, prepend=-1) != 0
            first, node = np.flatnonzero(fresh), np.cumsum(fresh) - 1
            bit = (rows >> (7 - k)) & 1
            ones = np.bincount(node, n * bit, len(first))
            total = np.bincount(node, n, len(first))
            pe = log_kt(total - ones, ones)
            here = node[to_row]
            kt = (np.where(bit == 1, ones[node], (total - ones)[node]) + 0.5)[to_row] / (total[here] + 1)
            if d == depth:
                pw, stop = pe, np.ones(len(first))
                p[:, k] = kt
            else:
                their_first, their_pw, seen = above[k]
                pw, stop = _weigh(pe, np.bincount(node[up[their_first]], their_pw, len(first)))
                p[:, k] = np.where(seen, stop[here] * kt + (1 - stop[here]) * p[:, k], kt)
            now.append((first, pw, total[here] > 0))
            if d == TOP:
                p[~now[k][2], k] = np.nan
        above = now
    at, sums = [], []
    for k, (first, pw, _) in enumerate(above):
        r = rows[first]
        at.append(((r >> (8 * TOP)) << 8) | (1 << k) | ((r & 255) >> (8 - k)))
        sums.append(pw)
    nodes, place = np.unique(np.concatenate(at), return_inverse=True)
    return p, nodes, np.bincount(place, np.concatenate(sums))


def _weigh_table(depth: int):
    def run(table: pa.Table) -> pa.Table:
        keys, counts = (table.column(c).to_numpy() for c in ("gram", "n"))
        order = np.argsort(keys)
        p, nodes, sums = weigh_grams(keys[order], counts[order], depth)
        gram = pa.concat_arrays([pa.array(keys[order]), pa.nulls(len(nodes), pa.int64())])
        bits = pa.array([row.tobytes() for row in p] + [None] * len(nodes), pa.binary())
        node = pa.concat_arrays([pa.nulls(len(keys), pa.int64()), pa.array(nodes)])
        weight = pa.concat_arrays([pa.nulls(len(keys), pa.float64()), pa.array(sums)])
        return pa.table({"gram": gram, "p": bits, "node": node, "weight": weight})

    return run


def top_levels(counts: np.ndarray, below: np.ndarray) -> tuple[Top, Top]:
    """The root and the contexts of one byte: from counts[last byte, next byte] and the sums of log Pw below them."""

    def level(counts: np.ndarray, below: np.ndarray) -> tuple[Top, np.ndarray]:
        one, stop, seen, pw = (np.zeros((len(counts), 256)) for _ in range(4))
        for k in range(8):
            here = slice(1 << k, 2 << k)
            halves = counts.reshape(len(counts), 2 << k, -1).sum(axis=2)
            a, b = halves[:, 0::2], halves[:, 1::2]
            one[:, here], seen[:, here] = (b + 0.5) / (a + b + 1), a + b
            pw[:, here], stop[:, here] = _weigh(log_kt(a, b), below[:, here])
        return Top(one, stop, seen), pw

    last, pw = level(counts, below)
    root, _ = level(counts.sum(axis=0, keepdims=True), pw.sum(axis=0, keepdims=True))
    return root, last


def log10_grams(keys: np.ndarray, p: np.ndarray, depth: int, root: Top, last: Top) -> np.ndarray:
    """log10 of the probability of each gram's byte after its context."""
    byte, before = keys & 255, keys >> (8 * depth)
    total = np.zeros(len(keys))
    for k in range(8):
        node, bit = (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1

        def estimate(top: Top, row) -> np.ndarray:
            return np.where(bit == 1, top.one[row, node], 1 - top.one[row, node])

        first, second = estimate(root, 0), estimate(last, before)
        stop = last.stop[before, node]
        deep = np.where(np.isnan(p[:, k]), second, stop * second + (1 - stop) * p[:, k])
        stop = root.stop[0, node]
        total += np.log10(np.where(last.seen[before, node] > 0, stop * first + (1 - stop) * deep, first))
    return total


def _answer_batches(depth: int, root: Top, last: Top):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = batch.column("gram").to_numpy()
                p = np.frombuffer(b"".join(batch.column("p").to_pylist())).reshape(-1, 8)
                found = pa.array(log10_grams(keys, p, depth, root, last))
                yield pa.RecordBatch.from_arrays([batch.column("gram"), found], names=["gram", "value"])

    return run


def _score_table(depth: int, train_tokens: int, distinct: int, ends: int):
    base = math.log10(train_tokens + distinct + 1)

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        known = answers.filter(pc.is_valid(answers.column("gram")))
        keys, values = known.column("gram").combine_chunks(), known.column("value").to_numpy()
        known = answers.filter(pc.is_valid(answers.column("word")))
        vocabulary, numbers = known.column("word").combine_chunks(), known.column("n").to_numpy()
        pieces = [(batch, texts, *_words(texts)) for batch in docs.to_batches() for texts in B.chunks(batch.column("text"), PIECE)]
        # all words are looked up at once, as every lookup hashes the vocabulary anew
        place = pc.index_in(pa.concat_arrays([coded.dictionary for *_, coded, _ in pieces]), vocabulary)
        counts, at = numbers[place.to_numpy()], 0
        parts: list[pa.Table] = []
        for batch, texts, coded, doc in pieces:
            n = len(texts.offsets) - 1
            c = counts[at + coded.indices.to_numpy()]
            at += len(coded.dictionary)
            tokens = np.bincount(doc, minlength=n) + 1
            logs = np.bincount(doc, np.log10(c + 1.0), n) + math.log10(ends + 1) - tokens * base
            n_known = np.bincount(doc, c > 0, n).astype(np.int64) + (ends > 0)
            asked, doc = grams(texts, depth)
            score = np.bincount(doc, values[pc.index_in(pa.array(asked), keys).to_numpy()], n)
            kept = [batch.column(x).slice(texts.first, n) for x in ("doc_id", "held_out")]
            columns = [tokens, n_known, np.full(n, train_tokens), logs, score, np.diff(texts.offsets)]
            names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"]
            parts.append(pa.table([*kept, *map(pa.array, columns)], names=names))
        _release()
        return pa.concat_tables(parts)

    return run


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text leaves 2 modulo 7; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def score(docs: DataFrame, held: Column | None = None, depth: int = DEPTH, chunk: int = CHUNK) -> DataFrame:
    """Scores of all rows of ``docs`` (doc_id, text), learned from those that ``held`` (:func:`held_out`) does not keep out.

    doc_id, held_out, n_tokens (words and one end), n_known (those in training), train_tokens, base_score (unigrams
    with one added to each count), score (log10 of the probability of the bytes and the end mark), n_bytes and
    bits_per_byte, the code length by bytes and end mark. A null text is empty. Ids may repeat or be null; every row is
    a text of its own, learned from as often as it stands there. Texts of any length are whole. No training texts
    leave each bit at a half; an empty table gives no rows. Other columns are ignored, whatever their names.
    """
    if depth < TOP or depth > 6:
        raise ValueError(f"depth is {depth}, not from {TOP} to 6")
    scratch = Scratch(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"), (held_out(doc_id) if held is None else held).alias("held_out"), F.col("text").cast("string").cast("binary").alias("text")
    )
    dealt = scratch.keep(rows.mapInArrow(_deal_batches(chunk), "doc_id long, held_out boolean, text binary, chunk long"), compression="zstd")
    asked = scratch.keep(dealt.select("chunk", "held_out", "text").mapInArrow(_ask_batches(depth), _ASKED))

    by_word = Window.partitionBy("word")
    words = asked.filter("word IS NOT NULL").select("chunk", "word", "n")
    words = words.select(
        "chunk", "word", F.sum("n").over(by_word).alias("n"), F.col("n").alias("mine"), F.row_number().over(by_word.orderBy("chunk")).alias("copy")
    )
    words = scratch.keep(words)
    first = F.sum(((F.col("copy") == 1) & (F.col("n") > 0)).cast("long"))
    counted = words.agg(F.sum("mine"), first).first()
    ends = dealt.filter("NOT held_out").count()
    train_tokens, distinct = (counted[0] or 0) + ends, (counted[1] or 0) + (ends > 0)

    wanted = asked.filter("gram IS NOT NULL").select("chunk", "gram", "n")
    totals = scratch.keep(wanted.groupBy("gram").agg(F.sum("n").alias("n")))
    before, shards = F.shiftright("gram", 8 * (depth - 1)), max(SHARDS, totals.count() // SHARD_GRAMS)  # the last two bytes
    weighed = totals.withColumn("shard", F.pmod(F.hash(before), F.lit(shards))).groupBy("shard")
    weighed = scratch.keep(weighed.applyInArrow(_weigh_table(depth), "gram long, p binary, node long, weight double"))
    counts, below = np.zeros((256, 256)), np.zeros((256, 256))
    pair = (F.shiftright("gram", 8 * depth) * 256 + F.col("gram").bitwiseAND(255)).alias("pair")
    for r in totals.groupBy(pair).agg(F.sum("n").alias("n")).collect():  # at most 65,536 rows, as below
        counts[r.pair >> 8, r.pair & 255] = r.n
    for r in weighed.filter("node IS NOT NULL").groupBy("node").agg(F.sum("weight").alias("w")).collect():
        below[r.node >> 8, r.node & 255] = r.w
    root, last = top_levels(counts, below)
    known = weighed.filter("gram IS NOT NULL").select("gram", "p").mapInArrow(_answer_batches(depth, root, last), "gram long, value double")
    nothing = {"word": F.lit(None).cast("binary"), "n": F.lit(None).cast("long")}
    answers = wanted.join(known, "gram").select("chunk", "gram", "value").withColumns(nothing)
    nothing = {"gram": F.lit(None).cast("long"), "value": F.lit(None).cast("double")}
    answers = scratch.keep(answers.unionByName(words.select("chunk", "word", "n").withColumns(nothing)))
    scratch.drop(asked, words, totals, weighed)

    found = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score_table(depth, train_tokens, distinct, ends),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long",
    )
    bits = -F.col("score") * math.log2(10) / (F.col("n_bytes") + 1)
    return found.withColumn("bits_per_byte", bits)
