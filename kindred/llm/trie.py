"""Prefix trie of conversations by whole-sequence collapse.

Every conversation is rebuilt from the first turns of another one and its own later turns. A node of the trie is
a distinct sequence of first turns. The trie is never walked:

1. identical rebuilt conversations are grouped into one weighted sequence, with the list of those that end there;
2. a sequence that is a proper prefix of another is found by an anti join against all proper prefixes; what is
   left over are the leaves;
3. the prefixes of the weighted sequences are aggregated. A prefix is known by its depth and the exclusive or of
   128 bits of SHA-256 of (turn, depth), which a running sum of any two stretches of a conversation gives.

The tokens that a subtree shares are ``sum((n_convs - 1) * length)`` over its nodes. The first part is what all
weighted sequences have after the prefix. For the second each node counts once: it belongs to the smallest leaf
sequence below it, and those of one leaf are all nodes from some depth on, so the tail that it owns is known by
the tokens before it.

Turns are numbered by value ranges, and running sums go by blocks of ``BLOCK`` turns, so a conversation that holds
a third of all rows is spread over many tasks; a first turn that a third of all conversations share is one group of
an aggregate with a partial step, and its children fetch their parent by a spread join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.tables import Scratch
from kindred.operators.skew import count_by, spread_join

EVERY = 100
HEADS = 6
BLOCK = 1024  # turns of one conversation in a task
IDS = 4096  # ids of one end list in a row
CHUNK = 1_000  # children of one node in a task
NODE = ["depth", "x", "y"]


class Trie(NamedTuple):
    """nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and the key x, y;
    ends: conv_id and the key (depth, x, y) of the node where it ends; turns: conv_id, depth, role, text as rebuilt.
    """

    nodes: DataFrame
    ends: DataFrame
    turns: DataFrame


def _numbered(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, part, p in part, role, text) and counts (conv_id, part, n) by ranges of the turns' order."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).filter(F.col("conv_id").isNotNull())
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    ranged = turns.withColumn("_n", F.monotonically_increasing_id()).repartitionByRange("conv_id", *order, "_n")
    placed = scratch.keep(ranged.drop("_n").withColumn("part", F.spark_partition_id()))
    place = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    return placed.withColumn("p", place), count_by(placed, "conv_id", "part")


def rebuild(conversations: DataFrame, scratch: Scratch, every: int = EVERY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, depth from 1, role, text) and all conv_ids."""
    numbered, counts = _numbered(conversations, scratch)
    counts = scratch.keep(counts)
    h = F.crc32(F.col("conv_id").cast("string")) % heads
    totals = counts.groupBy("conv_id").agg(F.sum("n").alias("n"))
    convs = totals.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    held = totals.select(F.col("conv_id").alias("base"), F.col("n").alias("given"))
    shift = F.least("h", F.coalesce("given", F.lit(0))) - F.col("h")
    convs = scratch.keep(convs.join(held, "base", "left").select("conv_id", "base", "h", shift.alias("shift")))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("n").over(before), F.lit(0))
    offsets = counts.select("conv_id", "part", ahead.alias("ahead")).join(convs, "conv_id")
    placed = scratch.keep(
        numbered.join(offsets, ["conv_id", "part"]).select("conv_id", (F.col("p") + F.col("ahead")).alias("p"), "h", "shift", "role", "text")
    )
    own = placed.filter("p > h").select("conv_id", (F.col("p") + F.col("shift")).alias("depth"), "role", "text")
    first = placed.filter(F.col("p") < heads).select(F.col("conv_id").alias("base"), "p", "role", "text")
    taken = convs.select("conv_id", "base", "h").join(first, "base").filter("p <= h")
    turns = own.unionByName(taken.select("conv_id", F.col("p").alias("depth"), "role", "text"))
    return scratch.keep(turns), convs.select("conv_id")


def _bits(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, 16 * at + 1, 16), 16, -10).cast("long")


def _running(turns: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Prefixes (conv_id, block, depth, x, y, parent's px and py, length, tokens before) and their totals by block."""
    turn = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    digest = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), turn), 256)
    rows = turns.select(
        "conv_id",
        F.floor((F.col("depth") - 1) / block).alias("block"),
        "depth",
        F.char_length("text").cast("long").alias("length"),
        digest.alias("digest"),
    )
    rows = rows.select("conv_id", "block", "depth", "length", _bits(F.col("digest"), 0).alias("u"), _bits(F.col("digest"), 1).alias("v"))
    sums = [F.bit_xor("u").alias("tx"), F.bit_xor("v").alias("ty"), F.sum("length").alias("tokens"), F.count(F.lit(1)).alias("n")]
    totals = rows.groupBy("conv_id", "block").agg(*sums)
    ahead = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "conv_id",
        "block",
        F.coalesce(F.bit_xor("tx").over(ahead), F.lit(0)).alias("bx"),
        F.coalesce(F.bit_xor("ty").over(ahead), F.lit(0)).alias("by"),
        F.coalesce(F.sum("tokens").over(ahead), F.lit(0)).alias("bt"),
    )
    along = Window.partitionBy("conv_id", "block").orderBy("depth")
    here = rows.withColumns(
        {"rx": F.bit_xor("u").over(along), "ry": F.bit_xor("v").over(along), "rt": F.sum("length").over(along)}
    ).join(starts, ["conv_id", "block"])
    x, y = F.col("rx").bitwiseXOR(F.col("bx")), F.col("ry").bitwiseXOR(F.col("by"))
    prefixes = here.select(
        "conv_id", "block", "depth", x.alias("x"), y.alias("y"),
        x.bitwiseXOR(F.col("u")).alias("px"), y.bitwiseXOR(F.col("v")).alias("py"),
        "length", (F.col("rt") + F.col("bt") - F.col("length")).alias("before"),
    )
    return prefixes, totals


def prefix_trie(conversations: DataFrame, every: int = EVERY, heads: int = HEADS, block: int = BLOCK, chunk: int = CHUNK) -> Trie:
    """The trie of the rebuilt conversations of ``conversations`` (conv_id, turn, role, text).

    Turns go by ``turn``, null first, then role and text; rows may repeat, each is a turn. A null role or text is
    empty. Rows with a null conv_id belong to no conversation and take no part. Conversations and texts may be of any
    length. An empty table gives no nodes, not even a root. Other columns are ignored, whatever their names.
    """
    scratch = Scratch(conversations.sparkSession)
    turns, convs = rebuild(conversations, scratch, every, heads)
    prefixes, totals = _running(turns, block)
    whole = totals.groupBy("conv_id").agg(
        F.sum("n").alias("depth"), F.bit_xor("tx").alias("x"), F.bit_xor("ty").alias("y"), F.sum("tokens").alias("total")
    )
    zero = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("depth", "x", "y", "total")}
    ends = scratch.keep(convs.join(whole, "conv_id", "left").select("conv_id", *zero.values()))
    sequences = scratch.keep(
        ends.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.max("total").alias("total"))
    )

    def by_block(table: DataFrame, depth: str) -> DataFrame:
        last = F.floor((F.greatest(F.col(depth), F.lit(1)) - 1) / block)
        return table.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last)))

    root = sequences.select(
        "conv_id", F.lit(0).cast("long").alias("block"), *[F.lit(0).cast("long").alias(c) for c in NODE],
        *[F.lit(None).cast("long").alias(c) for c in ("px", "py")], *[F.lit(0).cast("long").alias(c) for c in ("length", "before")],
    )
    known = by_block(sequences.select("conv_id", "weight", "total", F.col("depth").alias("last")), "last")
    types = dict(root.dtypes)
    prefixes = prefixes.select(*[F.col(c).cast(types[c]).alias(c) for c in root.columns])
    rows = scratch.keep(prefixes.unionByName(root).join(known, ["conv_id", "block"]))

    inner = rows.filter("depth < last").select(*NODE).distinct()
    leaves = sequences.join(inner, NODE, "left_anti").select("conv_id", F.col("depth").alias("last"))
    owners = (
        rows.join(by_block(leaves.select("conv_id", "last"), "last").drop("last"), ["conv_id", "block"], "left_semi")
        .groupBy(*NODE)
        .agg(F.min("conv_id").alias("owner"), F.min("before").alias("before"))
    )
    owned = owners.groupBy(F.col("owner").alias("conv_id")).agg(F.min("before").alias("fresh"))
    owned = by_block(owned.join(sequences.select("conv_id", F.col("depth").alias("last")), "conv_id"), "last").drop("last")

    is_leaf = F.col("fresh").isNotNull()
    shared = F.col("weight") * (F.col("total") - F.col("before"))
    once = F.when(is_leaf, F.col("total") - F.greatest("before", "fresh")).otherwise(0)
    nodes = scratch.keep(
        rows.join(owned, ["conv_id", "block"], "left")
        .groupBy(*NODE)
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.sum("weight").alias("n_convs"),
            F.sum(is_leaf.cast("long")).alias("n_leaves"),
            (F.sum(shared) - F.sum(once)).cast("long").alias("saved_tokens"),
            F.min("px").alias("px"),
            F.min("py").alias("py"),
        )
    )
    parent = (F.col("depth") - 1).alias("depth")
    children = nodes.filter("depth > 0").groupBy(parent, F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    children = scratch.keep(children)
    up = [F.col(c).alias(n) for c, n in zip(NODE, ("pd", "px", "py"))]
    named = nodes.select(*up, F.col("conv_id").alias("parent_conv_id")).join(
        children.select(*up), ["pd", "px", "py"], "left_semi"
    )
    counted = nodes.join(children.withColumnRenamed("n", "n_children"), NODE, "left").withColumn("pd", F.col("depth") - 1)
    above = spread_join(
        counted.filter("depth > 0"), named, ["pd", "px", "py"], weights=children.select(*up, "n"), chunk=chunk
    )
    top = counted.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "x", "y"]
    found = above.unionByName(top).withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    return Trie(found.select(*columns), ends.select("conv_id", *NODE), turns)


def with_text(trie: Trie) -> DataFrame:
    """The nodes with role and text of their last turn; the root has neither."""
    return trie.nodes.join(trie.turns, ["conv_id", "depth"], "left")


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the id lists of each node, whose rows come one after the other in the order of the ids."""
    node, state, rows = None, None, []

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[*NODE, "ends_sha256"])

    for b in batches:
        for *key, ids in zip(*[b.column(c).to_pylist() for c in [*NODE, "ids"]]):
            if key != node:
                if state:
                    rows.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if rows:
            yield batch(rows)
            rows = []
    if state:
        yield batch([(*node, state.hexdigest())])


def ends_digest(ends: DataFrame, ids: int = IDS) -> DataFrame:
    """Per node where conversations end, SHA-256 of their ids in decimal, ascending and joined by commas.

    Lists go in rows of the ids of one range of ``ids`` numbers and are hashed row by row, so no list is held whole.
    """
    run = F.floor(F.col("conv_id") / ids).alias("run")
    text = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    lists = ends.groupBy(*NODE, run).agg(text.alias("ids"))
    placed = lists.repartition(*NODE).sortWithinPartitions(*NODE, "run").select(*NODE, "ids")
    return placed.mapInArrow(_hash_batches, ", ".join(f"{c} long" for c in NODE) + ", ends_sha256 string")
