"""Best-fit packing in bulk-synchronous rounds.

Documents become runs of token ids; runs longer than a sequence are cut, and full pieces are sequences
of their own. The rest is packed in rounds over two tables, unplaced pieces and open sequences with a
gap. In a round

1. a gap that holds the longest unplaced piece several times offers as many slots, others one;
2. slots and pieces are sorted by size, and in one sweep from large to small each piece takes its
   successor, the smallest slot at least its size that no larger piece took. A slot opens a level and
   a piece closes one, so a piece's slot is the last one before it on its own level. Levels are prefix
   sums: ranks within (size, salt), offsets of the salts within a size, and offsets of the at most two
   times ``SEQUENCE`` sizes. Where more pieces want a size than there are slots, ranks decide;
3. placed pieces are written, and gaps shrink by what they took.

When no piece fits any gap, as many sequences are opened as the unplaced tokens fill at least. All
levels are spread over the tasks; only the table of sizes, bounded by the sequence length, is summed
up in one. Rounds are written to the shared folder.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm import bytesops as B
from kindred.llm.tables import Scratch, keyed

SEQUENCE = 2048
# How byte-level BPE cuts a text, and the characters on which all versions of Unicode agree here.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = re.compile("[\t\n -~¡-ɏ]*")
RUN = 1_000  # blanks in a row; the faster encoder takes their square in steps and recurses as deep
BLANKS = re.compile(rf"\s{{{RUN}}}")
_ENCODERS: dict[tuple[str, bool], Encoder] = {}  # of this worker process

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, _copy long"


class Encoder:
    """Ids of texts by a byte-level BPE tokenizer file.

    Where the file says nothing else than such a tokenizer with merges in the order of their ids, the same
    vocabulary goes to a faster encoder for texts of plain characters without long runs of blanks. All other
    texts go to the tokenizer.
    With ``added`` the strings of the file's added tokens have their ids, as the tokenizer gives them by
    default; without it they are ordinary text.
    """

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.fast = self._fast(spec)
        strings = [t["content"] for t in spec.get("added_tokens") or []] if added else []
        self.added = re.compile("|".join(map(re.escape, strings))) if strings else None

    @classmethod
    def of(cls, path: str, added: bool = False) -> Encoder:
        if (path, added) not in _ENCODERS:
            _ENCODERS[path, added] = cls(path, added)
        return _ENCODERS[path, added]

    def _is_plain(self, text: str) -> bool:
        if self.fast is None or (self.added and self.added.search(text)) or (len(text) >= RUN and BLANKS.search(text)):
            return False
        return PLAIN.fullmatch(text) is not None

    @staticmethod
    def _fast(spec: dict):
        import tiktoken

        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        vocabulary = {p: i for p, i in model["vocab"].items() if i < 256 + len(merges)}
        plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
        if not plain or spec["normalizer"] or [vocabulary.get("".join(m)) for m in merges] != list(range(256, 256 + len(merges))):
            return None
        # a byte is written as its own character where that is visible, else as the next one from U+0100 on
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in visible]
        byte_of = {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte_of[c] for c in piece): i for piece, i in vocabulary.items()}
        return tiktoken.Encoding("byte_bpe", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        plain = [self._is_plain(t) for t in texts]
        others = iter(self.tokenizer.encode_batch([t for t, p in zip(texts, plain) if not p], add_special_tokens=False))
        ids = [self.fast.encode_ordinary(t) if p else next(others).ids for t, p in zip(texts, plain)]
        return [np.array(i, "<u4").tobytes() for i in ids]


def _piece_batches(path: str, sequence: int, end: int, want_ids: bool, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path, added)
        tail = np.array([end], "<u4").tobytes()
        for batch in batches:
            for texts in B.chunks(batch.column("text")):
                raw = texts.data.tobytes()
                cuts = texts.offsets.tolist()
                encoded = encoder.encode([raw[a:b].decode() for a, b in zip(cuts, cuts[1:])])
                rows: list[tuple] = []
                for i, ids in enumerate(encoded):
                    ids += tail
                    n = len(ids) // 4
                    first = n % sequence or min(n, sequence)
                    starts = [0, *range(first, n, sequence)]
                    for piece, (low, high) in enumerate(zip(starts, [*starts[1:], n])):
                        part = ids[4 * low : 4 * high]
                        rows.append((i, piece, low, high - low, zlib.crc32(part), part))
                index, *columns, parts = zip(*rows)
                at = pa.array(np.array(index) + texts.first)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                out = [batch.column("doc_id").take(at), *[pa.array(c, k) for c, k in zip(columns, kinds)]]
                out.append(batch.column("_copy").take(at))
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "_copy"]
                if want_ids:
                    out.append(pa.array([np.frombuffer(p, "<u4").astype(np.int64).tolist() for p in parts], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def pieces(
    docs: DataFrame, path: str, sequence: int = SEQUENCE, end: int = 0, want_ids: bool = False, added: bool = False
) -> DataFrame:
    """Pieces of at most ``sequence`` ids of every row: its text's ids and ``end``; only the first may be shorter.

    ``_copy`` numbers the rows of the input, so that repeated rows stay apart; it is fixed once written.
    """
    read = keyed(docs).select("doc_id", "text", F.monotonically_increasing_id().alias("_copy"))
    return read.mapInArrow(_piece_batches(path, sequence, end, want_ids, added), _PIECES + ", ids array<long>" * want_ids)


def _levels(events: DataFrame, scratch: Scratch) -> DataFrame:
    """``events`` (size, kind 0 for slots and 1 for pieces, id, ...) with the level each opens or closes."""
    salts = max(8, int(scratch.spark.conf.get("spark.sql.shuffle.partitions")))
    group = ["size", "kind", "salt"]
    salted = events.withColumn("salt", F.pmod(F.xxhash64("id", "slot"), F.lit(salts)))
    counts = salted.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    within = Window.partitionBy("size", "kind").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, F.coalesce(F.sum("n").over(within), F.lit(0)).alias("ahead"))
    # at most two rows for each size there can be
    down = Window.orderBy(F.desc("size"), "kind")
    step = F.when(F.col("kind") == 0, F.col("n")).otherwise(-F.col("n"))
    sizes = events.groupBy("size", "kind").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select(
        "size", "kind", (F.sum(step).over(down.rowsBetween(Window.unboundedPreceding, 0)) - step).alias("level")
    )
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("id", "slot"))
    place = F.col("ahead") + F.col("rank")
    return (
        salted.withColumn("rank", rank)
        .join(offsets, group)
        .join(sizes, ["size", "kind"])
        .withColumn("level", F.when(F.col("kind") == 0, F.col("level") + place - 1).otherwise(F.col("level") - place))
        .drop("salt", "rank", "ahead")
    )


def _sweep(events: DataFrame, scratch: Scratch) -> DataFrame:
    """Pieces with the sequence whose slot each takes: columns id, length, sequence_id, slot."""
    along = Window.partitionBy("level").orderBy(F.desc("size"), "kind")
    before = F.lag(F.struct("kind", "sequence_id", "slot")).over(along)
    taken = _levels(events, scratch).withColumn("slot_before", before)
    return taken.filter("kind = 1 AND slot_before.kind = 0").select(
        "id", F.col("size").alias("length"), "slot_before.sequence_id", "slot_before.slot"
    )


def pack(lengths: DataFrame, sequence: int = SEQUENCE, scratch: Scratch | None = None) -> DataFrame:
    """Places for pieces (id, length from 1 to ``sequence``): columns id, sequence_id, offset.

    Offsets are gapless from 0 in every sequence; ids are distinct. As few sequences as best fit finds:
    the least number the tokens fill, and more only for what then fits nowhere.
    """
    scratch = scratch or Scratch(lengths.sparkSession)
    full = lengths.filter(F.col("length") == sequence)
    left = scratch.keep(lengths.filter(F.col("length") < sequence).select("id", F.col("length").cast("int").alias("length")))
    done = [full.select("id", F.col("id").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    gaps, opened = None, 0
    while True:
        total = left.agg(F.count(F.lit(1)), F.max("length"), F.min("length"), F.sum("length")).first()
        if not total[0]:
            break
        count, longest, shortest, tokens = total
        usable = gaps.filter(F.col("gap") >= shortest) if gaps is not None else None
        if usable is None or usable.limit(1).count() == 0:
            more = -(-tokens // sequence)
            fresh = lengths.sparkSession.range(opened, opened + more).select(
                (-F.col("id") - 1).alias("sequence_id"), F.lit(sequence).alias("gap")
            )
            opened += more
            usable = gaps = fresh
        slots = F.greatest(F.lit(1), F.expr(f"gap div {longest}").cast("int"))
        offered = usable.withColumn("slots", slots).select(
            "sequence_id", "gap", "slots", F.explode(F.sequence(F.lit(1), "slots")).alias("slot")
        )
        last = F.col("slot") == F.col("slots")
        size = F.when(last, F.col("gap") - (F.col("slots") - 1) * longest).otherwise(F.lit(longest))
        events = offered.select(
            size.cast("int").alias("size"), F.lit(0).alias("kind"), F.col("sequence_id").alias("id"), "sequence_id", "slot"
        ).unionByName(
            left.select(
                F.col("length").alias("size"),
                F.lit(1).alias("kind"),
                "id",
                F.lit(None).cast("long").alias("sequence_id"),
                F.lit(0).alias("slot"),
            )
        )
        taken = scratch.keep(_sweep(events, scratch))
        by_slot = Window.partitionBy("sequence_id").orderBy("slot")
        ahead = F.sum("length").over(by_slot.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
        placed = taken.withColumn("ahead", ahead).join(gaps, "sequence_id")
        done.append(
            scratch.keep(placed.select("id", "sequence_id", (sequence - F.col("gap") + F.col("ahead")).cast("long").alias("offset")))
        )
        used = taken.groupBy("sequence_id").agg(F.sum("length").alias("used"))
        shrunk = gaps.join(used, "sequence_id", "left").select(
            "sequence_id", (F.col("gap") - F.coalesce("used", F.lit(0))).cast("int").alias("gap")
        )
        before = gaps, left
        gaps = scratch.keep(shrunk.filter("gap > 0"))
        left = scratch.keep(left.join(taken, "id", "left_anti"))
        scratch.drop(taken, *before)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(
    docs: DataFrame, path: str, sequence: int = SEQUENCE, end: int = 0, want_ids: bool = True, added: bool = False
) -> DataFrame:
    """All pieces of ``docs`` (doc_id, text) with sequence_id and offset, and their ids if wanted.

    Columns doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids). A null text is an
    empty one, which is the id ``end`` alone; ids may be null or repeat, and repeated rows are packed as often. Texts may
    be of any length, other columns are ignored, whatever their names, and an empty table gives no rows.
    With ``added`` the ids are the tokenizer's by default; without it an added token is ordinary text.
    """
    scratch = Scratch(docs.sparkSession)
    cut = scratch.keep(pieces(docs, path, sequence, end, want_ids, added).withColumn("id", F.monotonically_increasing_id()))
    # written once, so the numbers are fixed from here on
    placed = pack(cut.select("id", "length"), sequence, scratch)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * want_ids
    return cut.join(placed, "id").select(*columns)
