"""SentencePiece encoding and decoding with weighted finite-state transducers.

The normaliser maps spaces to the piece mark and puts one in front. The pieces are arcs between places of
the normalised text, read off by their last character; a character without a piece goes through byte
fallback. The encoding is the path of least weight from start to end in the tropical semiring:

* unigram models: an arc weighs its negative score;
* BPE models: the state also holds the last piece, and an arc from piece a to piece b weighs nothing if
  merging the characters of a and b by rank gives just a and b, and is infinite otherwise. Exactly one
  path is finite, the one that merging by rank finds for the whole text.

A text is composed part by part, cut at places that no piece spans, and a worker remembers the paths of
recent parts. Nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kindred.llm import bytesops as B
from kindred.llm.tables import keyed

MARK = "▁"
MEMO = 400_000  # parts a worker remembers the paths of, up to twice as many, and as many pairs of pieces
PUNCTUATION = ".,;:!?#*$%&|"
TAIL = 4  # last characters by which longer pieces are looked up
LONG = 48  # characters from which a part is not remembered
INFINITE = float("inf")
START = (1 << 22) - 1  # stands for the piece before a text
_TRANSDUCERS: dict[str, Transducer] = {}
# Fixed values of the model format: kinds of pieces, kinds of models, and the weight of an unknown character.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0


class Transducer:
    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        kinds = {p.type for p in proto.pieces}
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only normalisers that map nothing but spaces are supported")
        if kinds - {NORMAL, UNKNOWN, CONTROL, BYTE} or trainer.treat_whitespace_as_suffix:
            raise ValueError("user-defined and unused pieces and trailing marks are not supported")
        if trainer.model_type not in (UNIGRAM, BPE) or not trainer.byte_fallback:
            raise ValueError("only unigram and BPE models with byte fallback are supported")
        self.bpe, self.prefix = trainer.model_type == BPE, spec.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.size = len(proto.pieces)
        if self.size + 0x110000 >= START:
            raise ValueError("the model has too many pieces")
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.unknown_weight = UNKNOWN_PENALTY - min(self.scores.values())
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.out = [p.piece.replace(MARK, " ").encode() if p.type == NORMAL else b"" for p in proto.pieces]
        for value, i in self.bytes.items():
            self.out[i] = bytes([value])
        self.reach: dict[str, int] = {}  # length of the longest piece with these last characters, ``TAIL`` of them
        for piece in self.ids:
            end = piece[-TAIL:]
            self.reach[end] = max(self.reach.get(end, 0), len(piece))
        self.cut = self._safe_cut()
        self.fits: dict[int, float] = {}
        self.alone: dict[str, tuple[list[tuple[float, str, str]], bool]] = {}
        self.paths: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Transducer:
        """The transducer of a model file, one for each worker process."""
        if path not in _TRANSDUCERS:
            with open(path, "rb") as file:
                _TRANSDUCERS[path] = cls(file.read())
        return _TRANSDUCERS[path]

    def normalise(self, text: str) -> str:
        text = text.replace(" ", MARK)
        return MARK + text if self.prefix and text else text

    def _safe_cut(self) -> re.Pattern | None:
        """Where a text may be taken apart: at places that no piece spans.

        Before a mark for spaces behind another character, and between a letter and punctuation.
        """
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            return None
        spans = re.compile(f"[^\\W\\d_](?=[{PUNCTUATION}])")
        joined = re.escape("".join({c for p in self.ids for c in spans.findall(p)}) or "\0")
        return re.compile(f"(?<=[^{MARK}])(?={MARK})|(?<=[^\\W\\d_])(?<![{joined}])(?=[{PUNCTUATION}])")

    def parts(self, text: str) -> list[str]:
        return [p for p in self.cut.split(text) if p] if self.cut else [text] * bool(text)

    def _merges(self, text: str) -> tuple[list[tuple[float, str, str]], list[str]]:
        """Merging ``text`` by rank alone: each merge's score and the first and last symbol after it; what is left."""
        symbols, steps = list(text), []
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = self.scores.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return steps, symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            steps.append((best, symbols[0], symbols[-1]))

    def _alone(self, piece: str) -> tuple[list[tuple[float, str, str]], bool]:
        """The merges of a piece, and whether they end in the piece."""
        known = self.alone.get(piece)
        if known is None:
            if len(self.alone) >= MEMO:
                self.alone = {}
            steps, left = self._merges(piece)
            known = self.alone[piece] = steps, len(left) == 1
        return known

    def _stay_apart(self, one: str, two: str) -> bool:
        """Whether merging ``one + two`` by rank gives just these: no merge across is ever the next one.

        Until one is, both sides merge as they do alone, the better one first and the left one in a tie.
        """
        (left, left_whole), (right, right_whole) = self._alone(one), self._alone(two)
        if not (left_whole and right_whole):
            return False
        i, j, x, y = 0, 0, one[-1], two[0]
        across = self.scores.get(x + y, -INFINITE)
        while True:
            next_left = left[i][0] if i < len(left) else -INFINITE
            next_right = right[j][0] if j < len(right) else -INFINITE
            if across > next_left and across >= next_right and across > -INFINITE:
                return False
            if i == len(left) and j == len(right):
                return True
            if i < len(left) and next_left >= next_right:
                x, i = left[i][2], i + 1
            else:
                y, j = right[j][1], j + 1
            across = self.scores.get(x + y, -INFINITE)

    def _weight(self, before: str, piece: str, pair: int) -> float:
        """Of an arc in a BPE model, after the piece that leads to its start (empty: the start of the text)."""
        if len(self.fits) >= MEMO:
            self.fits = {}
        known = self._stay_apart(before, piece) if before else self._alone(piece)[1]
        self.fits[pair] = weight = 0.0 if known else INFINITE
        return weight

    def _starts(self, text: str, end: int) -> range:
        """Where an arc into ``end`` may start, the longest first."""
        reach = self.reach.get(text[end - TAIL : end] if end > TAIL else text[:end], TAIL - 1)
        return range(end - reach if end > reach else 0, end)

    def shortest(self, text: str) -> list[int]:
        """Pieces of the path of least weight, by id; a character without a piece is its code point behind all ids.

        Of each place the best way in is kept.
        """
        if self.bpe:
            return self._only_path(text)
        weight, last, way = [0.0] + [INFINITE] * len(text), [0] * (len(text) + 1), [0] * (len(text) + 1)
        for end in range(1, len(text) + 1):
            for start in self._starts(text, end):
                piece = self.ids.get(text[start:end])
                if piece is None and end - start > 1:
                    continue
                total = weight[start] - self.scores.get(text[start:end], -self.unknown_weight)
                if total < weight[end]:
                    weight[end], way[end] = total, start
                    last[end] = self.size + ord(text[start]) if piece is None else piece
        return self._back(last, way)

    def _only_path(self, text: str) -> list[int]:
        """The path of a BPE model: the first finite way into a place is the only one."""
        known, fits, reaches, size = self.ids.get, self.fits.get, self.reach.get, self.size
        last, way = [0] * (len(text) + 1), [0] * (len(text) + 1)
        last[0] = START
        for end in range(1, len(text) + 1):
            reach = reaches(text[end - TAIL : end] if end > TAIL else text[:end], TAIL - 1)
            for start in range(end - reach if end > reach else 0, end):
                piece = known(text[start:end])
                if piece is None:
                    if end - start > 1:
                        continue
                    piece = size + ord(text[start])
                pair = last[start] << 22 | piece
                arc = fits(pair)
                if arc is None:
                    arc = self._weight(text[way[start] : start], text[start:end], pair)
                    fits = self.fits.get
                if arc == 0.0:
                    last[end], way[end] = piece, start
                    break
        return self._back(last, way)

    @staticmethod
    def _back(last: list[int], way: list[int]) -> list[int]:
        pieces, at = [], len(last) - 1
        while at:
            pieces.append(last[at])
            at = way[at]
        return pieces[::-1]

    def _ids(self, part: str) -> bytes:
        pieces = self.shortest(part)
        if max(pieces) >= self.size:  # byte fallback
            pieces = [i for p in pieces for i in ([p] if p < self.size else [self.bytes[b] for b in chr(p - self.size).encode()])]
        return array("I", pieces).tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        parts = self.parts(self.normalise(text))
        if len(self.paths) > MEMO:  # forget what has not come up since the last time
            self.paths, self.older = {}, self.paths
        new = {p for p in parts if p not in self.paths}
        for part in new:
            self.paths[part] = self.older[part] if part in self.older else self._ids(part)
        out = b"".join(map(self.paths.__getitem__, parts))
        for part in new:
            if len(part) >= LONG:
                del self.paths[part]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no characters become replacement characters."""
        raw = b"".join([self.out[i] for i in np.frombuffer(ids, "<u4").tolist()])
        return raw[self.prefix and raw[:1] == b" " :].decode("utf-8", "replace")


def _encode_batches(path: str, want: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = Transducer.of(path)
        for batch in batches:
            for texts in B.chunks(batch.column("text")):
                raw, cuts = texts.data.tobytes(), texts.offsets.tolist()
                ids = [transducer.encode(raw[a:b].decode()) for a, b in zip(cuts, cuts[1:])]
                decoded = [transducer.decode(x).encode() for x in ids]
                out = {
                    "doc_id": batch.column("doc_id").slice(texts.first, len(ids)),
                    "n_ids": pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
                    "same": pa.array([x == raw[a:b].replace(MARK.encode(), b" ") for x, a, b in zip(decoded, cuts, cuts[1:])]),
                }
                if want:
                    lists = [np.frombuffer(x, "<u4").astype(np.int64).tolist() for x in ids]
                    out["ids"] = pa.array(lists, pa.list_(pa.int64()))
                    out["decoded"] = pa.array(decoded, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_pydict(out)

    return run


def encode(docs: DataFrame, path: str, want_ids: bool = True) -> DataFrame:
    """Every row of ``docs`` by doc_id: number and crc of its ids, the hash of what they decode to, and
    whether that is the text again (marks in it read as spaces); with ``want_ids`` the ids and the decoded text.

    ``path`` names the model on the executors. A null text is empty and has no ids. Ids of rows may be null or
    repeat, and every row is encoded by itself. Texts may be of any length, other columns are ignored, whatever their
    names, and an empty table gives no rows.
    """
    schema = "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string, same boolean"
    return keyed(docs).select("doc_id", "text").mapInArrow(
        _encode_batches(path, want_ids), schema + ", ids array<long>, decoded string" * want_ids
    )


def _decode_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = Transducer.of(path)
        for batch in batches:
            lists = batch.column("ids").to_pylist()
            texts = [transducer.decode(np.array(x or [], "<u4").tobytes()) for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids (null ids: the empty text)."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode_batches(path), "doc_id long, text string")
