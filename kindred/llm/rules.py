"""Quality rules, line first: rules judge each line, failing lines go, and a document that loses too much goes.

A line fails if any of these holds (a line without words never does):

* punctuation: more than half as many symbols as words, or more than half as many exclamation marks
  as words in a line mostly of capitals, or at least three words and no closing mark at its end;
* navigation: two bars or more, and at least a quarter as many as words;
* boilerplate: at most 30 words with a stock phrase, or equal to an earlier line of the document.

A document also goes as a whole if it has few words or repeats too many of them (``MIN_WORDS``,
``MAX_REPEATED``). Everything is judged on whole texts, one task's documents at a time; nothing is
shuffled. Lines and word windows of a text are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kindred.llm import bytesops as B
from kindred.llm.tables import KEY_SCHEMA, keyed

MIN_WORDS = 10
MAX_REPEATED = 20  # percent of words in repeated windows
MAX_LOST = 50  # percent of words in failing lines
REPEAT_WINDOW = 5
# Symbols, closing marks, and stock phrases of pages.
SYMBOLS = "#*$%&|<>"
CLOSING = ".!?;:,)]\"'…”’»"
PHRASES = [
    "all rights reserved",
    "accept cookies",
    "click here",
    "cookie policy",
    "enable javascript",
    "privacy policy",
    "sign up for our newsletter",
    "subscribe now",
    "terms of service",
    "terms of use",
]

_IS_SYMBOL = B.table(*SYMBOLS.encode())
_CONTINUES = B.table(spans=((0x80, 0xBF),))
_CAPITAL, _SMALL = (B.table(spans=(s,)) for s in ((0x41, 0x5A), (0x61, 0x7A)))
_CLOSES = B.table(*[ord(c) for c in CLOSING if c < "\x80"])
_CLOSES_WIDE = [c.encode() for c in CLOSING if c >= "\x80"]
_LOWER = np.arange(256, dtype=np.uint8) + 32 * _CAPITAL.astype(np.uint8)


def _count(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many of ``flags`` hold between consecutive ``cuts``."""
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[cuts])


def _line_cuts(texts: B.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the lines (and the end of the last), and the text each belongs to."""
    breaks = np.flatnonzero(texts.data == 0x0A) + 1
    cuts = np.unique(np.concatenate([texts.offsets, breaks, [0]]))
    starts = cuts[:-1]
    return cuts, np.searchsorted(texts.offsets, starts, "right") - 1


def _ends_open(texts: B.Texts, ends: np.ndarray) -> np.ndarray:
    """Whether the text before each of ``ends`` (of a word) lacks a closing mark."""
    closed = _CLOSES[texts.data[ends - 1]]
    for mark in _CLOSES_WIDE:
        hit = np.ones(len(ends), bool)
        for k, byte in enumerate(reversed(mark)):
            at = ends - 1 - k
            hit &= (at >= 0) & (texts.data[np.maximum(at, 0)] == byte)
        closed |= hit
    return ~closed


def judge(texts: B.Texts) -> dict[str, np.ndarray]:
    """Counts of each text, and ``line_cuts``, ``line_doc`` and ``line_fails`` of each line."""
    data, n_docs = texts.data, len(texts.offsets) - 1
    words = B.words(texts, ~B.BLANK)
    n_words = np.diff(words.offsets)
    cuts, doc = _line_cuts(texts)
    of_word = np.searchsorted(cuts, words.start, "right") - 1
    per_line = np.bincount(of_word, minlength=len(doc)).astype(np.int64)
    last_word = np.cumsum(per_line) - 1

    symbols, bangs, bars = (_count(f, cuts) for f in (_IS_SYMBOL[data], data == 0x21, data == 0x7C))
    loud = (2 * bangs > per_line) & (_count(_CAPITAL[data], cuts) > _count(_SMALL[data], cuts))
    fails = (2 * symbols > per_line) | loud | ((bars >= 2) & (4 * bars >= per_line))
    long_enough = np.flatnonzero(per_line >= 3)
    fails[long_enough] |= _ends_open(texts, words.end[last_word[long_enough]])
    lower = _LOWER[data].tobytes()
    for phrase in PHRASES:
        at = lower.find(phrase.encode())
        while at >= 0:
            line = int(np.searchsorted(cuts, at, "right")) - 1
            if per_line[line] <= 30 and at + len(phrase) <= cuts[line + 1]:
                fails[line] = True
            at = lower.find(phrase.encode(), at + 1)
    ends = cuts[1:] - ((data[cuts[1:] - 1] == 0x0A) if len(doc) else 0)
    value = B.range_hashes(texts, cuts[:-1], ends) ^ B.mix(doc.astype(B.U))
    filled = np.flatnonzero(per_line > 0)
    first = np.unique(value[filled], return_index=True)[1]
    repeated = np.zeros(len(doc), bool)
    repeated[np.delete(filled, first)] = True
    fails = (fails | repeated) & (per_line > 0)

    values = B.range_hashes(texts, words.start, words.end)
    grams = B.gram_hashes(values, REPEAT_WINDOW, 1)
    low = np.flatnonzero(words.doc[: len(grams)] == words.doc[len(words.doc) - len(grams) :])
    of, times = np.unique(grams[low] ^ B.mix(words.doc[low].astype(B.U)), return_inverse=True, return_counts=True)[1:]
    low = low[times[of] > 1]
    again = B.covered(len(values), low, low + REPEAT_WINDOW)

    def per_doc(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, values, minlength=n_docs).astype(np.int64)

    return {
        "n_words": n_words,
        "word_chars": _count(~B.BLANK[data] & ~_CONTINUES[data], texts.offsets),
        "n_symbols": _count(_IS_SYMBOL[data], texts.offsets),
        "n_dup_lines": per_doc(repeated),
        "n_repeat_words": _count(again, words.offsets),
        "n_lost": per_doc(per_line * fails),
        "line_cuts": cuts,
        "line_doc": doc,
        "line_fails": fails,
    }


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost"]


def _batches(min_words: int, max_repeated: int, max_lost: int, kept_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in B.chunks(batch.column("text")):
                found = judge(texts)
                n = len(texts.offsets) - 1
                failed = (found["n_words"] < min_words) | (
                    100 * found["n_repeat_words"] > max_repeated * found["n_words"]
                )
                kept = ~failed & (100 * found["n_lost"] <= max_lost * found["n_words"])
                out = {"doc_id": batch.column("doc_id").slice(texts.first, n)}
                out |= {k: pa.array(found[k].astype(np.int64)) for k in _COUNTS}
                out |= {"base_failed": pa.array(failed), "kept": pa.array(kept)}
                if kept_text:
                    out |= {k: batch.column(k).slice(texts.first, n) for k in ("_id", "_key")}
                    cuts, raw = found["line_cuts"], texts.data.tobytes()
                    lines: list[list[bytes]] = [[] for _ in range(n)]
                    for i in np.flatnonzero(~found["line_fails"]).tolist():
                        lines[found["line_doc"][i]].append(raw[cuts[i] : cuts[i + 1]])
                    out["clean_text"] = pa.array([b"".join(x) for x in lines], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_pydict(out)

    return run


def apply_rules(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    max_repeated: int = MAX_REPEATED,
    max_lost: int = MAX_LOST,
    kept_text: bool = True,
) -> DataFrame:
    """Every row of ``docs`` by doc_id with its counts, base_failed and kept, and if wanted its clean lines.

    With ``kept_text`` the columns _id, _key (of the input row) and clean_text, the text without the
    failing lines, are added. A null or empty text has no words and so fails; ids may be null or repeat,
    and every row is judged by itself. Texts may be of any length, other columns are ignored, whatever their
    names, and an empty table gives no rows.
    """
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", base_failed boolean, kept boolean"
    return keyed(docs).mapInArrow(
        _batches(min_words, max_repeated, max_lost, kept_text),
        schema + f", {KEY_SCHEMA}, clean_text string" * kept_text,
    )
