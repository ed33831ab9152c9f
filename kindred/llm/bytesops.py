"""Numpy helpers over the bytes of many texts at once.

A batch's texts lie one behind the other in one buffer; words, rolling hashes and window minima are
then single passes over that buffer. Texts are taken in chunks of bounded size, a longer text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19  # bytes of text handled at once
U = np.uint64
LEAF = 128  # values in one polynomial of a range of any length
# Odd multipliers of the rolling hashes, all 3 or 5 modulo 8, and constants of the bit mixer (fixed values).
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4B, 0xD6E8FEB86659FD93, 0xA0761D6478BD642B)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Texts(NamedTuple):
    """Rows ``first`` to ``first + len(offsets) - 2`` of a batch, and their bytes."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    offsets: np.ndarray  # of the words of each text


def chunks(column: pa.Array, most: int = CHUNK) -> Iterator[Texts]:
    """The texts of an Arrow column, null as empty, about ``most`` bytes at a time."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    column = column.fill_null(b"")
    if len(column) == 0:
        return
    _, raw, data = column.buffers()
    offsets = np.frombuffer(raw, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Texts(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def table(*members: int, spans: tuple[tuple[int, int], ...] = ()) -> np.ndarray:
    """A lookup of 256 truths: the listed bytes and inclusive spans."""
    out = np.zeros(256, bool)
    out[list(members)] = True
    for low, high in spans:
        out[low : high + 1] = True
    return out


BLANK = table(0x20, spans=((0x09, 0x0D),))


def words(texts: Texts, inside: np.ndarray) -> Words:
    """Maximal runs of bytes that ``inside`` holds; no run crosses two texts."""
    n = len(texts.data)
    is_word = inside[texts.data]
    fresh = np.zeros(n + 1, bool)
    fresh[texts.offsets] = True
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1] | fresh[1:n]
    ends = is_word.copy()
    ends[:-1] &= ~is_word[1:] | fresh[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    doc = np.searchsorted(texts.offsets, start, "right") - 1
    return Words(start, end, doc, np.searchsorted(doc, np.arange(len(texts.offsets))))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective bit mixer, so that close inputs give unrelated outputs."""
    x = x.copy()
    x ^= x >> U(30)
    x *= U(MIX[0])
    x ^= x >> U(27)
    x *= U(MIX[1])
    x ^= x >> U(31)
    return x


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, kept for reuse up to a few chunks."""
    up, down = _POWERS.get(base, (np.ones(1, U), np.ones(1, U)))
    if len(up) < n:
        inverse = pow(base, -1, 1 << 64)
        size = max(n, CHUNK + CHUNK // 4)
        factors = np.full(size, base, U), np.full(size, inverse, U)
        for f in factors:
            f[0] = 1
        up, down = (np.cumprod(f, dtype=U) for f in factors)
        if size <= 4 * CHUNK:
            _POWERS[base] = up, down
    return up, down


class Rolling:
    """Hashes of any range of ``values`` in constant time each.

    For ranges of up to some 200 values. Modulo 2**64 two sequences of 2**k values that differ by a constant of
    alternating sign, in the order of Thue and Morse, agree in about k * k / 2 low bits: some 35 of 64 for 128 values,
    all of them from 1,024 values on. Longer ranges go to :func:`hashes`.
    """

    def __init__(self, values: np.ndarray, which: int):
        up, self.down = _powers(BASES[which], len(values) + 1)
        self.sums = np.zeros(len(values) + 1, U)
        np.cumsum((values.astype(U) + U(1)) * up[: len(values)], out=self.sums[1:])

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        raw = (self.sums[high] - self.sums[low]) * self.down[low]
        return mix(raw + (high - low).astype(U) * U(BASES[0]))


def hashes(values: np.ndarray, low: np.ndarray, high: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of ranges of any length: longer ones as a tree of mixed hashes of ``LEAF`` values each."""
    rolling = Rolling(values, which)
    out = rolling(low, high)
    far = np.flatnonzero(high - low > LEAF)
    if len(far):
        size = (high - low)[far]
        n = -(-size // LEAF)
        cuts = np.append(0, np.cumsum(n))
        owner = np.repeat(np.arange(len(far)), n)
        begin = low[far][owner] + LEAF * (np.arange(cuts[-1]) - cuts[owner])
        leaves = rolling(begin, np.minimum(begin + LEAF, high[far][owner]))
        out[far] = mix(hashes(leaves, cuts[:-1], cuts[1:], which) ^ size.astype(U))
    return out


def range_hashes(texts: Texts, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    return hashes(texts.data, start, end, which)


def gram_hashes(values: np.ndarray, k: int, which: int) -> np.ndarray:
    """Hashes of every ``k`` consecutive values (fewer than ``k`` values: none)."""
    low = np.arange(max(len(values) - k + 1, 0))
    return Rolling(values, which)(low, low + k)


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` consecutive values."""
    if len(values) < width:
        return values[:0]
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = pick(out[:-step], out[step:])
        done += step
    return out


def winnow(values: np.ndarray, width: int, whole: np.ndarray) -> np.ndarray:
    """Positions that are a minimum of some ``width`` consecutive values, ties all included.

    ``whole`` says of each stretch, by its start, whether it lies within one text; others do not count.
    Equal stretches select equal positions, wherever they stand.
    """
    lowest = sliding(values, width, np.minimum)
    if not len(lowest):
        return np.zeros(0, np.int64)
    pad = np.zeros(width - 1, U)
    lowest = np.where(whole, lowest, U(0))
    highest = sliding(np.concatenate([pad, lowest, pad]), width, np.maximum)
    return np.flatnonzero((highest == values) & (highest > 0))


def chosen_by(values: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, width: int):
    """Stretches of which a position is the leftmost minimum, as pairs (index into ``at``, start).

    ``at`` holds positions, and only stretches that start in [low, high] of their position count.
    Taken some positions at a time, so that memory is bounded by the widths of those.
    """
    owners, starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(1, (1 << 21) // width)
    for first in range(0, len(at), step):
        here = slice(first, first + step)
        start = at[here][:, None] - np.arange(width)[None, :]
        fits = (start >= low[here][:, None]) & (start <= high[here][:, None])
        owner = np.broadcast_to(np.arange(first, first + len(start))[:, None], start.shape)[fits]
        start = start[fits]
        mine, place = np.ones(len(start), bool), at[owner]
        for j in range(width):
            other = start + j
            mine &= (values[other] > values[place]) | ((values[other] == values[place]) & (other >= place))
        owners.append(owner[mine])
        starts.append(start[mine])
    return np.concatenate(owners), np.concatenate(starts)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(U, copy=False).view(np.int64)


def covered(n: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in a range [low, high)."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, low, 1)
    np.add.at(steps, high, -1)
    return np.cumsum(steps[:-1]) > 0
