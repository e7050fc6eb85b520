"""Words, hashes and winnowed anchors of whole Arrow text batches, in numpy.

A batch is one byte array with the offsets of its documents, so that a step costs a few
passes over memory and no Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
PIECE_BYTES = 1 << 19

# Bytes of words: everything but ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
# Bytes of words: ASCII letters and digits, and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with their texts as ``(bytes, offsets)``; a null counts as empty.

    A part has about half a megabyte of text, or one document.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        col = pc.fill_null(batch.column(column).cast(pa.binary()).cast(pa.large_binary()), b"")
        ends = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
        raw = np.frombuffer(col.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(col):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + PIECE_BYTES, "right")) - 1)
            yield batch.slice(at, to - at), raw[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
            at = to


def words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of each document's first word (one more at the end)."""
    inside = word_bytes[data]
    full = offsets[1:] > offsets[:-1]
    joined = np.zeros(len(data) + 1, bool)  # joined[i]: byte i goes on with the word of byte i - 1
    joined[1:-1] = inside[1:] & inside[:-1] if len(data) else False
    joined[offsets[:-1][full]] = False
    starts = np.flatnonzero(inside & ~joined[:-1])
    joined[offsets[1:]] = False
    ends = np.flatnonzero(inside & ~joined[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Rolling:
    """Hashes of all spans of a value array, from one running sum."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, values: np.ndarray, base: int) -> None:
        power, self.inverse = self._tables(base, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * power[: len(values)], out=self.sums[1:])

    @classmethod
    def _tables(cls, base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        if base not in cls._powers or len(cls._powers[base][0]) < size:
            size = max(size, PIECE_BYTES + 1)
            both = []
            for factor in (base, pow(base, -1, 1 << 64)):
                table = np.full(size, factor, U64)
                table[0] = 1
                both.append(np.cumprod(table, dtype=U64))
            cls._powers[base] = tuple(both)
        return cls._powers[base]

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self, size: int) -> np.ndarray:
        """The hash of every run of ``size`` values."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, U64)
        return mix((self.sums[size:] - self.sums[:n]) * self.inverse[:n])


BASE_A, BASE_B, BASE_W = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


@cache
def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(0x2545F4914F6CDD1D))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    return Rolling(byte_values()[data], BASE_W).spans(starts, ends)


def smallest(h: np.ndarray, width: int) -> np.ndarray:
    """The least value of every run of ``width`` values."""
    size, least = 1, h
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _leftmost(h: np.ndarray, width: int, starts: np.ndarray) -> np.ndarray:
    view = np.lib.stride_tricks.sliding_window_view(h, width)
    parts = [s + view[s].argmin(axis=1) for s in np.array_split(starts, len(starts) // 16384 + 1)]
    return np.concatenate(parts)


def winnow(h: np.ndarray, width: int, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the windows that start where ``valid``: position, first and last window start.

    The anchor of a window is the leftmost least of its ``width`` hashes, so it depends on
    nothing outside the window. Windows side by side with one anchor make one row.
    """
    starts = np.flatnonzero(valid[: max(0, len(h) - width + 1)])
    if not len(starts):
        return starts, starts, starts
    least = smallest(h, width)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] != starts[:-1] + 1) | (least[1:] != least[:-1])
    at = np.flatnonzero(new)
    lo, hi = starts[at], starts[np.append(at[1:], len(starts)) - 1]
    pos = _leftmost(h, width, lo)
    tied = pos < hi  # the same hash again further right: look at each window of the run
    if tied.any():
        t_lo, t_hi = lo[tied], hi[tied]
        n = t_hi - t_lo + 1
        each = np.repeat(t_lo, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        own = _leftmost(h, width, each)
        cut = np.ones(len(each), bool)
        cut[1:] = (own[1:] != own[:-1]) | (each[1:] != each[:-1] + 1)
        at = np.flatnonzero(cut)
        lo = np.concatenate([lo[~tied], each[at]])
        hi = np.concatenate([hi[~tied], each[np.append(at[1:], len(each)) - 1]])
        pos = np.concatenate([pos[~tied], own[at]])
    return pos, lo, hi


def ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers from each ``lo`` to its ``hi``, and which pair each comes from."""
    n = hi - lo + 1
    owner = np.repeat(np.arange(len(lo)), n)
    return lo[owner] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n), owner


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open spans joined where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
