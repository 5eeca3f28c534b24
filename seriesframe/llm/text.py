"""Words and n-gram hashes of whole Arrow batches, computed on their UTF-8 buffers with numpy.

A word is a run of bytes other than 0x20 and 0x09-0x0D; these never occur inside a multi-byte character, so byte
spans are word spans. Hashes are 64-bit sums of mixed (byte, position) pairs: equal words have equal hashes in
every process, and unequal ones collide with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; one longer text is still taken whole.
SLICE_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (the public splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def odd_constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers derived from a seed."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and row offsets of a string column without nulls."""
    wide = pa.types.is_large_string(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets into them) of consecutive rows with about `most` bytes together."""
    data, offsets = utf8(column)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


@dataclass
class Words:
    """starts, ends: byte spans; hashes: one per word; rows: word offsets of each text, as Arrow offsets."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Word spans and hashes of texts laid end to end."""
    inside = ~_IS_SPACE[data]
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    finishes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finishes) + 1
    return Words(starts, ends, span_hashes(data, starts, ends), np.searchsorted(starts, offsets).astype(np.int64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each non-empty, non-overlapping, ascending byte span."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    letters = data[place + np.repeat(starts, lengths)]
    x = ((place.astype(np.uint64) + np.uint64(1)) << np.uint64(8)) | letters
    x *= np.uint64(0x9E3779B97F4A7C15)
    x += np.uint64(seed)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return mix(np.add.reduceat(x, first) + lengths.astype(np.uint64))


def window_hashes(hashes: np.ndarray, width: int, seed: int = 7) -> np.ndarray:
    """A hash of every run of `width` hashes, runs that cross texts included."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j, factor in enumerate(odd_constants(width, seed)):
        total += hashes[j : j + n] * factor
    return mix(total)


def whole_windows(rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the windows that lie in one text, and how many each text has."""
    counts = np.maximum(np.diff(rows) - width + 1, 0)
    first = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - np.repeat(first, counts) + np.repeat(rows[:-1], counts), counts
