"""Words of whole texts as arrays of 64-bit digests, computed per Arrow batch.

A word is a run of bytes other than space and 0x09-0x0D. All work is on the byte buffer of a
batch: no Python object per word. Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20            # bytes of text that are looked at together
DIGEST_BYTES = 256 << 10         # of it that digests are made of together
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread digest of each 64-bit value."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def seeded(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _BASE + np.uint64(seed)) | np.uint64(1)


class _Powers:
    """Powers of the base and of its inverse, grown on demand and kept by the worker."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * DIGEST_BYTES)
            with np.errstate(over="ignore"):
                for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                    powers = np.full(size, base, np.uint64)
                    powers[0] = 1
                    setattr(cls, name, np.cumprod(powers, dtype=np.uint64))
        return cls.up, cls.down


@dataclass
class Words:
    """Words of some consecutive rows. Row ``i`` has the words ``first[i]:first[i + 1]``."""

    rows: slice
    data: np.ndarray              # bytes of the texts
    starts: np.ndarray
    ends: np.ndarray
    digests: np.ndarray
    first: np.ndarray
    row_ends: np.ndarray          # in bytes

    def ngrams(self, n: int, step: np.uint64 = _STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Digests of all runs of ``n`` words within a row, their start words, rows' bounds.

        Another odd ``step`` gives digests that are independent of the first ones.
        """
        counts = np.maximum(np.diff(self.first) - (n - 1), 0)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(bounds[-1]) + np.repeat(self.first[:-1] - bounds[:-1], counts)
        whole = max(0, len(self.digests) - (n - 1))
        with np.errstate(over="ignore"):
            rolled = np.zeros(whole, np.uint64)
            for j in range(n):
                rolled *= step
                rolled += self.digests[j:j + whole]
        return mix(rolled[at] + np.uint64(n)), at, bounds

    def text(self, word: int) -> bytes:
        return self.data[self.starts[word]:self.ends[word]].tobytes()


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets, data


def word_slices(column: pa.Array, lower: bool = False) -> Iterator[Words]:
    """Words of a column of texts, some megabytes of text at a time; a row is never cut."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    offsets, everything = _bytes_of(column)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1
        end = min(max(end, row + 1), len(column))
        data = everything[offsets[row]:offsets[end]]
        if lower:
            data = LOWER[data]
        yield _words(slice(row, end), data, offsets[row:end + 1] - offsets[row])
        row = end


def parts(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Ascending runs that begin within ``DIGEST_BYTES``, and the bytes that they lie in; a run is never cut."""
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + DIGEST_BYTES)))
        yield slice(i, j), slice(int(starts[i]), int(ends[j - 1]))
        i = j


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A digest of each of the runs ``data[starts:ends]`` of bytes; both ascend. It doesn't depend on a run's place."""
    out = np.empty(len(starts), np.uint64)
    for runs, at in parts(starts, ends):
        part, begin, end = data[at], starts[runs] - at.start, ends[runs] - at.start
        up, down = _Powers.get(len(part) + 1)
        with np.errstate(over="ignore"):
            prefix = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=prefix[1:])
            out[runs] = mix((prefix[end] - prefix[begin]) * down[begin] + (end - begin).astype(np.uint64) * _STEP)
    return out


def _words(rows: slice, data: np.ndarray, bounds: np.ndarray) -> Words:
    n = len(data)
    solid = ~SPACE[data]
    begins, finishes = solid.copy(), solid.copy()
    if n:
        begins[1:] &= ~solid[:-1]
        finishes[:-1] &= ~solid[1:]
        edge = bounds[1:-1]
        begins[edge[edge < n]] |= solid[edge[edge < n]]
        edge = edge[edge > 0] - 1
        finishes[edge] |= solid[edge]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finishes) + 1
    return Words(rows, data, starts, ends, digests(data, starts, ends), np.searchsorted(starts, bounds), bounds[1:])
