"""Words of many UTF-8 texts at once, as numpy arrays over an Arrow text column.

A word is a run of bytes other than the six ASCII white-space characters. Words never cross
the border between two texts. Their 64-bit hashes are alike in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLOCK_BYTES = 50_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): every output bit depends on every input bit."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)
_BYTE[SPACE] = 0


def powers(base: np.uint64, count: int) -> np.ndarray:
    steps = np.full(max(count, 1), base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


@dataclass
class Words:
    """start and end are byte positions in data; text is the index of the word's text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray

    def of_text(self, count: int) -> np.ndarray:
        """First word of each text, and one more: text i has words [out[i], out[i + 1])."""
        return np.searchsorted(self.text, np.arange(count + 1))


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, offsets) for runs of whole texts of about limit bytes.

    A null text is empty. A text above the limit is a block of its own.
    """
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(column) == 0:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    if lower:
        data = LOWER[data]
    solid = ~SPACE[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    text = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, start, end, text, _hashes(data, start, end))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial over random byte values, summed for each word; in slices, so that memory is bounded."""
    out = np.zeros(len(start), dtype=np.uint64)
    if not len(start):
        return out
    power = powers(_BASE, int((end - start).max()))
    i = 0
    while i < len(start):
        j = min(max(int(np.searchsorted(end, start[i] + BLOCK_BYTES)), i + 1), len(start))
        at, stop = start[i:j] - start[i], int(end[j - 1] - start[i])
        place = np.arange(stop) - np.repeat(at, np.diff(np.append(at, stop)))
        values = _BYTE[data[start[i] : start[i] + stop]]
        values *= power[np.minimum(place, len(power) - 1)]
        out[i:j] = np.add.reduceat(values, at)
        i = j
    return mix(out + (end - start).astype(np.uint64) * _STEP)
