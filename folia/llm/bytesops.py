"""Numpy kernels over the UTF-8 bytes of many texts at once.

An Arrow batch is cut into chunks of whole texts, so that a task holds some tens of
megabytes of working arrays whatever the batch size; only a text longer than a
chunk gets one of its own. Words are runs of bytes outside space and 0x09-0x0D,
which are the same in bytes as in code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
U64 = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_powers: list[np.ndarray] = []


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < size:
        n = max(size, CHUNK_BYTES + 1)
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(n, base, U64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers[:] = tables
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit changes every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def sums(mask: np.ndarray) -> np.ndarray:
    """Prefix sums with a leading zero: sums(m)[e] - sums(m)[s] counts in [s, e)."""
    out = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=out[1:])
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of the ranges [start, start + length), one range after another."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) if total else np.empty(0, np.int64)
    return shift + np.arange(total)


@dataclass
class Texts:
    """Whole texts, one after another: text i is data[offsets[i]:offsets[i + 1]].

    first and last are the rows of the batch that they come from.
    """

    data: np.ndarray
    offsets: np.ndarray
    first: int = 0
    last: int = 0

    @property
    def size(self) -> int:
        return len(self.offsets) - 1

    @cached_property
    def text_starts(self) -> np.ndarray:
        return self.offsets[:-1][np.diff(self.offsets) > 0]

    @cached_property
    def word_spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and offsets into them by text."""
        inside = ~SPACE[self.data]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        begin[self.text_starts] = inside[self.text_starts]
        finish = inside.copy()
        finish[:-1] &= ~inside[1:]
        finish[self.text_starts[1:] - 1] = inside[self.text_starts[1:] - 1]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    @cached_property
    def line_spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all lines (an empty text has one), and offsets by text."""
        breaks = np.flatnonzero(self.data == 10)
        inside = np.searchsorted(self.offsets, breaks, "right") - 1
        count = np.bincount(inside, minlength=self.size) + 1
        offsets = np.concatenate(([0], np.cumsum(count)))
        starts, ends = np.empty(offsets[-1], np.int64), np.empty(offsets[-1], np.int64)
        first = np.zeros(offsets[-1], bool)
        first[offsets[:-1]] = True
        starts[first], starts[~first] = self.offsets[:-1], breaks + 1
        last = np.zeros(offsets[-1], bool)
        last[offsets[1:] - 1] = True
        ends[last], ends[~last] = self.offsets[1:], breaks
        return starts, ends, offsets

    @cached_property
    def _prefix(self) -> np.ndarray:
        power, _ = _power_tables(len(self.data) + 1)
        out = np.zeros(len(self.data) + 1, U64)
        np.cumsum(_BYTE_CODE[self.data] * power[: len(self.data)], out=out[1:])
        return out

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit fingerprints of the strings data[start:end]."""
        _, inverse = _power_tables(len(self.data) + 1)
        lengths = (ends - starts).astype(U64)
        return mix((self._prefix[ends] - self._prefix[starts]) * inverse[starts] + lengths * U64(0xD6E8FEB86659FD93))

    @cached_property
    def code_points(self) -> np.ndarray:
        """Prefix counts of code points (bytes that do not continue one)."""
        return sums((self.data & 0xC0) != 0x80)

    def lowered(self) -> Texts:
        return Texts(LOWER[self.data], self.offsets, self.first, self.last)

    def raw(self, start: int, end: int) -> bytes:
        return self.data[start:end].tobytes()


def texts(values: list[str | None]) -> Texts:
    """The texts of a plain list; None counts as empty."""
    return next(chunks(pa.array(values, pa.string()), 1 << 62), Texts(np.empty(0, np.uint8), np.zeros(1, np.int64)))


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of a column in chunks of about `limit` bytes; null counts as empty."""
    for array in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        array = pc.fill_null(array.cast(pa.large_string()), "")
        if not len(array):
            continue
        _, places, data = array.buffers()
        offsets = np.frombuffer(places, np.int64)[array.offset : array.offset + len(array) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        row = 0
        while row < len(array):
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
            own = offsets[row : end + 1]
            yield Texts(raw[own[0] : own[-1]], (own - own[0]).astype(np.int64), row, end)
            row = end


def window_hashes(words: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of all windows of `width` words that lie within one text.

    A text of fewer words, but not none, has one window of them all. Returns
    the fingerprints, the first word of each, and offsets by text.
    """
    counts = np.diff(offsets)
    windows = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    at = ranges(offsets[:-1], windows)
    out = np.zeros(len(at), U64)
    short = np.repeat(counts < width, windows)
    left = np.repeat(offsets[1:], windows) - at
    for k in range(width):
        own = words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else np.empty(0, U64)
        if short.any():
            own = np.where(left > k, own, U64(k + 1))
        out = mix(out * U64(0x9E3779B97F4A7C15) + own + U64(k))
    return out, at, np.concatenate(([0], np.cumsum(windows)))


def pack(columns: dict[str, np.ndarray | list | pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
