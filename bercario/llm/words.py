"""Words of a batch of texts and hashes of word sequences, whole batches at a time in numpy.

A text is the UTF-8 bytes that Spark hands over; every word rule used here is a rule on bytes,
because bytes of 128 and above are either all part of words or never a separator.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

# Bytes handled at a time; one longer text is handled alone.
CHUNK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Word rules: which bytes, after lower-casing A-Z, belong to a word.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True

# A random odd base and one random number per byte and per place in a word sequence.
_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
PLACE = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def mixed(values: np.ndarray) -> np.ndarray:
    """Each number scrambled, one to one."""
    x = values ^ (values >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up = np.full(size + 1, _BASE, np.uint64)
    down = np.full(size + 1, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Words:
    """Words of several texts: where they start and end, of which text, and their hashes.

    ``first`` and ``last`` bound the words of text ``i``: ``first[i] <= word < last[i]``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, rule: np.ndarray):
        size = len(data)
        self.texts = len(offsets) - 1
        lower = _LOWER[data]
        inside = rule[lower]
        cut = np.zeros(size + 1, bool)
        cut[offsets] = True
        before = np.zeros(size, bool)
        before[1:] = inside[:-1]
        before &= ~cut[:-1]
        after = np.zeros(size, bool)
        after[:-1] = inside[1:]
        after &= ~cut[1:]
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.count = len(self.start)
        self.first = np.searchsorted(self.start, offsets[:-1])
        self.last = np.searchsorted(self.start, offsets[1:])
        self.text = np.repeat(np.arange(self.texts), self.last - self.first)
        self.lower = lower
        self._hash = None

    @property
    def hash(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if self._hash is None:
            up, down = _powers(max(CHUNK, len(self.lower)))
            total = np.zeros(len(self.lower) + 1, np.uint64)
            np.cumsum(_BYTE[self.lower] * up[: len(self.lower)], out=total[1:])
            self._hash = mixed((total[self.end] - total[self.start]) * down[self.start])
        return self._hash

    def runs(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Every ``length`` consecutive words of one text: the first word, and a hash."""
        if self.count < length:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        many = self.count - length + 1
        total = self.hash[:many] * PLACE[0]
        for place in range(1, length):
            total += self.hash[place : place + many] * PLACE[place % 64]
        whole = self.text[:many] == self.text[length - 1 :]
        return np.flatnonzero(whole), mixed(total[whole] + np.uint64(length))

    def word(self, index: int) -> bytes:
        return self.lower[self.start[index] : self.end[index]].tobytes()


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, text: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of at most ``CHUNK`` bytes, or one row: bounds, bytes, offsets."""
    if not batch.num_rows:
        return
    data, offsets = text_buffers(batch.column(text))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + CHUNK, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield begin, end, data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
        begin = end


def sums_by_text(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i]:last[i]]`` for each text."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[last] - total[first]
