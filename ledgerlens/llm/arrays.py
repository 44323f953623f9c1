"""Words and word n-grams of a batch of texts as numpy arrays.

The texts of an Arrow batch lie in one byte buffer; words are found and hashed
there at once, without a Python step for each word.  Words are maximal runs of
bytes other than space and \\t..\\r (all ASCII, so UTF-8 is never cut).  Hashes
are 64-bit polynomial hashes over random byte codes and depend only on the
words themselves, so every task on every machine computes the same ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at once; a longer text forms a slice of its own.
SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values (a bijection)."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_CODE_LOWER = _CODE.copy()
_CODE_LOWER[65:91] = _CODE[97:123]


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        _powers[base] = have
    return have[:n]


def _sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values weighted by position, from which any run's hash follows."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(_BASE, len(values)), out=out[1:])
    return out


def _runs(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    h = (sums[end] - sums[start]) * _power(_INVERSE, len(sums))[start]
    return mix(h + mix((end - start).astype(np.uint64)))


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, off - off[0]


def slices(offsets: np.ndarray, size: int | None = None):
    """Row ranges of about ``size`` bytes (SLICE_BYTES)."""
    i, n = 0, len(offsets) - 1
    size = size or SLICE_BYTES
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """Words of rows i..j: byte ranges ``start``, ``end``; ``row`` holds where each row's words begin (n + 1)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, i: int, j: int, lower: bool = False):
        self.data = data[offsets[i]:offsets[j]]
        self.offsets = off = offsets[i:j + 1] - offsets[i]
        n = len(self.data)
        self.lower = lower
        space = _SPACE[self.data]
        before = np.ones(n, bool)
        before[1:] = space[:-1]
        after = np.ones(n, bool)
        after[:-1] = space[1:]
        begins = off[:-1]
        before[begins[begins < n]] = True
        ends = off[1:]
        after[ends[ends > 0] - 1] = True
        np.logical_not(space, out=space)
        self.start = np.flatnonzero(space & before)
        self.end = np.flatnonzero(space & after) + 1
        self.row = np.searchsorted(self.start, off)
        self.row[-1] = len(self.start)

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word."""
        sums = _sums((_CODE_LOWER if self.lower else _CODE)[self.data])
        return _runs(sums, self.start, self.end)

    def rows_of(self) -> np.ndarray:
        """The row of every word."""
        return np.repeat(np.arange(len(self.row) - 1), np.diff(self.row))


def ngrams(words: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows, and where each row's windows begin (n + 1).
    A row's windows start at its 1st, 2nd, ... word."""
    size = np.diff(row)
    count = np.maximum(size - k + 1, 0)
    begin = np.concatenate(([0], np.cumsum(count)))
    start = np.arange(begin[-1]) + np.repeat(row[:-1] - begin[:-1], count)
    return _runs(_sums(words), start, start + k), begin


def whole(words: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hash of the whole word sequence of every row."""
    return _runs(_sums(words), row[:-1], row[1:])


def shingle_sets(words: np.ndarray, row: np.ndarray, k: int) -> list[np.ndarray]:
    """Each row's sorted distinct k-word shingles; with fewer words the whole sequence is one
    shingle, without words the set is empty."""
    grams, begin = ngrams(words, row, k)
    full = whole(words, row)
    size = np.diff(row)
    return [np.unique(grams[begin[i]:begin[i + 1]]) if size[i] >= k else full[i:i + 1] if size[i] else full[:0]
            for i in range(len(size))]
