"""Vectorised work on the UTF-8 bytes of a whole Arrow batch of texts.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]``. These separators are single bytes in UTF-8, so
splitting bytes equals splitting code points. Nothing here loops over bytes or words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15 | 1
MIX1, MIX2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
CHUNK = 1 << 18  # bytes; what is made of a piece takes some forty times as many
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    h = (h ^ (h >> U(30))) * MIX1
    h = (h ^ (h >> U(27))) * MIX2
    return h ^ (h >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(1 << n.bit_length(), CHUNK + 1)
        both = []
        for b in (BASE, pow(BASE, -1, 1 << 64)):
            a = np.full(size, U(b))
            a[0] = U(1)
            both.append(np.cumprod(a, dtype=np.uint64))
        _powers[:] = both
    return _powers[0], _powers[1]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if column.offset:
        column = pa.concat_arrays([column])
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64, n + 1)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, chunk: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows [lo, hi) of about ``chunk`` bytes, one row at least, with bytes and offsets."""
    data, off = texts(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + chunk, "right")) - 1)
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the n + 1 offsets of the rows in the list of words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, word[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, word[1:]
    start = np.flatnonzero(word & (~before | edge[:-1]))
    end = np.flatnonzero(word & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(start, off)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    if not len(start):
        return np.zeros(0, np.uint64)
    power, inverse = powers(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + U(1)) * power[: len(data)], dtype=np.uint64, out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * MIX2)


def shingle_hashes(words: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of k words in a row and the rows' offsets; a row of fewer words, but one at least, is one run."""
    n, count = len(words), np.diff(rows)
    full = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k):
        full += mix(words[j : j + len(full)] + U(j + 1)) * U(2 * j + 3)
    sizes = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    out_off = np.zeros(len(rows), np.int64)
    np.cumsum(sizes, out=out_off[1:])
    out = np.zeros(int(out_off[-1]), np.uint64)
    row_of = np.repeat(np.arange(len(count)), count)
    place = np.arange(n) - rows[row_of]
    at = np.flatnonzero(place <= (count - k)[row_of])
    out[out_off[row_of[at]] + place[at]] = mix(full[at] + U(k)) if len(at) else 0
    for few in range(1, k):
        r = np.flatnonzero(count == few)
        if len(r):
            h = np.zeros(len(r), np.uint64)
            for j in range(few):
                h += mix(words[rows[r] + j] + U(j + 1)) * U(2 * j + 3)
            out[out_off[r]] = mix(h + np.full(1, few, np.uint64) * MIX1)
    return out, out_off


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row, its number and the sorted distinct hashes of its lower-cased k-word shingles."""
    for lo, _, data, off in pieces(column):
        data = LOWER[data]
        start, end, rows = spans(data, off)
        hashes, at = shingle_hashes(word_hashes(data, start, end), rows, k)
        for i in range(len(at) - 1):
            yield lo + i, np.unique(hashes[at[i] : at[i + 1]])
