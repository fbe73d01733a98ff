"""Vectorised words, word hashes and shingles over Arrow string columns.

Words are runs of bytes outside [\\x20\\x09-\\x0D], which are ASCII, so UTF-8 text is cut on its bytes.
Word hashes are 64-bit tabulation hashes, shingle hashes mix the hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: All of ASCII but letters and digits.
NO_WORD = np.zeros(256, bool)
NO_WORD[:128] = [not chr(c).isalnum() for c in range(128)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_POSITIONS = 64
_TABLE = np.random.Generator(np.random.PCG64(20240607)).integers(0, 2**64, _POSITIONS * 256, np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def strings(column: pa.Array) -> pa.Array:
    """The column as large strings, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(column: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges holding at most `most` bytes of text, or one row."""
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
        yield row, min(end, len(column))
        row = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a large-string column without nulls, and each row's offset."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[at[0] : at[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def words(data: np.ndarray, at: np.ndarray, blank: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the number of words before each row (one more entry than rows)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    inside = ~blank[data]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, at, "left")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool, blank: np.ndarray = SPACE, block: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of each word's bytes; works through blocks of words, so memory stays bounded for long texts."""
    out = np.empty(len(starts), np.uint64)
    row = 0
    while row < len(starts):
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + block)))
        a, z = starts[row], ends[end - 1]
        piece, heads = data[a:z], starts[row:end] - a
        if lower:
            piece = LOWER[piece]
        lengths = ends[row:end] - starts[row:end]
        gaps = np.diff(np.append(heads, z - a))
        place = np.arange(z - a, dtype=np.int64) - np.repeat(heads, gaps)
        value = _TABLE[((place & (_POSITIONS - 1)) << 8) + piece]
        if lengths.max(initial=0) > _POSITIONS:
            value *= (2 * (place >> 6) + 1).astype(np.uint64)
        value[blank[piece]] = 0
        out[row:end] = mix(np.add.reduceat(value, heads) + lengths.astype(np.uint64) * _ODD[7])
        row = end
    return out


def shingles(hashes: np.ndarray, before: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each word on, and the number of shingles before each row.

    A row with fewer words, but one at least, has its whole sequence as one shingle."""
    count = np.diff(before)
    many = np.maximum(count - k + 1, np.minimum(count, 1))
    offset = np.concatenate(([0], np.cumsum(many)))
    padded = np.concatenate((hashes, np.zeros(k, np.uint64)))
    rolled = np.zeros(len(hashes), np.uint64)
    for j in range(k):
        rolled += padded[j : j + len(hashes)] * _ODD[j]
    row = np.repeat(np.arange(len(count)), many)
    at = before[row] + np.arange(offset[-1]) - offset[row]
    out = rolled[at] if len(at) else np.zeros(0, np.uint64)
    for r in np.flatnonzero((count > 0) & (count < k)):
        own = hashes[before[r] : before[r + 1]]
        with np.errstate(over="ignore"):
            out[offset[r]] = (own * _ODD[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own)) * _ODD[7]
    return mix(out), offset


def shingle_rows(column: pa.Array, k: int, lower: bool, blank: np.ndarray = SPACE) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and all shingle hashes in order, row by row; a megabyte of text, or one text, at a time."""
    for a, z in slices(column, 1 << 20):
        data, at = utf8(column.slice(a, z - a))
        starts, ends, before = words(data, at, blank)
        values, offset = shingles(word_hashes(data, starts, ends, lower, blank), before, k)
        for r in range(z - a):
            yield a + r, values[offset[r] : offset[r + 1]]
