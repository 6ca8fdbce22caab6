"""Vectorised word and shingle hashing over Arrow text columns.

A word is ``[^\\x20\\x09-\\x0D]+``, found on UTF-8 bytes: all separators are
ASCII, so bytes and code points give the same words. Hashes have 64 bits and
depend on the word alone, never on its place or batch. Work is cut into blocks
of about a megabyte, so memory follows the block, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted values without repeats; faster than ``np.unique`` on small arrays."""
    x = np.sort(x)
    keep = np.ones(len(x), bool)
    keep[1:] = x[1:] != x[:-1]
    return x[keep]


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_STEP = mix(np.arange(1, SHINGLE_WORDS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, BLOCK_BYTES + 1)
        for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _powers, _inverses


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, and where each row starts (n + 1 offsets). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    if not len(offsets):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have about ``most`` bytes together; a longer text is a range of its own."""
    _, offsets = text_bytes(column)
    row = 0
    while row < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), len(offsets) - 1)
        yield row, end
        row = end


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; no word crosses a row."""
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[1:-1] |= solid[1:] != solid[:-1]
    edge[0] = edge[-1] = True
    places = np.flatnonzero(edge)
    words = solid[places[:-1]]
    return places[:-1][words], places[1:][words]


def _hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    powers, inverses = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers[: len(data)], out=sums[1:])
    found = (sums[ends] - sums[starts]) * inverses[starts]
    return mix(found ^ ((ends - starts).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _BYTE) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans ascend and don't overlap."""
    parts, word = [np.zeros(0, np.uint64)], 0
    while word < len(starts):  # a long text is hashed in pieces that end between spans
        stop = max(int(np.searchsorted(ends, starts[word] + BLOCK_BYTES, "right")), word + 1)
        a, b = starts[word], ends[stop - 1]
        parts.append(_hash_spans(data[a:b], starts[word:stop] - a, ends[word:stop] - a, table))
        word = stop
    return np.concatenate(parts)


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _BYTE) -> np.ndarray:
    """A 64-bit hash of each range of bytes of a block; ranges may overlap."""
    return _hash_spans(data, starts, ends, table)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word in order, and the number of words of each row."""
    table = _BYTE_LOWER if lower else _BYTE
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    starts, ends = _spans(data, offsets)
    counts = np.diff(np.searchsorted(starts, offsets))
    return hash_spans(data, starts, ends, table), counts


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word windows in order, and how many each row has.

    A row of fewer than ``width`` words, one at least, has its whole sequence as
    its only shingle; a row without words has none.
    """
    begin = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    per_row = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    if not len(hashes):
        return hashes, per_row
    first = np.repeat(begin[:-1], per_row) + (np.arange(per_row.sum()) - np.repeat(np.cumsum(per_row) - per_row, per_row))
    size = np.repeat(np.minimum(counts, width), per_row)
    out = size.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    short = bool((size < width).any())
    for j in range(width):
        term = padded[first + j] * _STEP[j]
        out += np.where(size > j, term, np.uint64(0)) if short else term
    return mix(out), per_row


def shingle_sets(column: pa.Array, width: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row, over whole texts."""
    for a, b in blocks(column):
        data, offsets = text_bytes(column.slice(a, b - a))
        found, per_row = shingles(*word_hashes(data, offsets), width)
        at = np.concatenate([[0], np.cumsum(per_row)])
        for i in range(b - a):
            yield distinct(found[at[i] : at[i + 1]])
