"""Text columns as flat numpy arrays, for operators that work on whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_random = np.random.default_rng(20240601)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 21


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the ``len + 1`` offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts in order, and offsets of each text's words.

    Memory follows ``data`` by a few bytes per byte; the wide arrays are made for two megabytes at a time.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True  # no word runs from one text into the next
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate((inside[1:], [False]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    hashes = np.empty(len(starts), np.uint64)
    longest = int((ends - starts).max()) if len(starts) else 0
    powers = np.cumprod(np.full(longest, _BASE, np.uint64)) if longest else np.zeros(0, np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + _CHUNK)))
        s, e = starts[first:last], ends[first:last]
        lengths = e - s
        heads = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        place = np.arange(int(lengths.sum())) - np.repeat(heads, lengths)
        piece = data[np.repeat(s, lengths) + place]
        if lower:
            piece = _LOWER[piece]
        hashes[first:last] = mix(np.add.reduceat(_BYTE[piece] * powers[place], heads) + lengths.astype(np.uint64))
        first = last
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles (A-Z lower-cased).

    A text with fewer words has its whole sequence as one shingle; one without words has none.
    """
    data, offsets = flat(column)
    hashes, heads = words(data, offsets)
    rolled = _sequences(hashes, width)
    found = []
    for i in range(len(offsets) - 1):
        first, last = heads[i], heads[i + 1]
        if last - first >= width:
            found.append(np.unique(rolled[first : last - width + 1]))
        elif last > first:
            found.append(_sequences(hashes[first:last], int(last - first)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def _sequences(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` words; runs of different widths differ."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total = mix(total * _BASE + hashes[k : k + n])
    return total


def slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` bytes in ``column``, so that outputs stay small; a row is never cut."""
    sizes = _sizes(batch.column(column))
    ends = np.flatnonzero(np.diff(np.cumsum(sizes) // most, prepend=0)) + 1
    first = 0
    for last in (*ends.tolist(), len(sizes)):
        if last > first:
            yield batch.slice(first, last - first)
            first = last


def _sizes(column: pa.Array) -> np.ndarray:
    if pa.types.is_list(column.type):
        return np.asarray(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)) * 4
    return np.asarray(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
