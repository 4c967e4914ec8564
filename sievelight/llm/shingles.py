"""Word and shingle hashes of Arrow text columns, vectorised with numpy inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed together; bounds the arrays of one step (a longer text is a step of its own).
STEP = 1 << 18
_MASK = (1 << 64) - 1
_PRIME = 0x9E3779B97F4A7C15 | 1


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    return _mix(x.astype(np.uint64) + np.uint64((salt * _PRIME) & _MASK))


_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: One random 64-bit value per byte; A-Z share those of a-z.
_BYTE = mix(np.arange(256, dtype=np.uint64), 7)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES or len(_TABLES["up"]) < n:
        size = max(n, STEP + 2)
        _TABLES["up"] = _powers(_PRIME, size)
        _TABLES["down"] = _powers(pow(_PRIME, -1, 1 << 64), size)
    return _TABLES["up"], _TABLES["down"]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the offsets of the rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    n, buffers = len(column), column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, limit: int = STEP) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, one row at least."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, in text order."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    solid = ~_WHITE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    starts, ends = offsets[:-1], offsets[1:]
    inner = starts[starts < len(data)]
    first[inner] |= solid[inner]
    inner = ends[ends > 0] - 1
    last[inner] |= solid[inner]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=total[1:])
    hashes = _mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))
    return hashes, np.searchsorted(offsets, begin, "right") - 1


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """For every row the sorted distinct hashes of its ``size``-word shingles.

    A text with fewer words gives one hash of its whole sequence, one without words (or null) none.
    """
    data, offsets = text_bytes(column)
    for low, high in steps(offsets):
        own = offsets[low:high + 1]
        hashes, rows = words(data[own[0]:own[-1]], own - own[0])
        counts = np.bincount(rows, minlength=high - low)
        ends = np.cumsum(counts)
        rolled = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
        for i in range(size):
            rolled = rolled * np.uint64(_PRIME) + hashes[i:i + len(rolled)]
        rolled = mix(rolled, size)
        for n, end in zip(counts.tolist(), ends.tolist()):
            if n >= size:
                yield np.unique(rolled[end - n:end - size + 1])
            elif n:
                value = 0
                for h in hashes[end - n:end].tolist():
                    value = (value * _PRIME + h) & _MASK
                yield mix(np.array([value], np.uint64), 100 + n)
            else:
                yield rolled[:0]
