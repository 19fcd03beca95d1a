"""Hashed words and word shingles of Arrow string batches (runs inside tasks).

Words are maximal runs of bytes other than space and \\t..\\r, with A-Z
lower-cased, so a batch is cut and hashed straight from Arrow's byte buffer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    is_space = np.zeros(256, bool)
    is_space[[0x20, *range(0x09, 0x0E)]] = True
    lower = np.arange(256, dtype=np.uint64)
    lower[ord("A"):ord("Z") + 1] += 32
    return is_space, lower


def _weights(n: int) -> np.ndarray:
    """n odd 64-bit multipliers; a longer table starts like a shorter one."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The batch in row ranges of about ``limit`` bytes (one row at least)."""
    if len(texts) == 0:
        return
    size = np.diff(_offsets(texts))
    row = 0
    total = np.concatenate([[0], np.cumsum(size)])
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(total, total[row] + limit, side="right")) - 1)
        yield texts.slice(row, end - row)
        row = end


def _offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, first word index per row + total); a
    null row has no words."""
    if texts.null_count:
        texts = texts.fill_null("")
    at = _offsets(texts)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    is_space, lower = _byte_tables()
    solid = ~is_space[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = at[:-1][at[:-1] < len(data)]
    first[heads] = solid[heads]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    where = np.flatnonzero(solid)
    owner = np.cumsum(first)[where] - 1
    inside = where - starts[owner]
    longest = int(inside.max()) + 1
    table = _weights(1 << max(8, (longest - 1).bit_length()))
    value = (lower[data[where]] + np.uint64(1)) * table[inside]
    heads_in = np.searchsorted(where, starts)
    return mix(np.add.reduceat(value, heads_in)), np.searchsorted(starts, at)


def shingle_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every n-word shingle in order, first shingle index per row +
    total).  A row with 1..n-1 words has its whole sequence as one shingle."""
    count = np.diff(first)
    shingles = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    out = np.concatenate([[0], np.cumsum(shingles)]).astype(np.int64)
    if not out[-1]:
        return np.zeros(0, np.uint64), out
    row = np.repeat(np.arange(len(count)), shingles)
    start = first[:-1][row] + (np.arange(out[-1]) - out[:-1][row])
    width = np.minimum(count, n)[row]
    factor = _weights(256)[:n]
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    total = width.astype(np.uint64)
    for k in range(n):
        total = total + np.where(k < width, padded[start + k], np.uint64(0)) * factor[k]
    return mix(total), out


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    for part in byte_slices(texts):
        hashes, first = shingle_hashes(*word_hashes(part), n)
        for a, b in zip(first[:-1], first[1:]):
            yield np.unique(hashes[a:b])
