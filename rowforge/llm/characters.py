"""Arrow string batches as arrays of code points (runs inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from rowforge.llm.shingles import byte_slices

SLICE_BYTES = 4 << 20
#: One copy per worker process and task; filled on first use.
_TABLES: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """For each code point: 0 if it is no letter, else its lower-case form
    (itself where that is more than one character)."""
    if "letters" not in _TABLES:
        out = np.zeros(0x110000, np.uint32)
        for code in range(0x110000):
            char = chr(code)
            if char.isalpha():
                low = char.lower()
                out[code] = ord(low) if len(low) == 1 else code
        _TABLES["letters"] = out
    return _TABLES["letters"]


def code_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(code points of consecutive rows without a gap, first position per row
    + total), about ``limit`` bytes of text at a time, one row at least."""
    for part in byte_slices(texts.fill_null("") if texts.null_count else texts, limit):
        rows = part.to_pylist()
        ends = np.cumsum([0, *map(len, rows)])
        yield np.frombuffer("".join(rows).encode("utf-32-le", "surrogatepass"), np.uint32), ends


def runs(mask: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of each maximal run of true positions inside one row."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = rows[:-1][rows[:-1] < len(mask)]
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    first[heads] = mask[heads]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    tails = heads[heads > 0] - 1
    last[tails] = mask[tails]
    return np.flatnonzero(first), np.flatnonzero(last) + 1
