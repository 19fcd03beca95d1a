"""Blocked Bloom filters of bounded size: bits are set and or-ed inside Spark,
the driver gets and broadcasts the blocks.  Beyond the bound there are more false
positives, never a lost key, so an exact join has to follow."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowforge.llm.shingles import mix

#: Bound on all filters of a call together; a key takes KEY_BYTES while they are below it.
FILTER_BYTES, KEY_BYTES = 64 << 20, 3
#: A block is so many words of 32 bits, with one bit of every key in each.
LANES = 8
_NAMES = [f"lane{k}" for k in range(LANES)]
BITS = "shard int, block long, " + ", ".join(f"{c} int" for c in _NAMES)


def blocks_of(sizes: dict[int, int], filter_bytes: int) -> dict[int, int]:
    """Blocks of the filter of every shard; all of them within the bound."""
    share = min(1.0, filter_bytes / max(1, KEY_BYTES * sum(sizes.values())))
    return {k: max(1, min(1 << 24, int(n * KEY_BYTES * share) // (4 * LANES))) for k, n in sizes.items()}


def _places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, a well mixed hash whose parts choose the bits)."""
    h = mix(hashes)
    return (h >> np.uint64(40)).astype(np.int64) * blocks >> 24, h


def _lane(h: np.ndarray, lane: int) -> np.ndarray:
    return np.uint32(1) << (h >> np.uint64(5 * lane)).astype(np.uint32) % np.uint32(32)


def bits(shard: int, hashes: np.ndarray, blocks: int) -> pa.RecordBatch:
    """The bits of some keys, as rows of BITS."""
    block, h = _places(hashes, blocks)
    lanes = [pa.array(_lane(h, k).view(np.int32)) for k in range(LANES)]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(h), shard, np.int32)), pa.array(block), *lanes],
                                      ["shard", "block", *_NAMES])


def merged(set_bits: DataFrame, blocks: dict[int, int]) -> dict[int, np.ndarray]:
    """Shard -> (blocks, LANES) matrix, from rows of BITS."""
    table = set_bits.groupBy("shard", "block").agg(*[F.bit_or(c).alias(c) for c in _NAMES]).toArrow()
    out = {k: np.zeros((n, LANES), np.uint32) for k, n in blocks.items()}
    if len(table):
        owner, block = table.column("shard").to_numpy(), table.column("block").to_numpy()
        lanes = np.stack([table.column(c).to_numpy().astype(np.int32).view(np.uint32) for c in _NAMES], axis=1)
        for k, held in out.items():
            held[block[owner == k]] = lanes[owner == k]
    return out


def positive(hashes: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Positions in ``hashes`` of the keys that the filter may hold."""
    at = np.arange(len(hashes))
    block, h = _places(hashes, len(held))
    for lane in range(LANES):
        keep = held[block, lane] & _lane(h, lane) != 0
        at, block, h = at[keep], block[keep], h[keep]
    return at


def among(keys: DataFrame, column: str, filter_bytes: int = FILTER_BYTES) -> Column:
    """A condition on ``column`` (a long; null is never there): may it be one of
    the values that it has in ``keys``?"""
    blocks = blocks_of({0: keys.count()}, filter_bytes)

    def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield bits(0, b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), blocks[0])

    set_bits = keys.select(column).where(F.col(column).isNotNull()).mapInArrow(masks, BITS)
    held = keys.sparkSession.sparkContext.broadcast(merged(set_bits, blocks)[0])

    def probe(values: pa.Array) -> pa.Array:
        out = np.zeros(len(values), bool)
        there = values.is_valid().to_numpy(zero_copy_only=False)
        hashes = values.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
        out[positive(hashes, held.value)] = True
        return pa.array(out & there)
    return F.arrow_udf(probe, "boolean")(column)
