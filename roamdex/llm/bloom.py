"""Log-frequency Bloom filters: sets of 64-bit keys, each with a quantised count, built in Spark and broadcast.

A key of level n is put in n times, together with the numbers 1 to n; its level is read back by probing 1, 2, ... until a
probe misses. A level is never read too low; it is read too high with the chance of a false positive, about 2^-PROBES at
the intended fill. Level 1 alone makes a plain Bloom filter.

All bits of a key lie in one block, which the key's high bits name. Tasks set the bits of the keys they read in blocks of
their own, and the driver joins the blocks: what it gathers is the filter's size, at most ``most_bytes``, and a block more
for each part of the key space (32 MB).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamdex.llm.ngrams import mix

PROBES = 6
BITS_PER_ITEM = PROBES / math.log(2)
BLOCK_BITS = 1 << 19
BLOCK_BYTES = BLOCK_BITS // 8

# Counts up to EXACT are levels of their own, above it a level holds counts within a factor of STEP.
EXACT, STEP = 8, 1.25
MOST_LEVEL = 127

# Keys that are put in or probed at a time: many enough for numpy's calls, few enough that their arrays stay in the cache.
AT_A_TIME = 1 << 14
# Rows of a filter to be built that are put in together: a loop over their levels has a price of its own.
GATHERED = 1 << 18
# Probes made of all keys before those that missed are passed over.
FIRST_PROBES = 2
_MASK = np.uint64(BLOCK_BITS - 1)


def level_of(count: Column) -> Column:
    """Level of a count of 1 or more."""
    above = EXACT + F.floor(F.log(count / F.lit(float(EXACT))) / F.lit(math.log(STEP)))
    return F.least(F.when(count <= EXACT, count).otherwise(above), F.lit(MOST_LEVEL)).cast("tinyint")


def count_of() -> np.ndarray:
    """The count that each level, from 0, is read as: the mean of those it stands for."""
    low = EXACT * STEP ** np.arange(0, MOST_LEVEL - EXACT + 1)
    return np.concatenate([np.arange(EXACT, dtype=float), [EXACT], np.sqrt(low[1:] * low[1:] * STEP)])


def bucket(key: Column) -> Column:
    """Part of the key space, of 512. Rows dealt by it meet in few blocks of a filter: parts share a block at their ends only."""
    return F.shiftrightunsigned(key, 55)


def _first(keys: np.ndarray, level: int, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (key, level): the first bit of the key's block; the first probe's bit in it; the step from probe to probe."""
    block = ((keys >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    m = mix(keys + np.uint64(level * 0xD1342543DE82EF95 & (1 << 64) - 1))
    return block * np.uint64(BLOCK_BITS), m & _MASK, (m >> np.uint64(20)) & _MASK | np.uint64(1)


class Filter:
    """A filter in memory. It is pickled as its bytes."""

    def __init__(self, blocks: int) -> None:
        self.blocks = blocks
        self.bits = np.zeros(blocks * BLOCK_BYTES, np.uint8)

    def add(self, keys: np.ndarray, level: int = 1) -> None:
        for at in range(0, len(keys), AT_A_TIME):
            base, bit, step = _first(keys[at : at + AT_A_TIME], level, self.blocks)
            for i in range(PROBES):
                place = base + ((bit + np.uint64(i) * step) & _MASK)
                byte, sign = (place >> np.uint64(3)).view(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8)
                # Of bits that share a byte one is set at a time.
                while len(byte):
                    self.bits[byte] |= sign
                    missing = np.flatnonzero(self.bits[byte] & sign == 0)
                    byte, sign = byte[missing], sign[missing]

    def add_levels(self, keys: np.ndarray, levels: np.ndarray) -> None:
        """Put each key in with the numbers 1 to its level."""
        for level in range(1, int(levels.max(initial=0)) + 1):
            still = levels >= level
            keys, levels = keys[still], levels[still]
            self.add(keys, level)

    def has(self, keys: np.ndarray, level: int = 1) -> np.ndarray:
        found = np.zeros(len(keys), bool)
        bits = self.bits.view("<u8")
        for at in range(0, len(keys), AT_A_TIME):
            base, bit, step = _first(keys[at : at + AT_A_TIME], level, self.blocks)
            # Bit 0 of a key's number stays 1 as long as its probes hit.
            hit = np.ones(len(base), np.uint64)
            keys_left = np.arange(at, at + len(base))
            for i in range(PROBES):
                if i == FIRST_PROBES:
                    left = np.flatnonzero(hit & np.uint64(1))
                    keys_left, hit, base, bit, step = (x[left] for x in (keys_left, hit, base, bit, step))
                place = base + bit
                hit &= bits[(place >> np.uint64(6)).view(np.int64)] >> (place & np.uint64(63))
                bit = (bit + step) & _MASK
            found[keys_left] = (hit & np.uint64(1)).astype(bool)
        return found

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each key, 0 where it is not in, by probes until one misses."""
        out = np.zeros(len(keys), np.int64)
        open_ = np.arange(len(keys))
        for level in range(1, MOST_LEVEL + 1):
            open_ = open_[self.has(keys[open_], level)]
            if not len(open_):
                break
            out[open_] = level
        return out


def blocks_for(items: int, most_bytes: int) -> int:
    """Blocks of a filter for so many (key, level) items, within ``most_bytes``."""
    wanted = math.ceil(items * BITS_PER_ITEM / BLOCK_BITS)
    return max(1, min(wanted, most_bytes // BLOCK_BYTES))


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``key`` and ``level`` of batches that are put together until they have so many rows."""
    keys, levels, n = [], [], 0
    for batch in batches:
        keys.append(batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64))
        levels.append(batch.column("level").to_numpy(zero_copy_only=False))
        n += batch.num_rows
        if n >= rows:
            yield np.concatenate(keys), np.concatenate(levels)
            keys, levels, n = [], [], 0
    if n:
        yield np.concatenate(keys), np.concatenate(levels)


def build(items: DataFrame, blocks: int, dealt: bool = False) -> Filter:
    """Filter of ``key`` (bigint) and ``level`` (1 or more). ``dealt`` says that the rows lie by their buckets already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filter(blocks)
        for keys, levels in _gathered(batches, GATHERED):
            own.add_levels(keys, levels)
        parts = own.bits.reshape(blocks, BLOCK_BYTES)
        for k in np.flatnonzero(parts.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([parts[k].tobytes()])], ["block", "bits"])

    rows = items.select("key", "level")
    rows = rows if dealt else rows.repartition(bucket(F.col("key")))
    out = Filter(blocks)
    whole = out.bits.reshape(blocks, BLOCK_BYTES)
    for batch in rows.mapInArrow(run, "block int, bits binary").toArrow().to_batches():
        for k, bits in zip(batch.column(0).to_pylist(), batch.column(1)):
            whole[k] |= np.frombuffer(bits.as_buffer(), np.uint8)
    return out
