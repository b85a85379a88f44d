"""Variable-capacity best-fit packing of documents into training sequences.

A document longer than the largest capacity is cut into full pieces, each a sequence of its own, and one rest; so
nothing is dropped and every piece keeps its word offset. Rests are dealt by a hash of their document into shards of
a few thousand, each packed by itself: best-fit decreasing, where a bin that has to be opened takes the capacity
that costs least per word it can expect to hold, and where every bin is in the end put down to the smallest
capacity that holds its contents. Shards lose at most a few part-filled bins each.

Defined cases: a null text and a text without words have size 0 and go as one empty piece into no bin (``bin_id``
null); equal sizes go by document id, then piece; repeated rows are packed each by themselves; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITIES = (512, 1024, 2048, 4096)
#: Words' worth of cost that any sequence has besides its capacity (padding to a kernel's tile, launch, masks).
OPEN_COST = 16.0
SHARD_ROWS = 4096

PACKED = (
    "doc_id bigint, piece int, start bigint, size bigint, shard bigint, bin int, bin_offset int, capacity int"
)


def _below(mask: int, limit: int) -> int:
    """Largest set bit at or under ``limit``, or -1."""
    return (mask & ((2 << limit) - 1)).bit_length() - 1


class _Counts:
    """How many there are of each size, with a bit set of the sizes there are."""

    def __init__(self, top: int) -> None:
        self.n, self.mask = [0] * (top + 1), 0

    def add(self, size: int) -> None:
        self.n[size] += 1
        self.mask |= 1 << size

    def take(self, size: int) -> None:
        self.n[size] -= 1
        if not self.n[size]:
            self.mask ^= 1 << size


def _expected_fill(waiting: _Counts, room: int) -> int:
    """Words that the waiting sizes, largest first, would put into ``room``."""
    filled, size = 0, _below(waiting.mask, room)
    while size > 0:
        k = min(waiting.n[size], room // size)
        filled, room = filled + k * size, room - k * size
        size = _below(waiting.mask, min(room, size - 1))
    return filled


def best_fit(
    sizes: Sequence[int], capacities: Sequence[int] = CAPACITIES, open_cost: float = OPEN_COST
) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each size, and the capacity of each bin. Sizes are positive, none above the largest capacity.

    Items by falling size; each goes into the fullest bin that still takes it (of equals, the one opened last).
    """
    capacities = sorted(capacities)
    top = capacities[-1]
    waiting, rooms = _Counts(top), _Counts(top)
    for s in sizes:
        waiting.add(s)
    by_room: dict[int, list[int]] = {}
    used: list[int] = []
    opened: list[int] = []
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        waiting.take(size)
        fitting = rooms.mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            rooms.take(room)
        else:
            costs = [
                ((c + open_cost) / (size + _expected_fill(waiting, c - size)), c)
                for c in capacities[bisect.bisect_left(capacities, size) :]
            ]
            room, b = min(costs)[1], len(used)
            used.append(0)
            opened.append(room)
        bins[i], offsets[i] = b, used[b]
        used[b] += size
        if room > size:
            by_room.setdefault(room - size, []).append(b)
            rooms.add(room - size)
    return bins, offsets, [capacities[bisect.bisect_left(capacities, u)] for u in used]


def pieces(sizes: DataFrame, top: int) -> DataFrame:
    """``doc_id, size`` -> ``doc_id, piece, start, size``: full pieces of ``top`` words and the rest."""
    last = F.greatest(F.lit(0), F.floor((F.col("size") - 1) / top)).cast("int")
    cut = sizes.select("doc_id", F.col("size").alias("words"), F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("bigint") * top
    return cut.select("doc_id", "piece", start.alias("start"), F.least(F.lit(top), F.col("words") - start).alias("size"))


def pack(
    sizes: DataFrame,
    capacities: Sequence[int] = CAPACITIES,
    open_cost: float = OPEN_COST,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``doc_id, size`` (words) -> one row per piece: ``doc_id, piece, start, size, bin_id, bin_offset, capacity``.

    ``bin_id`` is a string, unique over all shards. The number of shards follows the number of documents.
    """
    capacities = tuple(sorted(capacities))
    top = capacities[-1]
    cut = pieces(sizes, top)
    full = cut.where(F.col("size") == top)
    # A full piece is a bin of its own. The number is that of its row in the input, which is a stored table.
    alone = full.select(
        "doc_id", "piece", "start", "size",
        F.concat(F.lit("f"), F.monotonically_increasing_id().cast("string")).alias("bin_id"),
        F.lit(0).alias("bin_offset"), F.lit(top).alias("capacity"),
    )
    empty = cut.where(F.col("size") == 0).select(
        "doc_id", "piece", "start", "size",
        F.lit(None).cast("string").alias("bin_id"), F.lit(None).cast("int").alias("bin_offset"), F.lit(None).cast("int").alias("capacity"),
    )
    rests = cut.where((F.col("size") > 0) & (F.col("size") < top))
    shards = max(1, -(-sizes.count() // shard_rows))

    def one_shard(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "piece", "size"], kind="stable", na_position="first").reset_index(drop=True)
        bins, offsets, kept = best_fit(group["size"].tolist(), capacities, open_cost)
        group["shard"], group["bin"], group["bin_offset"] = key[0], bins, offsets
        group["capacity"] = np.asarray(kept, dtype=np.int32)[bins]
        return group

    shard = F.pmod(F.xxhash64(F.lit("shard"), F.col("doc_id"), F.col("size")), F.lit(shards)).alias("shard")
    packed = (
        rests.select("doc_id", "piece", "start", "size", shard)
        .groupBy("shard")
        .applyInPandas(one_shard, PACKED)
        .select(
            "doc_id", "piece", "start", "size",
            F.concat_ws(".", F.lit("s"), "shard", "bin").alias("bin_id"), "bin_offset", "capacity",
        )
    )
    return alone.unionByName(packed).unionByName(empty)
