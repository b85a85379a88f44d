"""Joins of a large side with a side of unknown size, safe against hot keys.

Both sides come as plain tables or stored ones, so each is a shuffle of its own: Spark sees their real sizes before it
joins, broadcasts a side that is small and splits the partitions of a hot key. A side that was grouped just before
would keep its grouping and could not be split; such a side is stored first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from roamdex.session import cut_lineage


def keyed_join(large: DataFrame, grouped: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join with a side that was grouped by its keys; ``large`` may have hot ones."""
    return large.join(cut_lineage(grouped), on, how)


def without(new: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is not in ``known``."""
    return new.join(known.select(key), key, "left_anti")
