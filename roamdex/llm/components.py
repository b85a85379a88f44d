"""Connected components over a table of links, by rounds of star contraction.

Each round joins every node to the smallest node it sees: first the larger neighbours of a node are hung on its
smallest neighbour, then a node's smaller neighbours are. Links never outnumber those given, nothing of their number
is collected, and every round is cut off in the shared folder. A node with very many neighbours is one key of the
join; the minima are stored first, so that both sides are plain shuffles that the skew join can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamdex.llm.common import stored


def _mark(links: DataFrame) -> tuple:
    """Number and order-free digest of the links, to tell when a round changes nothing."""
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``u, v`` (bigint) -> ``node, component``: the smallest node reachable. Nodes without links have no row.

    Null ends and loops are left out; repeated links and either direction do no harm.
    """
    ordered = links.where("u is not null and v is not null and u <> v")
    links = stored(ordered.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(links)
    while mark[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        # Large star: neighbours above u go to the smallest that u sees. Each link appears from its lower end.
        low = links.select(F.col("v").alias("u"), F.col("u").alias("w"))
        large = low.join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large)
        # Small star: u and its smaller neighbours go to the smallest of them.
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        links = stored(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        before, mark = mark, _mark(links)
        if mark == before:
            break
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
