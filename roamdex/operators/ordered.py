"""Running totals and dense numbers over a global order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGES = 256


def range_of(df: DataFrame, column: str, ranges: int = RANGES) -> Column:
    """Range number of a numeric column, rising with its value.

    The bounds are quantiles of ``df``, at most ``ranges`` numbers on the driver. They only balance the
    ranges: any bounds give the same totals.
    """
    if ranges < 2:
        return F.lit(0)
    shares = [i / ranges for i in range(1, ranges)]
    bounds = df.agg(F.percentile_approx(F.col(column).cast("double"), shares, 4 * ranges)).first()[0]
    return _bounds_below(F.col(column), sorted(set(bounds or [])))


def _bounds_below(value: Column, bounds: list[float], first: int = 0) -> Column:
    """How many of the sorted bounds are below ``value``, by halving: eight comparisons for 255 bounds."""
    if not bounds:
        return F.lit(first)
    mid = len(bounds) // 2
    above = _bounds_below(value, bounds[mid + 1 :], first + mid + 1)
    return F.when(value > bounds[mid], above).otherwise(_bounds_below(value, bounds[:mid], first))


def _before(sums: DataFrame, bucket: str, order: Column, names: list[str]) -> DataFrame:
    """Total of all earlier buckets, for one row per bucket (a few thousand rows at most)."""
    w = Window.partitionBy(F.lit(0)).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(bucket, *[F.coalesce(F.sum(n).over(w), F.lit(0)).alias(f"_b_{n}") for n in names])


def running_totals(df: DataFrame, order: str, values: list[str], ranges: int = RANGES) -> DataFrame:
    """Add ``cum_<value>``: sums over all rows with an order value at least as high. ``order`` is unique.

    Each range of values sums within itself; the totals of the ranges above are added from a table with
    one row per range, which is what makes its broadcast safe.
    """
    rows = df.withColumn("_range", range_of(df, order, ranges))
    sums = rows.groupBy("_range").agg(*[F.sum(v).alias(v) for v in values])
    before = _before(sums, "_range", F.desc("_range"), values)
    w = Window.partitionBy("_range").orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    within = rows.select("*", *[F.sum(v).over(w).alias(f"_w_{v}") for v in values])
    out = within.join(F.broadcast(before), "_range")
    return out.select(*df.columns, *[(F.col(f"_w_{v}") + F.col(f"_b_{v}")).alias(f"cum_{v}") for v in values])


def dense_numbers(df: DataFrame, key: str, name: str = "n", hex_digits: int = 3) -> DataFrame:
    """Add ``name`` = 0, 1, 2, ... in the order of ``key``, a unique column of hex digests.

    Digests spread evenly, so their first digits make 16**hex_digits even buckets.
    """
    rows = df.withColumn("_bucket", F.substring(key, 1, hex_digits))
    before = _before(rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")), "_bucket", F.asc("_bucket"), ["n"])
    w = Window.partitionBy("_bucket").orderBy(key)
    numbered = rows.withColumn("_within", F.row_number().over(w))
    out = numbered.join(F.broadcast(before), "_bucket")
    return out.select(*df.columns, (F.col("_b_n") + F.col("_within") - 1).cast("bigint").alias(name))
