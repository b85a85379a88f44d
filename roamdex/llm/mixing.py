"""Mix sources to target weights, with DataFrame functions only.

Each row gets a key from a hash of its id. Within a source, rows are ordered by that key; the order is cut into
even ranges, word counts are summed by range, and prefix sums over the range totals tell in which range the
source's budget ends. Only that range is ordered row by row. So no source, however hot, is sorted in one task.

Defined cases: a null source is a source of its own, last in order; a null text has size 0 and takes nothing; rows
that repeat count each by themselves; an empty table gives an empty mix; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roamdex.llm.common import fresh, stored, word_count

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
RANGE_ROWS = 2048
# Hex digits of the digest that make a row's place in [0, 1).
PLACE_DIGITS = 13


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """One row per source: ``source, n_rows, source_size, target``.

    Sources in code point order, null last, take the weights in turn and share the total size by them. A target stops
    at ``most_epochs`` times the source's size and the rest is shared anew by weight. Done at once: with sources by
    rising limit per weight, the limits below the common level are taken whole and the level follows from what is
    left. The windows here run over one row per source, not over rows of the table.
    """
    totals = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    weighted = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("bigint"))
    limited = weighted.withColumn("limit", F.lit(most_epochs) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    levels = limited.select(
        "*",
        (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("limit").over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("share"),
    )
    open_level = F.when(F.col("left") / F.col("share") <= F.col("limit") / F.col("weight"), F.col("left") / F.col("share"))
    level = F.max(open_level).over(Window.partitionBy())
    target = F.least(F.col("limit").cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))
    return levels.select("source", "n_rows", "source_size", target.alias("target"))


def _same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def mix(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS, seed: str = "mix"
) -> DataFrame:
    """``doc_id, source, size`` -> the same rows with ``source_size, target, taken`` (words taken, repeats counted).

    A source whose target is above its size is taken whole as often as it fits; of the rest, rows are taken in key
    order up to the exact budget, the last one in part.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")))
    place = F.conv(F.substring(digest, 1, PLACE_DIGITS), 16, 10).cast("bigint") / F.lit(16**PLACE_DIGITS)
    keyed = sizes.select("doc_id", "source", "size", digest.alias("key"), place.alias("place"))
    targets = stored(source_targets(sizes, weights, most_epochs))

    ranges = F.ceil(F.col("n_rows") / RANGE_ROWS)
    budget = F.floor(F.col("target")).cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    plan = targets.select(
        F.col("source").alias("of"), "source_size", "target", ranges.alias("ranges"), epochs.alias("epochs"),
        (budget - epochs * F.col("source_size")).alias("rest"),
    )
    ranged = keyed.join(plan.select("of", "ranges"), _same("source", "of")).select(
        "source", "size", F.floor(F.col("place") * F.col("ranges")).alias("range")
    )
    totals = ranged.groupBy("source", "range").agg(F.sum("size").alias("words"))
    # One row per range of RANGE_ROWS rows; prefix sums over ranges, then the one range in which the rest ends.
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = totals.withColumn("upto", F.sum("words").over(upto))
    found = sums.join(plan.select("of", "rest"), _same("source", "of")).where("upto > rest")
    cuts = found.groupBy("source").agg(
        F.min("range").alias("cut"), F.min_by(F.col("upto") - F.col("words"), "range").alias("start")
    )
    plan = stored(
        plan.join(cuts, _same("of", "source"), "left").drop("source")
    )

    placed = keyed.join(plan, _same("source", "of")).withColumn("range", F.floor(F.col("place") * F.col("ranges")))
    whole = F.when(F.col("range") < F.col("cut"), F.col("size")).otherwise(F.lit(0))
    outside = placed.where("cut is null or range <> cut").withColumn("part", F.coalesce(whole, F.lit(0)))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size")
    within = order.rowsBetween(Window.unboundedPreceding, -1)
    used = F.col("start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - used))
    inside = placed.where("range = cut").withColumn("part", part)
    return outside.unionByName(inside).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.col("part")).cast("bigint").alias("taken"),
    )


def document_sizes(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id, source, size`` (words of the text), stored, so the texts are read once."""
    return stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *more))


def mix_documents(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS, seed: str = "mix"
) -> DataFrame:
    """The mixed rows of ``docs``, columns as they are: a row for each time a document is taken.

    Documents stay whole here: the one in which a source's budget ends is in if at least half of it was taken.
    """
    mixed = mix(document_sizes(docs), weights, most_epochs, seed)
    key, times, time = fresh(docs, "taken_id"), fresh(docs, "times"), fresh(docs, "time")
    whole = F.floor(F.col("taken") / F.col("size") + F.lit(0.5)).cast("int")
    taken = mixed.where("taken > 0").select(F.col("doc_id").alias(key), whole.alias(times)).where(F.col(times) > 0)
    taken = taken.groupBy(key).agg(F.max(times).alias(times))
    met = docs.join(taken, F.col("doc_id").eqNullSafe(F.col(key)))
    each = met.withColumn(time, F.explode(F.sequence(F.lit(1), F.col(times))))
    return each.select(*[F.col(f"`{c}`") for c in docs.columns])
