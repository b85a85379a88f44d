"""Scores of predicted hit counts against known ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamdex import fixed
from roamdex.operators.ordered import RANGES, running_totals
from roamdex.session import cut_lineage


def paired(truth: DataFrame, predicted: DataFrame, key: str = "keyword") -> DataFrame:
    """``keyword, truth, predicted`` for the keywords both sides have."""
    return truth.join(predicted, key)


def macro_recall(rows: DataFrame, truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """Mean over all labels of the share of a label's rows that were predicted as it.

    Labels are those of both columns; one that is only predicted has recall 0. Each row gives a true and a
    predicted label in one pass, and labels are summed map-side before the shuffle.
    """
    hit = F.col(truth).eqNullSafe(F.col(predicted)).cast("int")
    labels = rows.select(
        F.inline(
            F.array(
                F.struct(F.col(truth).alias("label"), F.lit(1).alias("real"), hit.alias("hit")),
                F.struct(F.col(predicted).alias("label"), F.lit(0).alias("real"), F.lit(0).alias("hit")),
            )
        )
    )
    sums = labels.groupBy("label").agg(F.sum("real").alias("real"), F.sum("hit").alias("hit"))
    recall = F.when(F.col("real") > 0, F.col("hit") / F.col("real")).otherwise(0.0)
    return sums.agg(F.avg(recall).alias("macro_recall"))


def average_precision(
    rows: DataFrame, relevant: Column, score: str = "score", ranges: int = RANGES
) -> DataFrame:
    """Sum over falling distinct scores of (rise in recall) x precision; 0 without relevant rows.

    Equal scores are one step. Rows are first folded to one per distinct score and stored, as they are
    read three times; the cumulative counts go over value ranges, not through one task.
    """
    steps = cut_lineage(
        rows.select(F.col(score).cast("double").alias("score"), relevant.cast("int").alias("tp"))
        .groupBy("score")
        .agg(F.sum("tp").alias("tp"), F.count(F.lit(1)).alias("n"))
    )
    cum = running_totals(steps, "score", ["tp", "n"], ranges)
    gain = F.sum(F.col("tp") * F.col("cum_tp") / F.col("cum_n"))
    positives = F.sum("tp")
    return cum.agg(
        F.when(positives > 0, gain / positives).otherwise(0.0).alias("average_precision")
    )


def result_counts(pages: DataFrame, keyword: str = "keyword", html: str = "html") -> DataFrame:
    """``keyword, truth``: the total a saved result page states, null where it states none that is a number."""
    total = F.regexp_extract(F.col(html), fixed.RESULT_TOTAL, 1)
    return pages.select(F.col(keyword).alias("keyword"), F.regexp_replace(total, ",", "").try_cast("bigint").alias("truth"))
