"""End-to-end jobs: each reads stored tables, builds one plan and writes its result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamdex import fixed
from roamdex.operators import enrich as en
from roamdex.operators import evaluate as ev
from roamdex.operators import frontier as fr
from roamdex.operators import infobox as ib
from roamdex.operators import links as li
from roamdex.operators import pages as pg
from roamdex.operators.batch_search import hit_counts
from roamdex.operators.postings import DOCUMENT_FIELDS, FieldSpec, Index
from roamdex.session import cut_lineage
from roamdex.sources import readers, writers


def build_collection(
    pages: DataFrame,
    out: str,
    names: Sequence[str] = fixed.SECTION_NAMES,
    specs: Sequence[FieldSpec] = DOCUMENT_FIELDS,
) -> None:
    """Pages to documents, gazetteer and index under ``out``.

    Documents are written first and read back: the page text is parsed once, and gazetteer and index start
    from a table that survives lost executors.
    """
    spark = pages.sparkSession
    writers.write_documents(pg.extract_documents(pages, names), f"{out}/documents", mode="overwrite")
    documents = spark.read.parquet(f"{out}/documents")
    writers.write_gazetteer(pg.gazetteer(documents), f"{out}/gazetteer")
    Index.build(documents, specs).write(f"{out}/index")


def count_headings(pages: DataFrame, out: str) -> None:
    writers.write_headings(pg.heading_counts(pages), out)


def extract_infoboxes(spark: SparkSession, dump: str, gazetteer: str, out: str, **read_options) -> None:
    """Dump and gazetteer to infobox rows as JSON lines."""
    names = readers.read_lines(spark, gazetteer)
    writers.write_infoboxes(
        ib.gazetteer_infoboxes(readers.read_dump(spark, dump, **read_options), names), out
    )


def enrich_collection(spark: SparkSession, collection: str, infoboxes: str, out: str, merge: bool = False) -> None:
    """Enriched documents and their index under ``out``, which is another folder than ``collection``."""
    documents = spark.read.parquet(f"{collection}/documents")
    rows = ib.with_map(readers.read_infoboxes(spark, infoboxes))
    writers.write_documents(en.enrich_replace(documents, rows, merge), f"{out}/documents", mode="overwrite")
    Index.build(spark.read.parquet(f"{out}/documents")).write(f"{out}/index")


def link_table(pages: DataFrame, out: str, origin_pattern: str = fixed.ORIGIN_HTTPS) -> None:
    """Link edges of all pages, sorted by source so that a round's pages are found by file statistics."""
    edges = li.page_links(pages, origin_pattern)
    edges.repartitionByRange("src", "kind", "pos").sortWithinPartitions("src", "kind", "pos").write.mode(
        "overwrite"
    ).parquet(out)


def dedup_state(spark: SparkSession, state: str, out: str, keys: tuple[str, str] = ("priority", "other")) -> None:
    """A saved crawl state with repeats to one without, as tables under ``out``, which is another folder."""
    frontier, visited = fr.from_state(*readers.read_state_json(spark, state, *keys))
    writers.write_state(frontier, visited, out)


def reconcile_state(
    spark: SparkSession, state: str, pages: str, out: str, keys: tuple[str, str] = ("priority", "other")
) -> None:
    """A saved crawl state against a folder of crawled files: fetched URLs become visited, the others stay queued."""
    queue, visited = readers.read_state_json(spark, state, *keys)
    stay, seen = fr.reconcile(queue, visited, readers.listed_keys(spark, pages))
    frontier, seen = fr.from_state(stay, seen)
    writers.write_state(frontier, seen, out)


def evaluate_counts(
    index: Index, keywords: DataFrame, truth: DataFrame, prefix: str = fixed.COUNT_LINK_PREFIX
) -> DataFrame:
    """Average precision and macro recall, in percent, of hit counts against ``truth(keyword, truth)``.

    A missing truth counts as 0. Precision takes a keyword as relevant when it has true hits at all.
    """
    predicted = hit_counts(index, keywords, prefix).withColumnRenamed("hits", "predicted")
    known = truth.select("keyword", F.coalesce(F.col("truth").try_cast("bigint"), F.lit(0)).alias("truth"))
    # Read three times below; a row per keyword, stored once.
    rows = cut_lineage(ev.paired(known, predicted))
    precision = ev.average_precision(rows, F.col("truth") > 0, "predicted")
    recall = ev.macro_recall(rows)
    parts = [
        precision.select(F.lit("average_precision").alias("metric"), F.col("average_precision").alias("value")),
        recall.select(F.lit("macro_recall").alias("metric"), F.col("macro_recall").alias("value")),
    ]
    return parts[0].unionByName(parts[1]).select("metric", (F.col("value") * 100).alias("percent"))
