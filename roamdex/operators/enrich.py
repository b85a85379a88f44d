"""Documents enriched with the infobox fields of matching titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamdex.operators.phrase_join import title_phrase_join
from roamdex.session import cut_lineage

_FIXED_NAMES = ("id", "link", "title", "other")


def field_names() -> Column:
    """Names of the fields a document already carries."""
    return F.concat(
        F.array(*[F.lit(n) for n in _FIXED_NAMES]),
        F.when(F.size("categories") > 0, F.array(F.lit("categories"))).otherwise(
            F.array().cast("array<string>")
        ),
        F.map_keys("paragraphs"),
        F.map_keys("extra"),
    )


def _merged(per_match: DataFrame) -> DataFrame:
    """One map per document; for a key of several infoboxes the one with the greatest title wins.

    Folded per (document, key) first, so the map gathers distinct keys only.
    """
    # Entries and not the bare column: from that Spark would infer a size filter and work the map out twice.
    pairs = per_match.select("doc_id", "title", F.inline(F.map_entries("kv")))
    best = pairs.groupBy("doc_id", "key").agg(
        F.max(F.struct("title", "value")).alias("best")
    )
    return best.groupBy("doc_id").agg(
        F.map_from_entries(F.collect_list(F.struct("key", F.col("best.value")))).alias("kv")
    )


def matches_of(documents: DataFrame, infoboxes: DataFrame) -> DataFrame:
    """``title, doc_id`` of the documents each infobox title matches, stored for the joins that follow."""
    return cut_lineage(title_phrase_join(infoboxes, documents).select("title", "doc_id"))


def matched_fields(infoboxes: DataFrame, matches: DataFrame, merge: bool = False) -> DataFrame:
    """``doc_id, kv`` per (infobox row, matching document), or per document with ``merge``."""
    per_match = infoboxes.select("title", "kv").join(matches, "title")
    return _merged(per_match) if merge else per_match.select("doc_id", "kv")


def enrich(documents: DataFrame, fields: DataFrame) -> DataFrame:
    """A copy of the document per row of ``fields``, its id marked with ``_`` and new fields in ``extra``.

    Fields whose name the document already has are left out.
    """
    joined = documents.join(fields, "doc_id")
    named = joined.withColumn("_names", field_names())
    added = named.withColumn(
        "extra",
        F.map_concat("extra", F.map_filter("kv", lambda k, v: ~F.array_contains(F.col("_names"), k))),
    )
    return added.withColumn("doc_id", F.concat(F.lit("_"), "doc_id")).select(*documents.columns)


def enrich_replace(documents: DataFrame, infoboxes: DataFrame, merge: bool = False) -> DataFrame:
    """All documents, the matched ones replaced by their enriched copies."""
    matches = matches_of(documents, infoboxes)
    return replace(documents, enrich(documents, matched_fields(infoboxes, matches, merge)), matches)


def replace(documents: DataFrame, copies: DataFrame, replaced_ids: DataFrame) -> DataFrame:
    """Documents without the replaced ids, plus the copies."""
    return without_ids(documents, replaced_ids).unionByName(copies)


def without_ids(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """Delete by exact id."""
    return documents.join(ids.select("doc_id"), "doc_id", "left_anti")
