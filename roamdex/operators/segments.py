"""An index that grows: segments of postings, a table of deleted ids, and statistics that add up.

A change writes one new segment under ``path/seg=k``: the postings of the documents added, the ids taken out of all earlier
segments, and by how much the change moves the statistics of terms and fields (the counts of added documents less
those of deleted ones). What was written before stays as it is. Reading puts the segments together: postings without
the deleted documents', statistics summed, so that scores are those of an index built anew. Where there are many segments
they are merged into one, which is the only step that rewrites postings.

A segment is whole when its ``fields`` are written, which is done last; a half-written one is written again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamdex.operators.postings import DOCUMENT_FIELDS, FieldSpec, Index, build_postings, field_stats, term_grams, term_stats
from roamdex.sources.readers import folder_names, path_exists

MOST_SEGMENTS = 16

_POSTINGS = "field string, term string, doc_id string, tf int, doc_len int, positions array<int>"
_TERMS = "field string, term string, df bigint, cf bigint"
_FIELDS = "field string, n_docs bigint, total_len bigint"


@dataclass(frozen=True)
class SegmentedIndex:
    """Segments under one folder all executors share. Document ids are strings."""

    spark: SparkSession
    path: str
    specs: tuple[FieldSpec, ...] = DOCUMENT_FIELDS
    most_segments: int = MOST_SEGMENTS

    def _whole(self, kind: str) -> list[int]:
        names = [n for n in folder_names(self.spark, self.path) if n.startswith(f"{kind}=")]
        return sorted(int(n[len(kind) + 1 :]) for n in names if path_exists(self.spark, f"{self.path}/{n}/fields/_SUCCESS"))

    def _folders(self) -> list[tuple[int, str]]:
        """The last merged index, if any, and the segments after it, with their numbers."""
        merged = self._whole("merged")[-1:]
        after = [k for k in self._whole("seg") if not merged or k > merged[0]]
        return [(k, f"{self.path}/merged={k}") for k in merged] + [(k, f"{self.path}/seg={k}") for k in after]

    def last(self) -> int:
        """Number of the last whole segment, 0 where there is none."""
        return max([k for k, _ in self._folders()], default=0)

    def change(self, added: DataFrame | None = None, deleted: DataFrame | None = None) -> int:
        """Add documents and delete others, both given as documents. Gives the segment's number.

        Deleted documents are given whole, as they were indexed: their terms leave the statistics. A document that
        is in both is replaced.
        """
        if added is None and deleted is None:
            raise ValueError("nothing to add or delete")
        k = self.last() + 1
        out = f"{self.path}/seg={k}"
        empty = self.spark.createDataFrame([], _POSTINGS)
        postings = empty if added is None else build_postings(added, self.specs)
        order = ["field", "term", "doc_id"]
        postings.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{out}/postings")
        ids = self.spark.createDataFrame([], "doc_id string") if deleted is None else deleted.select("doc_id").distinct()
        ids.write.mode("overwrite").parquet(f"{out}/deleted")
        terms = term_stats(self.spark.read.schema(_POSTINGS).parquet(f"{out}/postings"))
        fields = [] if added is None else [field_stats(added, self.specs)]
        if deleted is not None:
            gone = deleted.dropDuplicates(["doc_id"])
            less = term_stats(build_postings(gone, self.specs)).select("field", "term", (-F.col("df")).alias("df"), (-F.col("cf")).alias("cf"))
            terms = _summed(terms.unionByName(less), ["field", "term"], ["df", "cf"])
            out_of = field_stats(gone, self.specs)
            fields.append(out_of.select("field", (-F.col("n_docs")).alias("n_docs"), (-F.col("total_len")).alias("total_len")))
        order = ["field", "term"]
        terms.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{out}/terms")
        added_terms = self.spark.read.schema(_TERMS).parquet(f"{out}/terms").where("df > 0")
        order = ["field", "gram", "term"]
        grams = term_grams(added_terms, self.specs).repartitionByRange(*order).sortWithinPartitions(*order)
        grams.write.mode("overwrite").parquet(f"{out}/grams")
        whole = _summed(reduce(DataFrame.unionByName, fields), ["field"], ["n_docs", "total_len"])
        whole.write.mode("overwrite").parquet(f"{out}/fields")
        if len(self._folders()) > self.most_segments:
            self.merge()
        return k

    def index(self) -> Index:
        """All segments as one index."""
        folders = self._folders()
        if not folders:
            raise ValueError(f"no segments under {self.path}")

        def union(table: str, schema: str) -> DataFrame:
            parts = [
                self.spark.read.schema(schema).parquet(f"{f}/{table}").withColumn("_segment", F.lit(k))
                for k, f in folders
                if path_exists(self.spark, f"{f}/{table}")
            ]
            return reduce(DataFrame.unionByName, parts)

        postings = union("postings", _POSTINGS)
        if any("/seg=" in f for _, f in folders):
            deleted = union("deleted", "doc_id string").groupBy(F.col("doc_id").alias("_id")).agg(F.max("_segment").alias("_until"))
            # A document may come back in the segment that deletes it, or later.
            gone = (F.col("doc_id") == F.col("_id")) & (F.col("_segment") < F.col("_until"))
            postings = postings.join(deleted, gone, "left_anti")
        terms = _summed(union("terms", _TERMS), ["field", "term"], ["df", "cf"]).where("df > 0")
        fields = _summed(union("fields", _FIELDS), ["field"], ["n_docs", "total_len"]).where("n_docs > 0")
        grams = union("grams", "field string, gram string, term string").drop("_segment").distinct()
        return Index(postings.drop("_segment"), terms, fields, self.specs, grams)

    def merge(self) -> None:
        """One index of all segments, beside them; the next reading starts from it."""
        replace(self.index(), grams=None).write(f"{self.path}/merged={self.last()}")


def _summed(rows: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
