"""A training corpus from ``documents``, in five stages. Each takes what its predecessor kept and calls one operator.

Stages get ``(spark, docs, sf_dir)`` and return a DataFrame; all but the last return the columns of ``documents``. Each
is written as Parquet and read again before the next, so a lost executor costs no more than the stage it hit.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from roamdex.llm import mixing, packing, quality, simhash, substring
from roamdex.session import shared_folder


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: three-word shingles, fingerprints at 3 or fewer differing bits."""
    return simhash.keep_one(docs, shingle=3, most_bits=3)


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines and passages that an earlier document, or an earlier place, already has."""
    return substring.keep_first_lines(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document taken in several epochs is as many rows."""
    return mixing.mix_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents by training sequence: ``doc_id, piece, start, size, bin_id, bin_offset, capacity``."""
    return packing.pack(mixing.document_sizes(docs).select("doc_id", "size"))


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_near_copies),
    ("substring dedup", first_lines),
    ("mixing sources", mixed_sources),
    ("best-fit packing", packed),
]

# The scorer of the first stage is fitted by iteration, and packing is sequential: neither is SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Tables between stages go to the shared folder of the session."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
