"""What the operators of this subpackage share: word counts, bounded Arrow batches, stored tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import roamdex
from roamdex.session import cut_lineage, shared_folder

# --- fixed value: a word is a run of anything but ASCII white space ---
WORD = r"[^\x20\x09-\x0D]+"

BATCH_ROWS = 2_000
BATCH_BYTES = 32 * 1024 * 1024


def word_count(text: Column) -> Column:
    """Words of a text as a bigint; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever the driver found it. Spark's file server hands out the archive."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(roamdex.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="roamdex-")) / "roamdex.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches small enough that a batch of very long texts fits beside the heap; the package on the workers."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: later plans read it and a lost executor costs a task, not a lineage."""
    return cut_lineage(df)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, for many narrow rows: a checkpoint holds them as they are in memory."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name in df.columns:
        name += "_"
    return name
