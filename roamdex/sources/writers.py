"""Writers."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roamdex.functions import urls
from roamdex.operators.pages import ranked
from roamdex.sources import readers


def write_infoboxes(rows: DataFrame, path: str) -> None:
    """JSON lines, replacing what was there."""
    rows.select("title", "mod_key", "mod_val").write.mode("overwrite").json(path)


def write_pages(pages: DataFrame, path: str, mode: str = "append") -> None:
    """Fetched pages as a packed store: few large files, where one file per page would swamp a listing.

    Rows lie in the order of their keys, so that a page is found by the key's range in the files' statistics.
    """
    rows = pages.select("url_key", "link", "raw")
    rows.repartitionByRange("url_key").sortWithinPartitions("url_key").write.mode(mode).parquet(path)


def pack_pages(spark: SparkSession, files: str, path: str) -> None:
    """A folder of crawled files, one per page, to a packed store. Keys are made of the URLs, whatever the files' names.

    The pages are kept on the executors' disks, so that each file is opened once: ranges are drawn from a pass of their own.
    """
    pages = readers.read_page_files(spark, files).withColumn("url_key", urls.url_key(F.col("link")))
    pages = pages.persist(StorageLevel.DISK_ONLY)
    try:
        write_pages(pages, path)
    finally:
        pages.unpersist()


# On a local or mounted folder each file would get a checksum file beside it, and each of the two a process that sets its
# mode. Other file systems do not look at these settings.
_PLAIN_LOCAL = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def write_page_files(pages: DataFrame, path: str) -> None:
    """One file per page, as a crawl leaves them: the URL line, then the HTML. Files are named by Spark."""
    pages.select("raw").write.options(**_PLAIN_LOCAL).option("lineSep", "\n").option("maxRecordsPerFile", 1).text(path)


def write_documents(documents: DataFrame, path: str, mode: str = "append") -> None:
    documents.write.mode(mode).parquet(path)


def write_gazetteer(gazetteer: DataFrame, path: str) -> None:
    """One name per line."""
    gazetteer.select("value").write.mode("overwrite").text(path)


def quoted(c: Column) -> Column:
    """A text between single quotes, or double ones where only single ones are in it; one line, with escapes."""
    plain = c
    for sign, escape in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        plain = F.replace(plain, F.lit(sign), F.lit(escape))
    double = F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"'))
    single = F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(double, F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(single)


def heading_lines(counts: DataFrame) -> DataFrame:
    """Ranked headings as text lines: ('name', count)."""
    return ranked(counts).select(F.format_string("(%s, %d)", quoted(F.col("heading")), "n").alias("value"))


def write_headings(counts: DataFrame, path: str) -> None:
    """Ranked headings, range-sorted over part files whose order is the rank order."""
    heading_lines(counts).write.mode("overwrite").text(path)


def write_state(frontier: DataFrame, visited: DataFrame, path: str) -> None:
    """Crawl state as two tables. ``path`` must not be the folder the inputs are read from."""
    frontier.write.mode("overwrite").parquet(f"{path}/frontier")
    visited.select("url").write.mode("overwrite").parquet(f"{path}/visited")


def write_state_json(
    queue: DataFrame, visited: DataFrame, path: str, priority_key: str = "priority", other_key: str = "other"
) -> None:
    """Crawl state as one JSON object: ``queue(queue_rank, url, seq)`` as a list per queue, visited URLs as names.

    The object is one file by its format, so one task writes it; it streams sorted rows, a string a line.
    """
    spark = queue.sparkSession
    rows = queue.select(F.least(F.col("queue_rank"), F.lit(1)).alias("part"), F.col("seq").cast("bigint").alias("seq"), "url")
    rows = rows.unionByName(visited.select(F.lit(2).alias("part"), F.lit(0).cast("bigint").alias("seq"), "url"))
    text = F.regexp_extract(F.to_json(F.array("url")), r"(?s)^\[(.*)\]$", 1)
    firsts = rows.groupBy("part").agg(F.min(F.struct("seq", "url")).alias("first"))  # three rows
    marked = rows.join(F.broadcast(firsts), "part")
    comma = F.when((F.col("seq") == F.col("first.seq")) & (F.col("url") == F.col("first.url")), "").otherwise(", ")
    body = marked.select(
        "part", F.lit(1).alias("place"), "seq", "url",
        F.concat(comma, text, F.when(F.col("part") == 2, ": true").otherwise("")).alias("value"),
    )
    heads = [f'{{"{priority_key}": [', f'], "{other_key}": [', '], "visited": {', "}}"]
    frame = spark.createDataFrame([(k, 0, 0, "", h) for k, h in enumerate(heads)], "part int, place int, seq bigint, url string, value string")
    whole = body.distinct().unionByName(frame).coalesce(1).sortWithinPartitions("part", "place", "seq", "url")
    whole.select("value").write.mode("overwrite").text(path)
