"""Readers: crawled pages, encyclopedia dump, name lists, infobox rows, crawl state."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roamdex import fixed
from roamdex.functions import text

# Only the parts of a dump page that are used, so the XML reader needs no inference pass and parses little.
DUMP_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField(
            "revision",
            T.StructType(
                [T.StructField("text", T.StructType([T.StructField("_VALUE", T.StringType())]))]
            ),
        ),
    ]
)

# A text element without attributes is read as a plain string.
DUMP_SCHEMA_PLAIN = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("revision", T.StructType([T.StructField("text", T.StringType())])),
    ]
)

INFOBOX_SCHEMA = "title string, mod_key array<string>, mod_val array<string>"


def read_dump(
    spark: SparkSession, path: str, row_tag: str = "page", encoding: str = "UTF-8", plain_text: bool = False
) -> DataFrame:
    """``title, body`` of the pages of a MediaWiki XML dump.

    White space is kept, as an infobox line on a text's first line is known by the line feed before it.
    ``plain_text`` is for dumps whose text elements carry no attributes.
    """
    reader = (
        spark.read.format("xml")
        .schema(DUMP_SCHEMA_PLAIN if plain_text else DUMP_SCHEMA)
        .option("rowTag", row_tag)
        .option("encoding", encoding)
        .option("ignoreSurroundingSpaces", "false")
    )
    body = "revision.text" if plain_text else "revision.text._VALUE"
    return reader.load(path).select("title", F.col(body).alias("body"))


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """``url_key, link, raw`` of a folder of crawled files (URL line, then HTML), one row per file."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("url_key"), text.newlines(F.col("value")).alias("raw")
    )
    return files.select("url_key", text.first_line(F.col("raw")).alias("link"), "raw")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages written by ``writers.write_pages``."""
    return spark.read.parquet(path).select("url_key", "link", "raw")


def find_pages(spark: SparkSession, path: str, url_keys: list[str]) -> DataFrame:
    """The pages of some keys: the reader passes over all files and row groups of the store whose keys lie elsewhere."""
    return read_pages(spark, path).where(F.col("url_key").isin(url_keys))


def fetched_keys(pages: DataFrame) -> DataFrame:
    """Keys of the pages that were fetched."""
    return pages.select("url_key").distinct()


def listed_keys(spark: SparkSession, path: str) -> DataFrame:
    """Keys of a folder of crawled files, without reading their content."""
    return spark.read.format("binaryFile").load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("url_key")
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value``: stripped lines, in a gazetteer's or keyword list's layout."""
    return spark.read.text(path).select(text.strip(F.col("value")).alias("value"))


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    """``keyword``: stripped lines, each once."""
    return read_lines(spark, path).select(F.col("value").alias("keyword")).distinct()


def read_names(spark: SparkSession, path: str) -> list[str]:
    """Quoted names of a heading list, in file order. Either quote is taken, and escapes are undone.

    The list steers how the page plan is put together, so it is read to the driver; it is written by hand
    and a few dozen lines long. It is read as one file, which keeps its order.
    """
    whole = spark.read.text(path, wholetext=True).select(
        F.explode(F.regexp_extract_all("value", F.lit(fixed.QUOTED_NAME), F.lit(0))).alias("name")
    )
    signs = {"n": "\n", "r": "\r", "t": "\t"}
    return [re.sub(r"\\(.)", lambda m: signs.get(m[1], m[1]), r["name"][1:-1]) for r in whole.collect()]


def seed_urls(spark: SparkSession, path: str, base_url: str) -> DataFrame:
    """``url, seq`` of a seed list: base URL and stripped line, numbered in file order.

    A seed list is short; it is read as one file, which keeps its order.
    """
    lines = spark.read.text(path, wholetext=True).select(
        F.posexplode(F.split(F.regexp_replace(text.newlines(F.col("value")), r"\n\z", ""), "\n")).alias("seq", "line")
    )
    return lines.select(
        F.concat(F.lit(base_url), text.strip(F.col("line"))).alias("url"), F.col("seq").cast("bigint").alias("seq")
    )


def read_infoboxes(spark: SparkSession, path: str) -> DataFrame:
    """``title, mod_key, mod_val`` of the ``*.json`` files of a folder; a missing folder is an error."""
    return spark.read.schema(INFOBOX_SCHEMA).option("pathGlobFilter", "*.json").json(path)


#: What stands between two strings of a state file as it is written, one line with a blank after each comma.
_BETWEEN = ', "'
_STRING = r'(?:[^"\\]|\\.)*+'
# A key and the opening of its list or object. The first one has the object's opening before it.
_KEY = rf'(?s)^(?:\{{\s*")?({_STRING})":\s*[\[{{]'
# A record is a string without its first quote, and what follows: nothing, a value, a new list with or without its
# first string; and the ends of lists and objects.
_RECORD = (
    rf'(?s)^(?:\{{\s*")?{_STRING}"(?::\s*(?:true|false)|:\s*[\[{{]\s*(?:"{_STRING}"(?::\s*(?:true|false))?)?)?[\s\]}}]*$'
)


def read_state_json(
    spark: SparkSession, path: str, priority_key: str = "priority", other_key: str = "other"
) -> tuple[DataFrame, DataFrame]:
    """``queue(queue_rank, url, seq)`` and ``visited(url)`` of a crawl state file, repeats included.

    A state file is one JSON object with a list per queue and an object whose names are the visited URLs. It is read
    in splits, a row per string: the comma between two strings ends a record. The few records that hold a key tell
    where each list begins; a URL belongs to the last key before it. ``seq`` rises with the place in the file. A file
    that is laid out otherwise, or has a string that looks like the end of one, is read as one object.
    """
    records = spark.read.option("lineSep", _BETWEEN).text(path)
    # Splits by where they begin in the file, rows of a split as they come.
    records = records.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"), "value",
    )
    shape = records.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col("value").rlike(_RECORD)).alias("fits"), F.count_distinct("_file").alias("files")
    ).first()
    if not shape["fits"] or shape["files"] != 1:
        return _read_whole_state(spark, path, priority_key, other_key)
    first_rows = records.groupBy("_block").agg(F.min("_row").alias("_first"))  # a row per split
    placed = records.join(F.broadcast(first_rows), "_block")
    # A record takes a byte and more, so places of a split stay below the next one's.
    placed = placed.select((F.col("_block") + F.col("_row") - F.col("_first")).alias("seq"), "value")
    has_key = F.col("value").rlike(_KEY)
    marks = placed.where(has_key).select("seq", F.regexp_extract("value", _KEY, 1).alias("key")).collect()
    section, begin, begins = F.lit(None).cast("string"), F.lit(0), {}
    for mark in sorted(marks, key=lambda m: m["seq"]):
        behind = F.col("seq") >= mark["seq"]
        section = F.when(behind, F.lit(mark["key"])).otherwise(section)
        begin = F.when(behind, F.lit(begins.setdefault(mark["key"], mark["seq"]))).otherwise(begin)
    # The string of a record that holds a key is the one after the key; an empty list has none.
    own = F.when(has_key, F.concat(F.lit("\n"), F.regexp_replace("value", _KEY, ""))).otherwise(F.concat(F.lit('"'), "value"))
    raw = F.regexp_extract(own, rf'(?s)^\s*"({_STRING})"', 1)
    strings = placed.where(own.rlike(r'^\s*"')).select(section.alias("_key"), raw.alias("_raw"), (F.col("seq") - begin).alias("seq"))
    plain = F.get(F.from_json(F.concat(F.lit('["'), "_raw", F.lit('"]')), "array<string>"), F.lit(0))
    urls = F.when(F.contains("_raw", F.lit("\\")), plain).otherwise(F.col("_raw"))
    strings = strings.select("_key", urls.alias("url"), F.col("seq").cast("bigint").alias("seq"))
    rank = F.when(F.col("_key") == priority_key, 0).otherwise(1)
    queue = strings.where(F.col("_key").isin(priority_key, other_key)).select(rank.alias("queue_rank"), "url", "seq")
    return queue, strings.where(F.col("_key") == "visited").select("url")


def _read_whole_state(spark: SparkSession, path: str, priority_key: str, other_key: str) -> tuple[DataFrame, DataFrame]:
    """A state file as one row, whatever its layout."""
    schema = T.StructType(
        [
            T.StructField(priority_key, T.ArrayType(T.StringType())),
            T.StructField(other_key, T.ArrayType(T.StringType())),
            T.StructField("visited", T.MapType(T.StringType(), T.BooleanType())),
        ]
    )
    state = spark.read.schema(schema).option("multiLine", True).json(path)
    parts = [
        state.select(F.lit(rank).alias("queue_rank"), F.posexplode(F.col(f"`{key}`")).alias("seq", "url"))
        for rank, key in enumerate((priority_key, other_key))
    ]
    queue = parts[0].unionByName(parts[1]).select("queue_rank", "url", F.col("seq").cast("bigint").alias("seq"))
    return queue, state.select(F.explode(F.map_keys("visited")).alias("url"))


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where it does not exist."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory()] if fs.exists(jpath) else []


def read_state(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Frontier and visited tables written by ``writers.write_state``."""
    return spark.read.parquet(f"{path}/frontier"), spark.read.parquet(f"{path}/visited")


def state_or_seeds(
    spark: SparkSession,
    state_path: str,
    seeds_path: str,
    base_url: str,
    priority_host: str,
    state_keys: tuple[str, str] = ("priority", "other"),
) -> tuple[DataFrame, DataFrame]:
    """Saved state where there is one, as tables or as a JSON file, else a fresh frontier from the seeds."""
    from roamdex.operators.frontier import from_state, init_frontier

    if path_exists(spark, f"{state_path}/frontier"):
        return read_state(spark, state_path)
    if path_exists(spark, state_path):
        return from_state(*read_state_json(spark, state_path, *state_keys))
    seeds = seed_urls(spark, seeds_path, base_url)
    return init_frontier(seeds, priority_host), spark.createDataFrame([], "url string")
