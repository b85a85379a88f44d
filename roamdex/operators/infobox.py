"""Dump pages to infobox key/value pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamdex import fixed
from roamdex.functions import text

_MAX = 2**31 - 1


def infobox_pairs(dump: DataFrame, title: str = "title", body: str = "body") -> DataFrame:
    """``title, mod_key, mod_val`` for the pages that have infobox lines.

    The filter stops at a page's first line; the pairs are then read in one pass over the text, each line
    being cut at its first equals sign.
    """
    lines = dump.filter(F.col(body).rlike(fixed.INFOBOX_LINE)).select(
        F.col(title).alias("title"),
        F.transform(
            F.regexp_extract_all(F.col(body), F.lit(fixed.INFOBOX_LINE), F.lit(0)),
            lambda line: F.split(line, "=", 2),
        ).alias("_pairs"),
    )
    return lines.select(
        "title",
        F.transform("_pairs", lambda p: text.clean_infobox(F.substring(p[0], 3, _MAX))).alias("mod_key"),
        F.transform("_pairs", lambda p: text.clean_infobox(p[1])).alias("mod_val"),
    )


def named_in(rows: DataFrame, names: DataFrame, key: str = "title", name: str = "value") -> DataFrame:
    """Rows whose key is one of the names."""
    return rows.join(names.select(F.col(name).alias(key)), key, "left_semi")


def gazetteer_infoboxes(
    dump: DataFrame, gazetteer: DataFrame, title: str = "title", body: str = "body", name: str = "value"
) -> DataFrame:
    """Infobox pairs of the dump pages the gazetteer names.

    The pairs are taken first, so that page texts never move, whichever join Spark chooses for the names.
    """
    names = gazetteer.select(F.col(name).alias("value")).filter(F.col("value") != "")
    return named_in(infobox_pairs(dump, title, body), names)


def with_map(rows: DataFrame) -> DataFrame:
    """Add ``kv``, the pairs as a map; the last of several equal keys wins.

    Sorting the pairs of a row by (key, position) brings equal keys together, so the winner is the one
    whose successor has another key. A key without a value is an error; surplus values are not looked at.
    """
    # Three projections: each array is worked out once and then only looked up.
    short = F.raise_error(F.concat(F.lit("fewer values than keys in the infobox of "), F.coalesce("title", F.lit("null"))))
    pairs = rows.withColumn("_n", F.when(F.size("mod_val") < F.size("mod_key"), short.cast("int")).otherwise(F.size("mod_key")))
    pairs = pairs.withColumn(
        "_sorted",
        F.sort_array(
            F.transform(
                F.slice("mod_key", 1, F.col("_n")),
                lambda k, i: F.struct(k.alias("key"), i.alias("pos"), F.get("mod_val", i).alias("value")),
            )
        ),
    )
    last = F.filter(
        "_sorted", lambda e, i: F.coalesce(F.get("_sorted", i + 1)["key"] != e["key"], F.lit(True))
    )
    entries = F.transform(last, lambda e: F.struct(e["key"], e["value"]))
    return pairs.withColumn("kv", F.map_from_entries(entries)).drop("_n", "_sorted")
