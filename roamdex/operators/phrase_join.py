"""Title-phrase join: a phrase meets every document whose title has its tokens in a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamdex.functions import text
from roamdex.session import cut_lineage


def phrase_of(title: Column) -> Column:
    """Tokens of an infobox title after query clean-up, joined by single spaces."""
    return F.array_join(text.tokens(text.drop_query_specials(title)), " ")


def title_phrase_join(
    phrases: DataFrame,
    documents: DataFrame,
    phrase_title: str = "title",
    doc_id: str = "doc_id",
    doc_title: str = "title",
) -> DataFrame:
    """Pairs ``(phrase_title, doc_id)``; phrases without tokens match nothing.

    Phrases and titles meet on one token of the phrase, the one that the fewest titles have, and are then checked for the
    tokens in a row. A title gives a row per different token, whatever the lengths of the phrases; a frequent token is
    met only by phrases that have no rarer one. Phrases of one token need no check.
    """
    # Titles and their phrases are read several times below, so they are stored; they are short and few beside
    # the rows they come from.
    named = cut_lineage(
        phrases.select(F.col(phrase_title).alias("title"))
        .distinct()
        .select("title", phrase_of(F.col("title")).alias("phrase"))
    ).filter(F.col("phrase") != "")
    titles = documents.select(F.col(doc_id).alias("doc_id"), text.tokens(F.col(doc_title)).alias("tokens"))
    titles = cut_lineage(titles.filter(F.size("tokens") > 0))
    held = titles.select("doc_id", F.explode(F.array_distinct("tokens")).alias("token"))
    wanted = named.select("phrase").distinct().select("phrase", F.explode(F.array_distinct(F.split("phrase", " "))).alias("token"))
    # Only tokens that phrases have are counted; a phrase with a token that no title has is out.
    asked = cut_lineage(wanted.select("token").distinct())
    df = cut_lineage(held.join(asked, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("df")))
    met = wanted.join(df, "token", "left")
    rarest = met.groupBy("phrase").agg(
        F.min(F.struct("df", "token")).alias("r"), F.min(F.col("df").isNotNull()).alias("all_held")
    )
    rarest = cut_lineage(rarest.where("all_held").select("phrase", F.col("r.token").alias("token")))
    candidates = held.join(rarest, "token").select("doc_id", "phrase")
    several = F.contains("phrase", F.lit(" "))
    padded = titles.select("doc_id", F.concat(F.lit(" "), F.array_join("tokens", " "), F.lit(" ")).alias("words"))
    checked = candidates.where(several).join(padded, "doc_id")
    checked = checked.where(F.contains("words", F.concat(F.lit(" "), F.col("phrase"), F.lit(" ")))).select("doc_id", "phrase")
    pairs = candidates.where(~several).unionByName(checked)
    return pairs.join(named, "phrase").select("title", "doc_id", "phrase")
