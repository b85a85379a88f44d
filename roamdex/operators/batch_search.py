"""Search for a table of queries at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roamdex import fixed
from roamdex.functions import text
from roamdex.operators.postings import Index
from roamdex.operators.search import PHRASE, TERM, Clause, all_of, best_first, idf, search, tf_norm
from roamdex.session import cut_lineage

# Documents in a block of the impact table, about.
BLOCK_DOCS = 64
# Bounds are compared with this much room for the order in which parts are added up.
SLACK = 1e-6
# A table of at most so many rows, made of queries and not of documents, is broadcast, so that postings stay where they are.
SMALL_ROWS = 200_000


def _beside(side: DataFrame, rows: int) -> DataFrame:
    """One side of a join with postings, to be broadcast if ``rows``, which it has at most, are few."""
    return F.broadcast(side) if rows <= SMALL_ROWS else side


def last_word_terms(keywords: DataFrame, keyword: str = "keyword") -> DataFrame:
    """``keyword, term``: the tokens of the last word that has any, the only required word of a keyword query."""
    words = keywords.select(F.col(keyword).alias("keyword")).distinct()
    return words.select("keyword", F.explode(text.last_word_tokens(F.col("keyword"))).alias("term")).distinct()


def hit_counts(
    index: Index,
    keywords: DataFrame,
    prefix: str = fixed.COUNT_LINK_PREFIX,
    field: str = "title",
    prefix_field: str = "link",
) -> DataFrame:
    """``keyword, hits``: documents with the keyword's last word in ``field`` and a link under ``prefix``.

    Keywords without hits are kept with 0. Postings are cut to the asked terms first, and links are looked up for their
    documents only.
    """
    wanted = cut_lineage(last_word_terms(keywords))  # read four times below, a row or two per keyword
    postings = index.postings.select("field", "term", "doc_id")
    titles = postings.filter(F.col("field") == field).select("term", "doc_id")
    linked = postings.filter((F.col("field") == prefix_field) & F.startswith("term", F.lit(prefix))).select("doc_id")
    found = cut_lineage(titles.join(wanted, "term", "left_semi").join(linked, "doc_id", "left_semi").select("term", "doc_id"))
    # Almost every keyword asks for one term, whose count is the same for all keywords that ask for it, so
    # postings are counted per term and never multiplied by keywords. Only a last word of several tokens
    # needs its documents made distinct.
    sizes = wanted.groupBy("keyword").agg(F.count(F.lit(1)).alias("k"), F.min("term").alias("term"))
    per_term = found.groupBy("term").agg(F.count(F.lit(1)).alias("hits"))
    one = sizes.filter("k = 1").join(per_term, "term").select("keyword", "hits")
    several = sizes.filter("k > 1").select("keyword").join(wanted, "keyword")
    documents = several.join(found, "term").select("keyword", "doc_id").distinct()
    counts = one.unionByName(documents.groupBy("keyword").agg(F.count(F.lit(1)).alias("hits")))
    return (
        keywords.select(F.col("keyword"))
        .distinct()
        .join(counts, "keyword", "left")
        .select("keyword", F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits"))
    )


def asked_postings(index: Index, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries with their terms' weights, and the postings of the asked terms with their part of a score.

    Both are stored: ``query_id, field, term, boost, required, needed, df, most`` (``most`` is the largest part that any
    document gets from the term) and ``field, term, block, doc_id, part``. The postings are read, or counted, once. Blocks
    are made of documents by a hash, so that a term that many documents have is spread over many keys.
    """
    asked = queries.groupBy("query_id", "field", "term").agg(
        F.max(F.col("required").cast("int")).alias("required"), F.count(F.lit(1)).alias("boost")
    )
    needed = asked.groupBy("query_id").agg(F.sum("required").alias("needed"))
    asked = cut_lineage(asked.join(needed, "query_id"))
    found, fields = index.asked(asked.select("field", "term").distinct())
    # All postings of an asked term are here, so their number is its document count.
    df = cut_lineage(found.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df")))
    fields = cut_lineage(fields)
    blocks = -(-(fields.agg(F.max("n_docs")).first()[0] or 1) // BLOCK_DOCS)
    weighed = found.join(_beside(df, df.count()), ["field", "term"]).join(F.broadcast(fields), "field")  # one row per field
    part = idf(F.col("n_docs"), F.col("df")) * tf_norm(F.col("tf"), F.col("doc_len"), F.col("total_len") / F.col("n_docs"))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks))
    parts = cut_lineage(weighed.select("field", "term", block.alias("block"), "doc_id", part.alias("part"), "df"))
    bounds = parts.groupBy("field", "term").agg(F.max("part").alias("most"), F.max("df").alias("df"))
    return cut_lineage(asked.join(cut_lineage(bounds), ["field", "term"])), parts.drop("df")


def impact_blocks(parts: DataFrame) -> DataFrame:
    """``field, term, block, most``: the largest part of a term's postings in each block of documents, dealt by block.

    So a block's bounds are added up where its rows lie.
    """
    return cut_lineage(parts.repartition("block").groupBy("field", "term", "block").agg(F.max("part").alias("most")))


def floors(asked: DataFrame, parts: DataFrame, n: int) -> DataFrame:
    """``query_id, floor``: a score that a query's best ``n`` documents at least reach, where it has as many.

    The query's rarest terms, as many as it takes to have some times ``n`` postings, choose ``n`` documents; these are scored
    by all their terms, and the least of their scores is the floor.
    """
    rising = Window.partitionBy("query_id").orderBy("df", "field", "term")
    before = F.coalesce(F.sum("df").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rare = asked.where("needed = 0").withColumn("_before", before).where(F.col("_before") < 4 * n)
    met = parts.join(_beside(rare.select("query_id", "field", "term", "boost"), asked.count()), ["field", "term"])
    scores = met.groupBy("query_id", "doc_id").agg(F.sum(F.col("boost") * F.col("part")).alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    chosen = cut_lineage(
        scores.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= n).select("query_id", "doc_id")
    )
    whole = parts.join(_beside(chosen, chosen.count()), "doc_id").join(asked, ["query_id", "field", "term"])
    scored = whole.groupBy("query_id", "doc_id").agg(F.sum(F.col("boost") * F.col("part")).alias("score"))
    return cut_lineage(scored.groupBy("query_id").agg(F.when(F.count(F.lit(1)) == n, F.min("score")).alias("floor")))


def live_blocks(asked: DataFrame, impacts: DataFrame, floor: DataFrame) -> DataFrame:
    """``query_id, block``: the blocks in which one of a query's best documents can be.

    A document's score is at most the sum of its block's largest parts of the query's terms. Blocks under the floor are
    passed over, as are those that lack a required term.
    """
    wanted = asked.select("query_id", "field", "term", "boost", "required", "needed")
    bounds = impacts.join(_beside(wanted, asked.count()), ["field", "term"]).groupBy("query_id", "block").agg(
        F.sum(F.col("boost") * F.col("most")).alias("most"), F.sum("required").alias("got"), F.max("needed").alias("needed")
    )
    bounds = bounds.where(F.col("got") == F.col("needed")).join(floor, "query_id", "left")
    return cut_lineage(bounds.where(F.col("most") >= F.coalesce("floor", F.lit(0.0)) - SLACK).select("query_id", "block"))


def _searched(asked: DataFrame, floor: DataFrame) -> DataFrame:
    """``query_id, field, term``: terms of which a document must have one to be among a query's best.

    Terms whose largest parts together stay under the floor cannot lift a document to it by themselves. Required terms do
    it alone, the rarest of them.
    """
    by_part = Window.partitionBy("query_id").orderBy(F.col("boost") * F.col("most"), "field", "term")
    together = F.sum(F.col("boost") * F.col("most")).over(by_part.rowsBetween(Window.unboundedPreceding, 0))
    optional = asked.where("needed = 0").withColumn("_together", together).join(floor, "query_id", "left")
    lifting = optional.where((F.col("_together") >= F.coalesce("floor", F.lit(0.0)) - SLACK))
    rising = Window.partitionBy("query_id").orderBy("df", "field", "term")
    required = asked.where("required = 1").withColumn("_turn", F.row_number().over(rising)).where("_turn = 1")
    keys = ["query_id", "field", "term"]
    return lifting.select(*keys).unionByName(required.select(*keys))


def _candidates(asked: DataFrame, parts: DataFrame, floor: DataFrame, live: DataFrame) -> DataFrame:
    in_live = live.join(_searched(asked, floor), "query_id")
    return parts.join(in_live, ["field", "term", "block"]).select("query_id", "doc_id").distinct()


def candidates(asked: DataFrame, parts: DataFrame, n: int) -> DataFrame:
    """``query_id, doc_id`` of the documents that can be among a query's best ``n``: in a live block, with a searched term."""
    floor = floors(asked, parts, n)
    return _candidates(asked, parts, floor, live_blocks(asked, impact_blocks(parts), floor))


def search_batch(index: Index, queries: DataFrame, n: int | None = None, must: Sequence[Clause] = ()) -> DataFrame:
    """``query_id, doc_id, score, rank`` for ``queries(query_id, field, term, required)``.

    ``term`` is analysed. All required terms of a query must match, any other term adds to the score; with
    none required any term will do. With ``n`` the best n hits of each query are kept, and only postings in blocks that
    can hold them are joined. Without, ``rank`` is null: all hits, in no order. ``must`` are clauses that hold for all queries
    (a link prefix, say), of the kinds that score a constant; a document has to match each of them.
    """
    if any(c.kind in (TERM, PHRASE) for c in must):
        raise ValueError("clauses for all queries are prefixes, wildcards, fuzzy words or ranges")
    asked, parts = asked_postings(index, queries)
    if must:
        allowed = cut_lineage(search(index, all_of(*must)).select("doc_id"))
        parts = cut_lineage(parts.join(allowed, "doc_id", "left_semi").select(*parts.columns))
    wanted = asked.select("query_id", "field", "term", "boost", "required", "needed")
    if n:
        floor = floors(asked, parts, n)
        live = live_blocks(asked, impact_blocks(parts), floor)
        pairs = cut_lineage(_candidates(asked, parts, floor, live))
        if asked.count() <= SMALL_ROWS:
            # Dealt by block, a document's postings lie together, and its parts are added up there.
            of_block = live.groupBy("block").agg(F.collect_list("query_id").alias("_live"))
            matched = parts.repartition("block").join(of_block, "block").join(F.broadcast(wanted), ["field", "term"])
            matched = matched.where(F.array_contains("_live", F.col("query_id")))
        else:
            matched = parts.join(live.join(wanted, "query_id"), ["field", "term", "block"])
    else:
        matched = parts.join(wanted, ["field", "term"])
    hits = (
        matched.groupBy("query_id", "block", "doc_id")
        .agg(
            F.sum(F.col("boost") * F.col("part")).alias("score"), F.sum("required").alias("got"), F.max("needed").alias("needed")
        )
        .filter(F.col("got") == F.col("needed"))
        .select("query_id", "doc_id", (F.col("score") + F.lit(float(sum(c.boost for c in must)))).alias("score"))
    )
    if not n:
        return hits.withColumn("rank", F.lit(None).cast("int"))
    hits = hits.join(pairs, ["query_id", "doc_id"], "left_semi")
    order = Window.partitionBy("query_id").orderBy(*best_first())
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
