"""Crawl frontier as tables: ``frontier(url, queue_rank, round, seq)`` and ``visited(url)``.

A URL is in at most one of the two. Queue rank 0 goes first; within a queue, URLs go by the round they were
queued in, then by their place ``seq`` in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roamdex.functions import urls
from roamdex.operators.joins import keyed_join, without
from roamdex.operators.ordered import range_of
from roamdex.session import cut_lineage

COLUMNS = ("url", "queue_rank", "round", "seq")
ORDER = ("queue_rank", "round", "seq", "url")


def first_seen(rows: DataFrame, *keys: str) -> DataFrame:
    """Keep the first place of each key, combined map-side. Repeats of a key come from one round."""
    first = [F.min(c).alias(c) for c in ("round", "seq") if c in rows.columns]
    return rows.groupBy(*(keys or ("url",))).agg(*first)


def _ranked(rows: DataFrame, priority_host: str, round_no: int) -> DataFrame:
    rank = urls.queue_rank(F.col("url"), priority_host).alias("queue_rank")
    return rows.select("url", rank, F.lit(round_no).alias("round"), "seq")


def init_frontier(seeds: DataFrame, priority_host: str) -> DataFrame:
    """Frontier of round 0 from ``(url, seq)`` seeds."""
    return _ranked(first_seen(seeds), priority_host, 0)


def next_urls(frontier: DataFrame, n: int) -> DataFrame:
    """The next ``n`` URLs with their ``turn``: priority queue first, first in first out within a queue.

    Rows are counted by queue, round and range of places. Of these counts, a few hundred a round, running totals tell
    where each range begins; only ranges that begin before the n-th turn are ordered, each by itself, so no task
    orders a round.
    """
    ranged = frontier.withColumn("_range", range_of(frontier, "seq"))
    keys = ["queue_rank", "round", "_range"]
    counts = ranged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")).where(F.col("_before") < n)
    within = Window.partitionBy(*keys).orderBy("seq", "url")
    turn = (F.col("_before") + F.row_number().over(within)).cast("int").alias("turn")
    met = ranged.join(begins, keys)
    return met.select(*frontier.columns, turn).where(F.col("turn") <= n)


def numbered(taken: DataFrame) -> DataFrame:
    """``url, turn`` of the URLs of one round."""
    return taken.select("url", "turn")


def take(frontier: DataFrame, n: int) -> DataFrame:
    """``url, turn`` of the next ``n`` URLs, stored, as a round reads them several times."""
    return cut_lineage(numbered(next_urls(frontier, n)))


def fetched(pages: DataFrame, taken: DataFrame) -> DataFrame:
    """The pages of the taken URLs."""
    return pages.join(taken.select(urls.quote(F.col("url")).alias("link")), "link", "left_semi")


def found_links(taken: DataFrame, edges: DataFrame) -> DataFrame:
    """``(url, seq)`` of the links on the pages of ``taken(url, turn)``, as a one-by-one crawl would queue them.

    ``edges.src`` is the quoted URL a page was fetched under. The page's turn, the kind of link and the
    place on the page are packed in one bigint (31 bits of turn, 1 of kind, 31 of place). Taken URLs without
    a page (a failed fetch) add nothing.
    """
    src = taken.select(urls.quote(F.col("url")).alias("src"), "turn")
    place = (
        F.shiftleft(F.col("turn").cast("bigint"), 32)
        + F.shiftleft(F.col("kind").cast("bigint"), 31)
        + F.col("pos")
    )
    joined = edges.join(src, "src")
    return joined.select(F.col("dst").alias("url"), place.alias("seq"))


def unseen(
    candidates: DataFrame, visited: DataFrame, frontier: DataFrame, priority_host: str, round_no: int
) -> DataFrame:
    """Frontier rows for the ``(url, seq)`` candidates that were neither visited nor queued.

    Repeats are folded before any join, so a link found on a third of all pages is one row by then. The
    folded rows are unique in their URL, as are the known ones in theirs, so neither side has a hot key.
    """
    known = visited.select("url").unionByName(frontier.select("url"))
    return _ranked(without(first_seen(candidates), known, "url"), priority_host, round_no)


def frontier_step(
    frontier: DataFrame, visited: DataFrame, taken: DataFrame, edges: DataFrame, priority_host: str, round_no: int
) -> tuple[DataFrame, DataFrame]:
    """One crawl round: mark the URLs of ``take()`` visited and queue what their pages link to."""
    new_visited = visited.select("url").unionByName(taken.select("url"))
    new = unseen(found_links(taken, edges), visited, frontier, priority_host, round_no)
    left = frontier.join(taken.select("url"), "url", "left_anti").select(*COLUMNS)
    return left.unionByName(new), new_visited


def dedup_frontier(queue: DataFrame) -> DataFrame:
    """Drop repeats within a queue, keeping each URL's first place. Input ``(queue_rank, url, seq)``."""
    return first_seen(queue, "queue_rank", "url")


def reconcile(queue: DataFrame, visited: DataFrame, fetched_keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split the queue by what was fetched: fetched URLs become visited, the others stay queued.

    URLs are quoted first, as pages are stored under the key of the quoted URL. ``fetched_keys(url_key)``
    may hold repeats. One left join marks the rows for both outputs.
    """
    quoted = queue.withColumn("url", urls.quote(F.col("url")))
    first = first_seen(quoted, "queue_rank", "url")
    keys = fetched_keys.select("url_key").distinct().withColumn("_fetched", F.lit(True))
    marked = keyed_join(first.withColumn("url_key", urls.url_key(F.col("url"))), keys, "url_key", "left")
    stay = marked.filter(F.col("_fetched").isNull()).select(*first.columns)
    done = marked.filter(F.col("_fetched").isNotNull()).select("url")
    return stay, visited.select("url").unionByName(done).distinct()


def from_state(queue: DataFrame, visited: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Frontier of round 0 and visited set from a saved state with repeats: first places, without visited URLs.

    A URL in both queues stays in the first.
    """
    first = dedup_frontier(queue).groupBy("url").agg(F.min(F.struct("queue_rank", "seq")).alias("at"))
    rows = first.select("url", "at.queue_rank", F.lit(0).alias("round"), "at.seq")
    seen = visited.select("url").distinct()
    return without(rows, seen, "url").select(*COLUMNS), seen
