"""Crawl rounds with durable state.

State is append-only: ``queued/round=k/queue_rank=r`` holds the URLs queued in round k, ``visited/round=k`` those taken
in round k. A round writes only what it adds, each table's write cuts the lineage, and a killed job goes on
after the last whole round, whichever executors were lost.

URLs are taken in the queue's order, so where a queue stands is one row, its cursor (``cursors/round=k``): what waits is
what lies behind it, and of the rounds queued before the cursors' no file is read. Every URL ever queued is also in one
table bucketed by URL, which new links are looked up in without a shuffle of that table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from hashlib import md5
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roamdex.operators import frontier as fr
from roamdex.sources.readers import folder_names, path_exists

_SCHEMAS = {
    "queued": "url string, seq bigint, queue_rank int",
    "visited": "url string, turn int",
    "cursors": "queue_rank int, at_round int, at_seq bigint, at_url string",
}


def _behind(cursor) -> Column:
    """Places of a queue after its cursor."""
    here = (F.col("seq") > cursor["at_seq"]) | ((F.col("seq") == cursor["at_seq"]) & (F.col("url") > cursor["at_url"]))
    later = (F.col("round") > cursor["at_round"]) | ((F.col("round") == cursor["at_round"]) & here)
    # The first two tests are on folders alone: the reader passes over those that fail.
    return (F.col("queue_rank") == cursor["queue_rank"]) & (F.col("round") >= cursor["at_round"]) & later


@dataclass(frozen=True)
class CrawlState:
    """Tables of a crawl under one folder all executors share."""

    spark: SparkSession
    path: str

    def _folder(self, table: str, k: int) -> str:
        return f"{self.path}/{table}/round={k}"

    def _whole(self, table: str, k: int) -> bool:
        return path_exists(self.spark, f"{self._folder(table, k)}/_SUCCESS")

    def last_round(self) -> int:
        """Number of the last whole round, -1 before the seeds are in."""
        # The queue of a round is written after all others, so the last whole one is looked for from the end.
        rounds = sorted(int(n.removeprefix("round=")) for n in folder_names(self.spark, f"{self.path}/queued"))
        return next((k for k in reversed(rounds) if self._whole("queued", k)), -1)

    def _table(self, table: str, last: int, first: int = 0) -> DataFrame:
        schema = f"{_SCHEMAS[table]}, round int"
        folders = [self._folder(table, k) for k in range(first, last + 1) if self._whole(table, k)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{table}").parquet(*folders)

    def queued_ever(self, last: int) -> DataFrame:
        return self._table("queued", last)

    def visited(self, last: int) -> DataFrame:
        return self._table("visited", last)

    def cursors(self, last: int) -> list:
        """One row per queue that URLs were taken from: the place of the last one."""
        return self.spark.read.schema(_SCHEMAS["cursors"]).parquet(self._folder("cursors", last)).collect() if last > 0 else []

    def waiting(self, last: int) -> DataFrame:
        """The frontier: queued and not yet taken. Rounds that every queue has left behind are not read."""
        cursors = self.cursors(last)
        begun = [c["queue_rank"] for c in cursors]
        ranks = {int(n.removeprefix("queue_rank=")) for k in range(last + 1) for n in self._ranks(k)}
        first = min([c["at_round"] for c in cursors], default=0) if ranks <= set(begun) else 0
        rows = self._table("queued", last, first)
        return rows.where(reduce(or_, [_behind(c) for c in cursors], ~F.col("queue_rank").isin(begun))) if cursors else rows

    def _ranks(self, k: int) -> list[str]:
        return [n for n in folder_names(self.spark, self._folder("queued", k)) if n.startswith("queue_rank=")]

    def known_name(self) -> str:
        """Name of the table of known URLs in the session's catalog. Its files are in the crawl's own folder."""
        return f"crawl_known_{md5(self.path.encode()).hexdigest()[:16]}"

    def _known(self, last: int) -> DataFrame:
        """``url`` of all that was ever queued, as a table bucketed by URL.

        Rounds are added to it after they are whole; one that a killed job left out is added first. A round that was added
        twice does no harm.
        """
        name = self.known_name()
        place = f"{self.path}/known"
        # Fewer buckets than shuffle partitions would be shuffled all the same.
        marks = [n for n in folder_names(self.spark, f"{self.path}/known_buckets") if n.startswith("n=")]
        buckets = int(marks[0].removeprefix("n=")) if marks else int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if not marks:
            self.spark.range(1).write.mode("overwrite").parquet(f"{self.path}/known_buckets/n={buckets}")
        self.spark.sql(
            f"create table if not exists {name} (url string) using parquet clustered by (url) into {buckets} buckets location '{place}'"
        )
        for k in range(last + 1):
            if not path_exists(self.spark, f"{self.path}/known_rounds/round={k}/_SUCCESS"):
                rows = self.spark.read.schema(_SCHEMAS["queued"]).parquet(self._folder("queued", k)).select("url")
                rows.repartition(buckets, "url").write.mode("append").format("parquet").bucketBy(buckets, "url").option(
                    "path", place
                ).saveAsTable(name)
                self.spark.range(1).write.mode("overwrite").parquet(f"{self.path}/known_rounds/round={k}")
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def _write(self, df: DataFrame, table: str, k: int) -> None:
        writer = df.write.mode("overwrite")
        (writer.partitionBy("queue_rank") if table == "queued" else writer).parquet(self._folder(table, k))

    def start(self, seeds: DataFrame, priority_host: str) -> None:
        """Queue the ``(url, seq)`` seeds as round 0, unless that was done before."""
        if self.last_round() < 0:
            self._write(fr.init_frontier(seeds, priority_host).drop("round"), "queued", 0)

    def resume(self, frontier: DataFrame, visited: DataFrame) -> None:
        """Take over a saved state as round 0, unless this crawl has begun: ``readers.state_or_seeds`` gives both tables.

        The saved rounds become places of round 0, in their order.
        """
        if self.last_round() < 0:
            self._write(visited.select("url", F.lit(0).alias("turn")), "visited", 0)
            place = F.shiftleft(F.col("round").cast("bigint"), 40) + F.col("seq")
            self._write(frontier.select("url", "queue_rank", place.alias("seq")), "queued", 0)

    def run_round(self, edges: DataFrame, n: int, priority_host: str) -> int:
        """Take the next ``n`` URLs and queue what their pages link to. Gives the number taken."""
        last = self.last_round()
        k = last + 1
        # The queue is written last and makes the round whole; a half-done round is done again.
        self._write(fr.next_urls(self.waiting(last), n), "taken", k)
        taken = self.spark.read.schema("url string, seq bigint, queue_rank int, round int, turn int").parquet(self._folder("taken", k))
        self._write(fr.numbered(taken), "visited", k)
        ends = taken.groupBy("queue_rank").agg(F.max(F.struct("round", "seq", "url")).alias("at"))
        moved = ends.select("queue_rank", F.col("at.round").alias("at_round"), F.col("at.seq").alias("at_seq"), F.col("at.url").alias("at_url"))
        before = self.cursors(last)
        if before:
            kept = self.spark.createDataFrame([tuple(c) for c in before], _SCHEMAS["cursors"])
            moved = moved.unionByName(kept.join(moved.select("queue_rank"), "queue_rank", "left_anti"))
        self._write(moved.coalesce(1), "cursors", k)
        stored = self.spark.read.schema(_SCHEMAS["visited"]).parquet(self._folder("visited", k))
        count = stored.count()
        # Taken URLs are among those ever queued, but for those that a saved state had visited before.
        candidates = fr.found_links(stored, edges)
        new = fr.unseen(candidates, self.visited(0), self._known(last), priority_host, k)
        self._write(new.drop("round"), "queued", k)
        return count


def crawl(
    spark: SparkSession,
    path: str,
    seeds: DataFrame,
    edges: DataFrame,
    n: int,
    priority_host: str,
    max_rounds: int | None = None,
) -> CrawlState:
    """Run rounds until the queue is empty or ``max_rounds`` are done in this call."""
    state = CrawlState(spark, path)
    state.start(seeds, priority_host)
    done = 0
    while (max_rounds is None or done < max_rounds) and state.run_round(edges, n, priority_host):
        done += 1
    return state
