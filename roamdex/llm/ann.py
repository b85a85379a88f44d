"""Nearest neighbours by largest inner product: a forest of random-projection trees, one shared priority queue, exact reranking.

Inner products become angles by one more component, sqrt(M^2 - |x|^2) for rows and 0 for queries, with M the largest
norm. Every row is routed to one leaf of every tree. A query opens leaves of all trees from one queue, the likeliest to
hold a neighbour first; a leaf's likelihood follows from the query's distances to the thresholds on its path, from
how near its neighbours must be, and from their own last component, which all of them have and the query has not. It stops when a neighbour is missed by all trees with a probability under
``1 - RECALL``: where data are clustered that is after a few leaves, where they are not it takes many. Rows of the opened
leaves are compared exactly, in double precision. A query that finds fewer than it asks for opens all leaves of one tree.

The nearness asked for is read off a bounded sample of rows (``SAMPLE_ROWS``), which also fits the trees. The sample's
rows also give each query a lower bound on what its nearest score, so that only rows that can be among them leave their
leaf.

Defined cases: rows whose vector is null, empty or zero, or holds null or non-finite components, or whose dimension is
not the commonest (of equals, the largest), are neither queries nor candidates; a query's own row is no candidate, but
other rows with its vector are; equal scores go to the smaller ``vec_id``; rows that repeat a ``vec_id`` count once, by
their best score; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamdex.llm.common import bounded_batches, stored
from roamdex.llm.rp_forest import SAMPLE_ROWS, Forest, as_matrix, drawn_vectors, fit_forest, usable

NEAREST = 20
TREES = 8
LEAF_ROWS = 256
MOST_DEPTH = 8
RECALL = 0.97
CHUNK_ROWS = 2048
#: A row leaves its leaf only if it beats the query's sample row at whose score about this many times ``k`` rows are
#: expected: several times ``k``, so that ``k`` are left where some are missed.
BOUND_RANKS = 5
#: Rows of the sample that are taken to be like a query's neighbours, at least.
LIKE_ROWS = 8
#: Queries in a part of a leaf, about; the rows of the leaf are copied to each part.
PART_QUERIES = 4096
SEED = 9


def _lifted(x: np.ndarray, largest: float) -> np.ndarray:
    """Rows on the unit sphere of one more dimension, in the order of inner products."""
    x = x / largest
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", x, x)))
    return np.concatenate([x, rest[:, None]], axis=1)


def _raised(q: np.ndarray) -> np.ndarray:
    q = q / np.linalg.norm(q, axis=1, keepdims=True)
    return np.concatenate([q, np.zeros((len(q), 1))], axis=1)


def opened_leaves(
    forest: Forest, q: np.ndarray, near: float, last: float = 0.0, recall: float = RECALL
) -> list[tuple[int, int]]:
    """(tree, leaf) in the order in which a query opens them, likeliest first over all trees.

    A neighbour is ``near`` times the query, ``last`` in the last component, where the query is 0, and for the rest of its
    length one in any direction. It lies on one side of a node with the probability that a normal variable with the mean
    and spread that follow exceeds the threshold.
    """
    d = q.shape[0]
    dots, up = np.einsum("tnd,d->tn", forest.directions, q), forest.directions[:, :, -1]
    rest = max(0.0, 1 - near * near - last * last)
    spread = np.sqrt(np.maximum(1e-9, rest * np.maximum(0.0, 1 - dots * dots - up * up) / max(1, d - 2)))
    z = (near * dots + last * up - forest.thresholds) / spread
    right = 0.5 * (1 + _erf(z / math.sqrt(2)))
    log_right, log_left = np.log(np.maximum(right, 1e-12)).tolist(), np.log(np.maximum(1 - right, 1e-12)).tolist()
    first = forest.leaves - 1
    queue = [(0.0, t, 0) for t in range(forest.trees)]
    missed, seen, out = 0.0, [0.0] * forest.trees, []
    stop = math.log(1 - recall)
    while queue and missed > stop:
        cost, t, node = heapq.heappop(queue)
        if node >= first:
            out.append((t, node - first))
            before = math.log(max(1e-9, 1 - seen[t]))
            seen[t] += math.exp(-cost)
            missed += math.log(max(1e-9, 1 - seen[t])) - before
            continue
        heapq.heappush(queue, (cost - log_left[t][node], t, 2 * node + 1))
        heapq.heappush(queue, (cost - log_right[t][node], t, 2 * node + 2))
    return out


def _erf(x: np.ndarray) -> np.ndarray:
    """Error function to 1.5e-7, by the rational approximation of Abramowitz and Stegun 7.1.26."""
    s, x = np.sign(x), np.abs(x)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return s * (1 - poly * np.exp(-x * x))


def nearest(
    vectors: DataFrame, is_query: Column, k: int = NEAREST, trees: int = TREES, recall: float = RECALL, seed: int = SEED
) -> DataFrame:
    """``vec_id, embedding`` -> ``query_id, rank, vec_id, score``: the ``k`` nearest of each row where ``is_query`` holds."""
    bounded_batches(vectors.sparkSession)
    rows = vectors.select("vec_id", F.col("embedding").cast("array<float>").alias("vector"), is_query.alias("asks"))
    rows = rows.where(usable("vector") & F.col("vec_id").isNotNull())
    squared = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(F.sqrt(squared)).alias("largest"))
    top = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    if top is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    d, total, largest = top["d"], top["n"], top["largest"]
    rows = stored(rows.where(F.size("vector") == d))
    sample = drawn_vectors(rows, "vec_id", "vector", total, SAMPLE_ROWS)
    sample = sample if len(sample) else np.zeros((0, d))
    depth = min(MOST_DEPTH, max(0, math.ceil(math.log2(max(1, total / LEAF_ROWS)))))
    raised = _lifted(sample, largest) if len(sample) else np.zeros((0, d + 1))
    forest, heights = fit_forest(raised, trees, depth, seed), raised[:, -1]
    # Place, in the sample, of a query's k-th neighbour among all; one more, for the query itself may be in the sample.
    at = min(len(sample), max(1, math.ceil(k * len(sample) / total)) + 1)
    # The sample's k-th best bounds the k-th of all from below. A larger sample leaves room for some times k above it.
    sure_at = max(k, math.ceil(BOUND_RANKS * k * len(sample) / total)) + 1

    def cells_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _lifted(as_matrix(batch.column("vector")), largest)
            for tree in range(forest.trees):
                own, leaves = forest.route(x, tree)
                some = batch.take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaves * forest.trees + tree), some.column("vec_id"), some.column("vector")],
                    ["cell", "vec_id", "vector"],
                )

    def opened(q: np.ndarray, everywhere: bool) -> Iterator[tuple[int, int, float]]:
        """Row, cell and lower bound of a candidate's score, for each leaf that a query opens."""
        if everywhere:
            yield from ((i, leaf * forest.trees, -math.inf) for i in range(len(q)) for leaf in range(forest.leaves))
            return
        scores = q @ sample.T
        best = np.argsort(-scores, axis=1, kind="stable")[:, : max(at, LIKE_ROWS)]
        # How high the rows like a query's neighbours are lifted.
        last = heights[best].mean(axis=1) if len(sample) else np.zeros(len(q))
        scores = -np.sort(-scores, axis=1)
        lengths = np.linalg.norm(q, axis=1)
        for i, lifted in enumerate(_raised(q)):
            near = scores[i, at - 1] / (lengths[i] * largest) if at else 0.0
            # The sample's rows are candidates too, so the k-th best of all is no worse than theirs.
            bound = scores[i, sure_at - 1] - 1e-9 * lengths[i] * largest if sure_at <= len(sample) else -math.inf
            near = float(np.clip(near, 0.0, math.sqrt(max(0.0, 0.9999 - last[i] ** 2))))
            for tree, leaf in opened_leaves(forest, lifted, near, float(last[i]), recall):
                yield i, leaf * forest.trees + tree, bound

    def cells_of_queries(everywhere: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 64):
                    some = batch.slice(a, 64)
                    found = list(opened(as_matrix(some.column("vector")), everywhere))
                    own, cells, least = (list(c) for c in zip(*found)) if found else ([], [], [])
                    taken = some.take(pa.array(own, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cells, pa.int64()), taken.column("vec_id"), taken.column("vector"), pa.array(least, pa.float64())],
                        ["cell", "vec_id", "vector", "least"],
                    )

        return run

    routed = rows.select("vec_id", "vector").mapInArrow(cells_of_rows, "cell bigint, vec_id bigint, vector array<float>")
    # One row per leaf of the forest. A leaf with many rows (copies of one vector) is cut into parts by a hash.
    parts = stored(routed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).cast("int").alias("parts")))
    dealt = routed.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    # No leaf is opened by more queries than there are, so this many parts bound what is together in one.
    asking = -(-rows.where("asks").count() // PART_QUERIES)
    turns = F.sequence(F.lit(0), F.lit(max(0, asking - 1)))

    def compare(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            x = np.stack(left["vector"].to_numpy()).astype(np.float64)
            ids = left["vec_id"].to_numpy()
            kept = k + len(ids) - len(np.unique(ids))  # a repeated id takes one place of the k
            for a in range(0, len(right), 512):
                some = right.iloc[a : a + 512]
                q = np.stack(some["vector"].to_numpy()).astype(np.float64)
                asking, least = some["vec_id"].to_numpy(), some["least"].to_numpy()
                scores = q @ x.T
                scores[asking[:, None] == ids[None, :]] = -np.inf
                if scores.shape[1] > kept:
                    # Ties with the k-th stay in, to be told apart by id.
                    least = np.maximum(least, np.partition(scores, -kept, axis=1)[:, -kept])
                i, j = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
                out.append(pd.DataFrame({"query_id": asking[i], "vec_id": ids[j], "score": scores[i, j]}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    def answers(queries: DataFrame, everywhere: bool) -> DataFrame:
        asked = queries.select("vec_id", "vector").mapInArrow(
            cells_of_queries(everywhere), "cell bigint, vec_id bigint, vector array<float>, least double"
        )
        spread = asked.join(F.broadcast(parts), "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        spread = spread.withColumn("turn", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, asking))).cast("int"))
        candidates = dealt.where(F.col("cell") % forest.trees == 0) if everywhere else dealt
        candidates = candidates.withColumn("turn", F.explode(turns))
        met = candidates.groupBy("cell", "part", "turn").cogroup(spread.groupBy("cell", "part", "turn")).applyInPandas(
            compare, "query_id bigint, vec_id bigint, score double"
        )
        best = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return ranked.select("query_id", "rank", "vec_id", "score")

    queries = rows.where("asks")
    first = stored(answers(queries, everywhere=False))
    whole = stored(first.groupBy("query_id").count().where(F.col("count") == k).select(F.col("query_id").alias("vec_id")))
    # The few queries that found less than they ask for open every leaf of one tree, which holds all rows.
    short = stored(queries.join(whole, "vec_id", "left_anti"))
    if short.isEmpty():
        return first
    kept = first.join(whole.select(F.col("vec_id").alias("query_id")), "query_id", "left_semi").select(*first.columns)
    return kept.unionByName(answers(short, everywhere=True))
