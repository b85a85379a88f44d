"""Near-duplicate vectors by a forest of random-projection trees with spill.

Equal vectors are one class. Classes that lie close together are gathered into balls: all members are within half the
linking angle of the ball's centre, so any two of them are linked without being compared, and a group of near copies
of any size is one ball or a few. Balls go down every tree, both ways near a threshold, and are compared within leaves.
Two balls whose members must all be linked count so; where only some may be, the members are compared exactly, in
double precision. Links found are joined into components over balls.

Recall is that of the forest: a pair is missed where it is parted in all ``TREES`` trees. What is found is exact.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; so do
those whose dimension is not the commonest (of equals, the largest); rows that repeat a vector are linked with each
other, those that repeat a ``vec_id`` as well are each a row of the result; an empty table gives no rows; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamdex.llm.common import bounded_batches, stored
from roamdex.llm.components import components
from roamdex.llm.rp_forest import Forest, as_matrix, drawn_vectors, fit_forest, usable

COSINE = 0.95
TREES = 8
SPILL = 0.1
LEAF_ROWS = 512
GROUP_ROWS = 2048
SEED = 6
# Angles nearer than this to a bound are left to the exact comparison.
_SLACK = 1e-4


def gather_balls(x: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ball of each unit row, and the balls' centres and radii (angles, at most ``half``)."""
    ball = np.full(len(x), -1)
    centres, radii = [], []
    close = np.cos(half)
    near_all = x @ x.T >= close
    alone = near_all.sum(axis=1) == 1
    for i in range(len(x)):
        if ball[i] >= 0:
            continue
        own, centre, radius = np.array([i]), x[i], 0.0
        if not alone[i]:
            near = np.flatnonzero(near_all[i] & (ball < 0))
            mean = x[near].mean(axis=0)
            mean /= np.linalg.norm(mean)
            cosines = x @ mean
            inside = np.flatnonzero((ball < 0) & (cosines >= np.cos(half - _SLACK)))
            if len(inside) > 1 and i in inside:
                own, centre = inside, mean
                radius = float(np.arccos(np.clip(cosines[inside].min(), -1, 1))) + _SLACK / 10
        ball[own] = len(radii)
        centres.append(centre)
        radii.append(radius)
    return ball, np.array(centres).reshape(-1, x.shape[1]), np.array(radii)


def _balls(classes: DataFrame, forest: Forest, angle: float) -> DataFrame:
    """``rep, vector, copies`` -> the same rows with ``ball, centre, radius, members``, gathered within leaves of tree 0.

    A leaf with more than ``GROUP_ROWS`` rows is dealt out further by a hash, so no group grows with the table.
    """

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = as_matrix(batch.column("vector"))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            rows, leaves = forest.route(x, 0)
            out = np.empty(len(x), np.int64)
            out[rows] = leaves
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "leaf"])

    routed = stored(classes.mapInArrow(leaf, "rep bigint, vector array<float>, copies bigint, leaf bigint"))
    parts = routed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).alias("parts"))
    dealt = routed.join(F.broadcast(parts), "leaf")  # one row per leaf of one tree of the forest
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).drop("parts")

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rep", kind="stable").reset_index(drop=True)
        x = np.stack(group["vector"].to_numpy()).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        ball, centres, radii = gather_balls(x, angle / 2)
        first = group["rep"].to_numpy()[np.unique(ball, return_index=True)[1]]
        group["ball"], group["radius"] = first[ball], radii[ball]
        group["centre"] = list(centres[ball].astype(np.float32))
        return group[["rep", "vector", "copies", "ball", "centre", "radius"]]

    kinds = "rep bigint, vector array<float>, copies bigint, ball bigint, centre array<float>, radius double"
    return stored(dealt.groupBy("leaf", "part").applyInPandas(gather, kinds))


def _split(x: np.ndarray, ids: np.ndarray, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """Leaves of a group: split at medians, with spill, down to ``LEAF_ROWS``."""
    if len(ids) <= LEAF_ROWS:
        yield ids
        return
    p = x[ids] @ rng.standard_normal(x.shape[1])
    cut, margin = np.median(p), SPILL * p.std()
    left, right = ids[p < cut + margin], ids[p >= cut - margin]
    if max(len(left), len(right)) == len(ids):
        # Equal projections: no direction parts these rows, so they are dealt into overlapping blocks.
        blocks = np.array_split(ids, -(-len(ids) // (LEAF_ROWS // 2)))
        for i, a in enumerate(blocks):
            for b in blocks[i + 1 :] or [a[:0]]:
                yield np.concatenate([a, b])
        return
    yield from _split(x, left, rng)
    yield from _split(x, right, rng)


def _near_balls(balls: DataFrame, forest: Forest, angle: float) -> DataFrame:
    """``ball, centre, radius`` -> ``u, v, whole``: pairs that may hold links, ``whole`` where all members are linked."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = as_matrix(batch.column("centre"))
            for tree in range(forest.trees):
                rows, leaves = forest.route(x, tree, SPILL)
                some = batch.take(pa.array(rows))
                cells = pa.array(leaves * forest.trees + tree)
                yield pa.RecordBatch.from_arrays([cells, *some.columns], ["cell", *batch.schema.names])

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(group["centre"].to_numpy()).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        ball, radius = group["ball"].to_numpy(), group["radius"].to_numpy()
        found = []
        for own in _split(x, np.argsort(ball, kind="stable"), np.random.default_rng((SEED, *key))):
            part = np.arccos(np.clip(x[own] @ x[own].T, -1, 1))
            reach = radius[own][:, None] + radius[own][None, :]
            a, b = np.nonzero(np.triu(part <= angle + reach + _SLACK, 1))
            whole = part[a, b] + reach[a, b] <= angle - _SLACK
            a, b = ball[own[a]], ball[own[b]]
            found.append(pd.DataFrame({"u": np.minimum(a, b), "v": np.maximum(a, b), "whole": whole}))
        return pd.concat(found, ignore_index=True).drop_duplicates()

    cells = balls.select("ball", "centre", "radius").mapInArrow(
        route, "cell bigint, ball bigint, centre array<float>, radius double"
    )
    pairs = cells.groupBy("cell").applyInPandas(compare, "u bigint, v bigint, whole boolean")
    return pairs.where("u <> v").groupBy("u", "v").agg(F.max("whole").alias("whole"))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, trees: int = TREES, seed: int = SEED) -> DataFrame:
    """``vec_id, embedding`` -> ``vec_id, n_links, component_id, kept``."""
    bounded_batches(vectors.sparkSession)
    angle = float(np.arccos(cosine))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<float>").alias("vector"))
    sizes = rows.where(usable("vector")).groupBy(F.size("vector").alias("d")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    if top is None:
        return _result(rows.withColumn("n_links", F.lit(0).cast("bigint")).withColumn("component_id", F.col("vec_id")))
    taken = usable("vector") & (F.size("vector") == top["d"]) & F.col("vec_id").isNotNull()
    classes = rows.where(taken).groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = stored(classes.select("rep", "vector", "copies"))
    total = classes.count()
    sample = drawn_vectors(classes, "rep", "vector", total)
    sample = sample / np.linalg.norm(sample, axis=1, keepdims=True) if len(sample) else np.zeros((0, top["d"]))
    forest = fit_forest(sample, trees, max(0, int(np.ceil(np.log2(max(1, total / LEAF_ROWS))))), seed)

    members = _balls(classes, forest, angle)
    balls = stored(
        members.groupBy("ball").agg(
            F.first("centre").alias("centre"), F.first("radius").alias("radius"), F.sum("copies").alias("size")
        )
    )
    pairs = stored(_near_balls(balls, forest, angle))
    sure = pairs.where("whole").select("u", "v")
    both = sure.unionByName(sure.select(F.col("v").alias("u"), F.col("u").alias("v")))
    others = both.join(balls.select(F.col("ball").alias("v"), "size"), "v").groupBy(F.col("u").alias("ball")).agg(F.sum("size").alias("linked"))

    dot = F.aggregate(
        F.zip_with("a_vector", "b_vector", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x
    )
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    side = members.select("ball", "rep", "copies", "vector", norm.alias("norm"))
    a = side.select(*[F.col(c).alias(f"a_{c}") for c in side.columns])
    b = side.select(*[F.col(c).alias(f"b_{c}") for c in side.columns])
    open_pairs = pairs.where("not whole").join(a, F.col("u") == F.col("a_ball")).join(b, F.col("v") == F.col("b_ball"))
    exact = stored(
        open_pairs.where(dot / (F.col("a_norm") * F.col("b_norm")) >= cosine).select(
            "u", "v", "a_rep", "a_copies", "b_rep", "b_copies"
        )
    )
    one = exact.select(F.col("a_rep").alias("rep"), F.col("b_copies").alias("n"))
    two = exact.select(F.col("b_rep").alias("rep"), F.col("a_copies").alias("n"))
    single = one.unionByName(two).groupBy("rep").agg(F.sum("n").alias("single"))

    linked = components(sure.unionByName(exact.select("u", "v")))
    of_class = (
        members.select("rep", "ball")
        .join(balls.select("ball", "size"), "ball")
        .join(others, "ball", "left")
        .join(linked.withColumnRenamed("node", "ball"), "ball", "left")
        .join(single, "rep", "left")
    )
    zero = F.lit(0).cast("bigint")
    counts = stored(
        of_class.select(
            "rep",
            (F.col("size") - 1 + F.coalesce("linked", zero) + F.coalesce("single", zero)).alias("n_links"),
            F.coalesce("component", "ball").alias("component_id"),
        ).join(classes.select("rep", "vector"), "rep")
    )
    marked = rows.where(taken).join(counts, "vector").select("vec_id", "n_links", "component_id")
    rest = rows.where(~taken).select("vec_id", zero.alias("n_links"), F.col("vec_id").alias("component_id"))
    return _result(marked.unionByName(rest))


def _result(rows: DataFrame) -> DataFrame:
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return rows.select("vec_id", "n_links", "component_id", kept)
