"""Forests of random-projection trees. Trees are fitted to a bounded sample; every row is routed through them in Spark.

A node splits at the median of the sample's projections on a random direction. A forest of ``trees`` full trees of
``depth`` levels has a size that these parameters fix, whatever the table's; it goes to the tasks with their code.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 16_384
#: Rows of the sample that a leaf has at least, so that medians mean something.
LEAST_SAMPLE = 8


@dataclass
class Forest:
    directions: np.ndarray  # trees, nodes, dimensions
    thresholds: np.ndarray  # trees, nodes
    spreads: np.ndarray  # standard deviation of the sample's projections at the node
    depth: int

    @property
    def trees(self) -> int:
        return len(self.directions)

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def project(self, x: np.ndarray, tree: int, rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Signed distance of rows from the thresholds of nodes; at or above zero goes right."""
        return np.einsum("ij,ij->i", x[rows], self.directions[tree, nodes]) - self.thresholds[tree, nodes]

    def route(self, x: np.ndarray, tree: int, spill: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the leaves they fall into. Within ``spill`` spreads of a threshold a row goes both ways."""
        rows, nodes = np.arange(len(x)), np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            away = self.project(x, tree, rows, nodes)
            margin = spill * self.spreads[tree, nodes]
            left, right = away < margin, away >= -margin
            if spill == 0:
                left = ~right
            nodes = np.concatenate([2 * nodes[left] + 1, 2 * nodes[right] + 2])
            rows = np.concatenate([rows[left], rows[right]])
        return rows, nodes - (self.leaves - 1)


def fit_forest(sample: np.ndarray, trees: int, depth: int, seed: int) -> Forest:
    """Full trees over the sample (rows, dimensions); no deeper than the sample can fill."""
    depth = max(0, min(depth, int(np.log2(max(1, len(sample) // LEAST_SAMPLE)))))
    rng = np.random.default_rng(seed)
    nodes, d = max(1, (1 << depth) - 1), sample.shape[1]
    directions = rng.standard_normal((trees, nodes, d))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    thresholds, spreads = np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for t in range(trees):
        at = np.zeros(len(sample), np.int64)
        for level in range(depth):
            for node in range((1 << level) - 1, (2 << level) - 1):
                own = np.flatnonzero(at == node)
                if not len(own):
                    continue
                p = sample[own] @ directions[t, node]
                thresholds[t, node], spreads[t, node] = np.median(p), p.std()
                at[own] = 2 * node + 1 + (p >= thresholds[t, node])
    return Forest(directions.astype(np.float32), thresholds, spreads, depth)


def usable(vector: str) -> Column:
    """Whether a vector has only finite components and is not zero."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(x.isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def drawn_vectors(rows: DataFrame, key: str, vector: str, total: int, most: int = SAMPLE_ROWS, seed: str = "rp") -> np.ndarray:
    """About ``most`` vectors of ``rows``, drawn by a hash of their key, on the driver: a bound that does not grow."""
    share = min(1.0, most / max(1, total))
    drawn = rows.where(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = drawn.select(vector).toArrow().column(0).combine_chunks()
    width = len(found[0]) if len(found) else 1
    return found.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def as_matrix(column, kind=np.float64) -> np.ndarray:
    """Rows of an Arrow list column whose lists all have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1), kind)
