"""Recall of the nearest-vector search on vectors of any lengths, with production parameters, against an exact scan."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roamdex.llm import ann

ROWS, WIDTH = 6_000, 64


def drawn(kind):
    rng = np.random.default_rng(len(kind))
    x = rng.standard_normal((ROWS, WIDTH))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "unit":
        return unit
    if kind == "normal":
        return x
    if kind == "lengths":
        return unit * rng.lognormal(0, 0.5, (ROWS, 1))
    if kind == "factors":
        return unit * rng.uniform(0.5, 2, (ROWS, 1))
    centres = rng.standard_normal((60, WIDTH))
    return centres[rng.integers(0, 60, ROWS)] + 0.3 * x


@pytest.mark.parametrize("kind", ["unit", "normal", "lengths", "factors", "clusters"])
def test_recall(spark, kind):
    x = drawn(kind).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    got = ann.nearest(table, F.col("vec_id") % 60 == 0).toPandas()
    scores = x[::60].astype(float) @ x.astype(float).T
    hits = []
    for k, own in enumerate(range(0, ROWS, 60)):
        scores[k, own] = -np.inf
        best = set(np.argsort(-scores[k], kind="stable")[: ann.NEAREST].tolist())
        found = got[got["query_id"] == own]
        assert len(found) == ann.NEAREST
        hits.append(len(best & set(found["vec_id"])) / ann.NEAREST)
    assert np.mean(hits) >= 0.9, np.mean(hits)
