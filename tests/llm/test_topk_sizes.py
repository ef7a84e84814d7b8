"""Exact scores of large components, and ids that repeat."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.errors import PySparkException

from dockside.llm import topk


def plain(rows, k):
    """(query id, rank, vec_id, score) of ids divisible by 100, with Python's integers."""
    vectors = [(i, [int(np.floor(1024 * c)) for c in v]) for i, v in rows]
    out = []
    for q, x in vectors:
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in vectors if i != q)
            out += [(q, n + 1, i, -score) for n, (score, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("size", [1.0, 2.0**20, 2.0**21 - 1])
def test_scores_are_exact(spark, size):
    draw = np.random.default_rng(11)
    rows = [(i, [float(c) for c in draw.uniform(-size, size, 2)]) for i in range(700)]
    rows += [(800, [size, 1.0]), (801, [size, 1.0 + 1 / 1024]), (802, [size, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = topk.exact_top_k(frame, frame.where("vec_id % 100 = 0"), k=7).collect()
    assert sorted(tuple(r) for r in found) == plain(rows, 7)


def test_too_large_is_an_error(spark):
    for value in (2.0**40, 1e30):
        frame = spark.createDataFrame([(0, [value, value]), (1, [value, value])], "vec_id long, embedding array<double>")
        with pytest.raises(PySparkException, match="too large"):
            topk.exact_top_k(frame, frame.where("vec_id = 0")).collect()


def test_rows_of_one_id_are_spread(spark):
    """A third of the rows under one id: every group of the search gets its share of them."""
    rows = spark.range(30_000).selectExpr("IF(id % 3 = 0, 5, id) AS vec_id", "array(CAST(id % 7 AS DOUBLE), 1D) AS embedding")
    found = topk.exact_top_k(rows, rows.where("vec_id = 100"), k=3).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(found, key=lambda r: r["rank"])] == [(1, 5), (2, 5), (3, 5)]
