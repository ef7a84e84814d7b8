"""Whitening against numpy's eigenvectors and exact integers."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest
from pyspark.errors import PySparkException

from dockside.llm import whitening
from dockside.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(vectors: list[list[float]], components: int = 8):
    """x, n, deviations, eigenvalues (falling) and eigenvectors; covariance from exact fractions."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors]
    n, width = len(x), len(x[0])
    sums = [sum(v[d] for v in x) for d in range(width)]
    scaled = np.array([[n * v[d] - sums[d] for d in range(width)] for v in x], dtype=object)
    products = scaled.T @ scaled
    covariance = np.array([[float(Fraction(int(c), n**3)) for c in row] for row in products])
    values, turned = np.linalg.eigh(covariance)
    deviation = [int(d) for d in (scaled * scaled).sum(axis=1)]
    centred = np.array([[float(Fraction(int(c), n)) for c in row] for row in scaled])
    return deviation, centred, values[::-1][:components], turned[:, ::-1][:, :components], covariance.trace()


def check(found, ids, vectors):
    deviation, centred, values, turned, trace = plain(vectors)
    wanted = centred @ turned / np.sqrt(values)
    rows = {(r["vec_id"], r["component"]): r for r in found}
    assert len(found) == len(rows) == len(ids) * len(values)
    for k in range(len(values)):
        got = np.array([rows[i, k + 1]["whitened"] for i in ids])
        sign = np.sign(got @ wanted[:, k])
        assert np.abs(got - sign * wanted[:, k]).max() < 1e-8
        assert abs(rows[ids[0], k + 1]["explained"] / (values[k] / trace) - 1) < 1e-9
    assert [rows[i, 1]["deviation"] for i in ids] == deviation
    assert {r["n"] for r in found} == {len(ids)} and max(r["identity_error"] for r in found) < 1e-9


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(QUERIES["op13_embedding_whitening"](spark, SF).collect(), [r["vec_id"] for r in table], [r["embedding"] for r in table])


def test_odd_vectors(spark):
    draw = np.random.default_rng(4)
    good = [(i, [float(np.float32(c)) for c in draw.normal(50 * (i % 2), [1, 1, 5, 0.2])]) for i in range(40)]
    bad = [(50, None), (51, [1.0, None, 1.0, 1.0]), (52, [float("nan")] * 4), (53, [float("inf"), 0.0, 0.0, 0.0]), (54, []), (55, [1.0])]
    rows = [(i, v, "x", 0.5) for i, v in [*good, *bad]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string, whitened double").repartition(3)
    check(whitening.whitened(frame).collect(), [i for i, _ in good], [v for _, v in good])
    assert whitening.whitened(frame.limit(0)).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whitened(same).count() == 0
    line = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 4.0])], "vec_id long, embedding array<double>")
    found = whitening.whitened(line).collect()
    assert sorted((str(r["vec_id"]), r["component"], round(r["explained"], 9)) for r in found) == [("1", 1, 1.0), ("1", 1, 1.0), ("None", 1, 1.0)]
    with pytest.raises(PySparkException, match="too large"):
        whitening.whitened(spark.createDataFrame([(1, [1e12])], "vec_id long, embedding array<double>")).count()


def test_large_deviations_are_exact_or_missing(spark):
    rows = [(i, [float(i % 3) * 2.0**k for k in range(0, 28, 4)]) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r["deviation"] for r in whitening.whitened(frame).collect()}
    deviation = plain([v for _, v in rows])[0]
    assert [found[i] for i, _ in rows] == [d if d < 1 << 63 else None for d in deviation]


def with_values(values, seed=0):
    turned, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (turned * values) @ turned.T


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 2, 30),
        np.r_[5.0, 5.0, 5.0, 1 + 1e-9, 1.0, np.zeros(20)],
        np.r_[1e6, 1e3, np.linspace(1, 1.001, 40)],
        np.ones(12),
        np.r_[3.0],
        np.r_[np.ones(9), 0.5, 0.25],
    ],
)
def test_components_of_known_matrices(values):
    values = np.sort(values)[::-1]
    matrix = with_values(values)
    matrix = (matrix + matrix.T) / 2
    found, turned = whitening.leading_components(matrix, 8)
    wanted = values[:8][values[:8] > whitening.NOTHING * values[0]]
    assert len(found) == len(wanted) and np.abs(found - wanted).max() <= 1e-12 * values[0]
    assert np.abs(turned.T @ turned - np.eye(len(found))).max() < 1e-9
    assert np.abs(matrix @ turned - turned * found).max() <= 1e-12 * values[0]


def test_inertia_counts():
    draw = np.random.default_rng(7)
    for _ in range(60):
        n = int(draw.integers(1, 12))
        values = draw.integers(-3, 4, n).astype(float)
        matrix = with_values(values, int(draw.integers(1000))) if (values != 0).all() else np.diag(values)
        assert whitening.positives(matrix) == (values > 0).sum()
    assert whitening.positives(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1
