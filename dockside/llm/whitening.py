"""Whitening of embeddings; components by contour integration (FEAST).

Spark sums the integer vectors and, centred at their rounded mean, their products;
both sums are exact for usual magnitudes.  The covariance that results has the
size of a vector squared, whatever the number of vectors, and is diagonalised on
the driver:

* inertia counts of the shifted covariance bracket the wanted eigenvalues and
  give intervals whose ends lie in gaps between them;
* for each interval, quadrature over a circle of complex shifted solves projects
  random vectors onto its eigenvectors, and Rayleigh-Ritz extracts them; both
  are repeated until the residuals vanish;
* the number found in an interval must be the number its inertia counts tell.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockside.llm.common import settled

FACTOR, SHIFT = 1024, 100_000

#: Integers from here on are refused: their sums would not be exact.
LARGEST = 1 << 40

NODES = 8
ROUNDS = 60
#: Residual, relative to the largest eigenvalue, at which a component counts as found.
RESIDUAL = 4e-15
#: Residual that must be reached at least; rounding may not allow for less.
ROUNDING = 1e-12
#: Brackets of eigenvalues are halved down to this width, relative to the largest one.
BRACKET = 1e-6
#: Eigenvalues up to this share of the largest one are rounding: their directions hold no spread.
NOTHING = 1e-13

SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def integers(vector: str) -> Column:
    """floor(1024 * c) + 100000 of each entry, in double precision."""
    large = F.raise_error(F.concat(F.lit("an entry of "), F.lit(vector), F.lit(" is too large for exact sums"))).cast("bigint")
    scaled = lambda x: F.floor(x.cast("double") * FACTOR)
    return F.transform(
        F.col(vector), lambda x: F.when(F.abs(x.cast("double")) * FACTOR < LARGEST, scaled(x).cast("bigint") + SHIFT).otherwise(large)
    )


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is given, not empty, and of finite entries only."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)


@dataclass(frozen=True)
class Spread:
    """Number of vectors, their exact sums per dimension, and their covariance."""

    n: int
    sums: list[int]
    covariance: np.ndarray

    @property
    def middle(self) -> np.ndarray:
        """The mean, rounded to integers."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> list[int]:
        """The sums that are left when the rounded mean is taken off every vector."""
        return [s - self.n * int(m) for s, m in zip(self.sums, self.middle, strict=True)]


def exact_sums(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total = np.stack(batch["x"].to_list()).sum(axis=0)
            yield pd.DataFrame({"at": np.arange(-1, width), "part": np.concatenate([[len(batch)], total])})

    parts = vectors.select("x").mapInPandas(add, "at int, part bigint")
    found = parts.groupBy("at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    totals = {r["at"]: int(r["total"]) for r in found}
    return totals[-1], [totals[i] for i in range(width)]


def spread_of(vectors: DataFrame, width: int) -> Spread:
    """Of the integer vectors ``x``, all of one width; two passes, a matrix per task comes back."""
    n, sums = exact_sums(vectors, width)
    flat = Spread(n, sums, np.zeros((width, width)))
    middle = flat.middle

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for batch in batches:
            centred = (np.stack(batch["x"].to_list()) - middle).astype(float)
            total += centred.T @ centred
        yield pd.DataFrame({"at": np.arange(width), "part": list(total)})

    parts = vectors.select("x").mapInPandas(multiply, "at int, part array<double>")
    cells = parts.select("at", F.posexplode("part").alias("to", "part")).groupBy("at", "to").agg(F.sum("part").alias("total"))
    products = np.zeros((width, width))
    for row in cells.collect():  # width x width cells
        products[row["at"], row["to"]] = row["total"]
    off = np.array(flat.rest, dtype=float) / n
    covariance = products / n - np.outer(off, off)
    return Spread(n, sums, (covariance + covariance.T) / 2)


# --- components of a symmetric matrix ------------------------------------------


def positives(matrix: np.ndarray) -> int:
    """How many eigenvalues are above zero, by the inertia of its LDL' factors with complete pivoting."""
    a = matrix.copy()
    alpha = (1 + np.sqrt(17)) / 8
    count = 0
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        i = int(diagonal.argmax())
        off = np.abs(a)
        np.fill_diagonal(off, 0)
        r, s = np.unravel_index(off.argmax(), off.shape)
        if diagonal[i] == 0 and off[r, s] == 0:
            break
        pivot = [i] if diagonal[i] >= alpha * off[r, s] else [int(r), int(s)]
        count += int(a[i, i] > 0) if len(pivot) == 1 else 1  # a pivot of two is indefinite
        left = np.delete(np.arange(len(a)), pivot)
        columns = a[np.ix_(left, pivot)]
        a = a[np.ix_(left, left)] - columns @ np.linalg.solve(a[np.ix_(pivot, pivot)], columns.T)
    return count


def above(matrix: np.ndarray, at: float) -> int:
    return positives(matrix - at * np.eye(len(matrix)))


def brackets(matrix: np.ndarray, wanted: int) -> list[tuple[float, float]]:
    """(low, high) around the largest eigenvalues, from the largest on; low and high are narrow."""
    top = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-12)
    known = {-top: len(matrix), top: 0}

    def count(at: float) -> int:
        if at not in known:
            known[at] = above(matrix, at)
        return known[at]

    found = []
    for i in range(1, wanted + 1):
        # Eigenvalue i: at least i of them are above low, fewer above high.
        low = max(x for x, c in known.items() if c >= i)
        high = min(x for x, c in known.items() if c < i)
        while high - low > BRACKET * top:
            middle = (low + high) / 2
            low, high = (middle, high) if count(middle) >= i else (low, middle)
        found.append((low, high))
    return found


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, number of eigenvalues), from the top; each is centred on brackets that touch, half a gap wide around.

    Equal eigenvalues are taken whole.  Inertia counts give the numbers, and make
    sure that none lie between the intervals.
    """
    n, top = len(matrix), float(np.abs(matrix).sum(axis=1).max())
    asked = min(n, wanted + 1)
    known = brackets(matrix, asked)
    while wanted < asked < n and known[-1][1] >= known[wanted - 1][0]:
        asked = min(n, 2 * asked)
        known = brackets(matrix, asked)
    runs = [list(known[0])]
    for low, high in known[1:]:
        if high >= runs[-1][0]:
            runs[-1][0] = min(low, runs[-1][0])
        else:
            runs.append([low, high])
    if asked < n:  # the last run may go on below
        ends, runs = runs[-1][1], runs[:-1]
    else:
        ends = -2 * top
    out = []
    for at, (low, high) in enumerate(runs):
        below = runs[at + 1][1] if at + 1 < len(runs) else ends
        gap = min(low - below, runs[at - 1][0] - high if at else top) / 2
        out.append((low - gap, high + gap, above(matrix, low - gap) - above(matrix, high + gap)))
        if sum(number for _, _, number in out) >= wanted:
            break
    if above(matrix, out[-1][0]) != sum(number for _, _, number in out):
        raise ArithmeticError("an eigenvalue lies between the intervals")
    return out


def contour(matrix: np.ndarray, low: float, high: float, vectors: np.ndarray) -> np.ndarray:
    """The vectors' share in the eigenvectors of [low, high], by quadrature over a half circle."""
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    out = np.zeros_like(vectors)
    for node, weight in zip(nodes, weights, strict=True):
        turn = np.exp(1j * np.pi / 2 * (1 - node))
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(matrix)) - matrix, vectors.astype(complex))
        out += weight / 2 * (radius * turn * solved).real
    return out


def of_interval(matrix: np.ndarray, low: float, high: float, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) in [low, high], falling; ``number`` of them."""
    size = min(len(matrix), 2 * number + 2)
    vectors = np.random.default_rng(0).standard_normal((len(matrix), size))
    scale = np.abs(matrix).sum(axis=1).max()
    best = (np.inf, np.zeros(0), vectors)
    for _ in range(ROUNDS):
        basis, _ = np.linalg.qr(contour(matrix, low, high, vectors))
        values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
        vectors = basis @ turned
        inside = np.flatnonzero((values > low) & (values < high))
        residual = np.linalg.norm(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside], axis=0) / scale
        # Mixtures from both sides may lie inside by chance; their residuals do not vanish.
        inside = np.sort(inside[np.argsort(residual)[:number]])[::-1]
        worst = float(np.sort(residual)[:number].max()) if len(inside) == number else np.inf
        if worst < best[0]:
            best = (worst, values[inside], vectors[:, inside])
        elif best[0] < ROUNDING:  # no better than rounding allows
            break
        if worst <= RESIDUAL:
            break
    if best[0] >= ROUNDING:
        raise ArithmeticError(f"the contour around [{low}, {high}] did not find its {number} components")
    return best[1], best[2]


def leading_components(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns), falling; up to ``wanted`` of those above rounding."""
    if not len(matrix) or not np.abs(matrix).max():
        return np.zeros(0), np.zeros((len(matrix), 0))
    parts = [of_interval(matrix, low, high, number) for low, high, number in intervals(matrix, min(wanted, len(matrix))) if number]
    values, vectors = np.concatenate([v for v, _ in parts]), np.concatenate([w for _, w in parts], axis=1)
    values, vectors = values[:wanted], vectors[:, :wanted]
    real = values > NOTHING * values[0]
    values, vectors = values[real], vectors[:, real]
    # Either sign will do: the entry of the largest size is positive.
    return values, vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])


# --- whitening -----------------------------------------------------------------


def long_or_none(value: int) -> int | None:
    return value if value < 1 << 63 else None


def projected(vectors: DataFrame, spread: Spread, values: np.ndarray, components: np.ndarray) -> DataFrame:
    """(vec_id, deviation, w): the exact deviation and the whitened coordinates of each vector."""
    n, middle, rest = spread.n, spread.middle, spread.rest
    off = np.array([r / n for r in rest])
    onto = components / np.sqrt(values)
    squares = sum(r * r for r in rest)
    kind = np.int64 if n < 1 << 20 else object  # products of the rest stay exact

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            centred = np.stack(batch["x"].to_list()) - middle
            exact = centred if np.abs(centred).max() < 1 << 20 else centred.astype(object)
            own = (exact * exact).sum(axis=1)
            # (n x - S)^2 = n^2 y^2 - 2 n y r + r^2 with y = x - middle and r = S - n middle.
            crossed = (exact.astype(kind) * np.array(rest, dtype=kind)).sum(axis=1)
            deviation = [n * n * int(a) - 2 * n * int(b) + squares for a, b in zip(own, crossed, strict=True)]
            yield pd.DataFrame(
                {
                    "vec_id": batch["vec_id"].astype("Int64"),
                    "deviation": pd.array([long_or_none(d) for d in deviation], dtype="Int64"),
                    "w": list((centred.astype(float) - off) @ onto),
                }
            )

    return vectors.select("vec_id", "x").mapInPandas(project, "vec_id bigint, deviation bigint, w array<double>")


def identity_error(white: DataFrame, width: int) -> float:
    """Largest entry of the covariance of ``w`` minus the identity, in size."""
    means = white.agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in range(width)]).first()
    pairs = [(i, j) for i in range(width) for j in range(i + 1)]
    centred = [F.col("w")[i] - F.lit(means[i]) for i in range(width)]
    cells = white.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(cell - (i == j)) for cell, (i, j) in zip(cells, pairs, strict=True))


def whitened(rows: DataFrame, vector: str = "embedding", components: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error per usable vector and component.

    Vectors that are missing, empty, or hold missing or non-finite entries take no
    part; nor do those of another length than most have (of equally frequent
    lengths the greater counts).  Rows that repeat count each time, a missing
    vec_id stays missing, other columns are not looked at.  Directions without
    spread are no components: there are fewer than asked for where vectors are
    narrow, few or alike, and no rows for an empty table.  Equal eigenvalues have
    orthogonal components in no particular turn.  A deviation beyond a long is
    null; an entry of 2^30 or more is refused with an error.
    """
    spark = rows.sparkSession
    vectors = usable(rows, vector).select(F.col("vec_id").cast("bigint").alias("vec_id"), integers(vector).alias("x"))
    vectors = settled(vectors, "vectors")
    widths = vectors.groupBy(F.size("x").alias("width")).count()
    common = widths.orderBy(F.desc("count"), F.desc("width")).first()
    if common is None:
        return spark.createDataFrame([], SCHEMA)
    width = common["width"]
    vectors = vectors.where(F.size("x") == width)
    spread = spread_of(vectors, width)
    values, onto = leading_components(spread.covariance, components)
    if not len(values):
        return spark.createDataFrame([], SCHEMA)
    white = settled(projected(vectors, spread, values, onto), "whitened")
    error = identity_error(white, len(values))
    explained = F.array(*[F.lit(float(e)) for e in values / np.trace(spread.covariance)])
    long = white.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return long.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(spread.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
