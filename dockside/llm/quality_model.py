"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

A document is described by a few statistics.  Random Fourier features of the
standardised statistics approximate a Gaussian kernel; ridge regression on them
needs only the normal equations, which partitions sum up.  The raw scores are
made probabilities by isotonic regression on labelled rows that the regression
has not seen.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockside.llm.common import fold, settled, whole_text

WORD = re.compile(r"[^\W\d_]+")
MARKS = "#*$%&|<>"


@dataclass(frozen=True)
class Kernel:
    features: int = 256
    #: Width of the Gaussian kernel, in standard deviations of the statistics.
    width: float = 3.0
    ridge: float = 1e-3
    seed: int = 7
    #: At most about so many labelled rows are fitted; a row is chosen by hash.
    most_rows: int = 200_000
    #: Their partial sums come from so many partitions.
    partitions: int = 16
    #: Steps of the calibration.
    steps: int = 1000


NAMES = (
    "log_words", "log_lines", "mean_word", "upper", "digits", "marks", "punctuation", "exclaims", "blanks",
    "distinct_words", "distinct_lines", "word_lines", "single_letters", "letters", "longest_word", "mean_line",
)


def statistics(text: str) -> list[float]:
    """Numbers that describe a text, none of them missing."""
    n = max(1, len(text))
    words = text.split()
    n_words = max(1, len(words))
    lines = [line for line in text.split("\n") if line.strip()]
    n_lines = max(1, len(lines))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÊÇÑÍÓ"))
    digits = sum(map(text.count, "0123456789"))
    marks = sum(map(text.count, MARKS))
    stops = sum(map(text.count, ".,;:?"))
    loud = text.count("!")
    blanks = text.count(" ") + text.count("\n") + text.count("\t")
    return [
        np.log1p(len(words)), np.log1p(len(lines)), float(lengths.mean()), upper / n, digits / n, marks / n_words,
        stops / n_words, loud / n_words, blanks / n, len(set(words)) / n_words, len(set(lines)) / n_lines,
        np.log1p(n_words / n_lines), float((lengths == 1).sum()) / n_words,
        (n - digits - marks - stops - loud - blanks) / n, np.log1p(float(lengths.max())), np.log1p(len(text) / n_lines),
    ]


def described(documents: DataFrame) -> DataFrame:
    """(doc_id, stats) of every row."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            stats = [statistics(text) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "stats": stats})

    given = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return given.mapInPandas(describe, "doc_id bigint, stats array<double>")


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    #: Isotonic steps: raw scores and the share of label 1 there.
    at: np.ndarray
    share: np.ndarray

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        return fourier(np.clip((stats - self.mean) / self.spread, -8, 8), self.directions, self.phases)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.fourier(stats) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.at, self.share)


def fourier(x: np.ndarray, directions: np.ndarray, phases: np.ndarray) -> np.ndarray:
    waves = np.sqrt(2 / len(phases)) * np.cos(x @ directions + phases)
    return np.c_[waves, np.ones(len(x))]


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The closest non-decreasing values, by pooling neighbours that are out of order."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights, strict=True):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, n = blocks.pop()
            u = blocks[-1]
            u[0] = (u[0] * u[1] + v * w) / (u[1] + w)
            u[1] += w
            u[2] += n
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks])


def normal_equations(rows: DataFrame, model: QualityModel, partitions: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all rows (stats, label): features times features, features times label."""

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = len(model.phases) + 1
        gram, target = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.iloc[at : at + 4096]
                z = model.fourier(np.stack(part["stats"].to_list()))
                gram += z.T @ z
                target += z.T @ part["label"].to_numpy(float)
        yield pd.DataFrame({"sums": [np.concatenate([gram.ravel(), target])]})

    # At most ``partitions`` matrices of a fixed size reach the driver.
    parts = rows.select("stats", "label").repartition(partitions).mapInPandas(add_up, "sums array<double>").toLocalIterator()
    total = sum(np.array(r["sums"]) for r in parts)
    size = len(model.phases) + 1
    return total[: size * size].reshape(size, size), total[size * size :]


def fitted(rows: DataFrame, how: Kernel = Kernel()) -> QualityModel:
    """The model of ``rows`` (key, stats, label), a quarter of them for calibration.

    Without rows of both labels every score is 0.5.
    """
    width = len(NAMES)
    random = np.random.default_rng(how.seed)
    directions = random.normal(size=(width, how.features)) / how.width
    phases = random.uniform(0, 2 * np.pi, how.features)
    flat = QualityModel(
        np.zeros(width), np.ones(width), directions, phases, np.zeros(how.features + 1), np.array([0.0]), np.array([0.5])
    )
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return flat
    bound = min(1_000_000, int(1_000_000 * how.most_rows / sum(sizes.values())))
    rows = settled(rows.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < bound), "chosen")
    each = [F.col("stats")[k] for k in range(width)]
    found = rows.agg(*[F.avg(c).alias(f"m{k}") for k, c in enumerate(each)], *[F.stddev_pop(c).alias(f"s{k}") for k, c in enumerate(each)]).first()
    mean = np.array([found[f"m{k}"] for k in range(width)])
    spread = np.maximum(np.array([found[f"s{k}"] for k in range(width)]), 1e-6)
    model = QualityModel(mean, spread, directions, phases, flat.weights, flat.at, flat.share)
    held = F.pmod(F.hash("key"), F.lit(4)) == 0
    gram, target = normal_equations(rows.where(~held), model, how.partitions)
    weights = np.linalg.solve(gram + how.ridge * max(1.0, gram[-1, -1]) * np.eye(len(target)), target)
    model = QualityModel(mean, spread, directions, phases, weights, flat.at, flat.share)

    def step_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                raw = np.clip(model.raw(np.stack(batch["stats"].to_list())), -1, 2)
                yield pd.DataFrame({"step": np.floor(raw * how.steps).astype(np.int64), "label": batch["label"]})

    steps = (
        rows.where(held).select("stats", "label").mapInPandas(step_of, "step bigint, label int")
        .groupBy("step").agg(F.avg("label").alias("share"), F.count("*").alias("n")).orderBy("step").collect()
    )
    if not steps:
        return flat
    # One pseudo row of either label keeps the ends inside 0 and 1.
    n = np.array([r["n"] for r in steps], dtype=float)
    ones = np.array([r["share"] * r["n"] for r in steps])
    share = isotonic((ones + 0.01) / (n + 0.02), n)
    at = (np.array([r["step"] for r in steps]) + 0.5) / how.steps
    return QualityModel(mean, spread, directions, phases, weights, at, share)


def quality_scores(documents: DataFrame, labels: DataFrame, how: Kernel = Kernel()) -> DataFrame:
    """doc_id, held_out, score of every row of ``documents``.

    Labels are learnt from rows whose crc32(doc_id) mod 5 is not 0.  A missing
    text counts as empty; a missing or other label is not learnt from; rows that
    repeat score alike; an empty table gives no rows.
    """
    stats = settled(described(documents), "stats")
    usable = labels.where(F.col("quality").isin(0, 1) & (fold(5) != 0)).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").cast("int").alias("label"))
    model = fitted(stats.join(usable, "doc_id").withColumn("key", F.struct("doc_id", "stats")), how)
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)  # of a fixed size

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(shared.value.scores(np.stack(batch.to_list())) if len(batch) else [], dtype=float)

    return stats.select("doc_id", (fold(5) == 0).alias("held_out"), F.pandas_udf(score, "double")("stats").alias("score"))
