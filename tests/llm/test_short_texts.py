"""Packing by exact lengths."""

from __future__ import annotations

import numpy as np
import pytest

from dockside.llm import packing


@pytest.mark.parametrize("low, high", [(1, 2), (2, 21), (10, 61), (50, 151), (1, 2049)])
def test_short_pieces_fill_their_sequences(spark, low, high):
    lengths = np.random.default_rng(2).integers(low, high, 5000)
    rows = [(i, 0, 0, int(n)) for i, n in enumerate(lengths)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long")
    places: dict = {}
    for r in packing.packed(pieces).collect():
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(n for parts in places.values() for _, n in parts) == sorted(lengths.tolist())
    for parts in places.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [at for at, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(places) <= 1.01 * lengths.sum() / 2048 + 1


def test_most_sequences_come_from_fitted_patterns():
    """On mixed lengths patterns make up most of the plan, close to the least possible number."""
    draw = np.random.default_rng(1)
    for lengths in (np.exp(draw.normal(6, 1, 20_000)), draw.integers(1, 2049, 20_000)):
        histogram = np.bincount(np.clip(lengths.astype(int), 1, 2048), minlength=2049)
        begun = packing.patterned(histogram.astype(np.int64).copy(), packing.UNITS)
        plan = packing.plan_of(histogram)
        sequences = sum(times for _, times in plan)
        assert sum(times for _, times in begun) >= sequences / 2
        assert sequences <= 1.01 * (histogram @ np.arange(2049)) / 2048


def test_rows_without_an_id_are_spread(spark):
    """A thousand equal pieces are numbered in many shards, and each gets a place of its own."""
    pieces = spark.range(1000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "0 AS piece", "0L AS start", "100L AS length").repartition(4)
    found = packing.packed(pieces).collect()
    places = {(r["sequence_id"], r["offset"]) for r in found}
    assert len(found) == len(places) == 1000 and len({s for s, _ in places}) == 50
