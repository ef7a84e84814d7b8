"""The two trained models: held-out accuracy, and awkward rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockside.llm import quality_model, toxicity

SF = "/root/testdata/sf0.01"


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def held_out(scores, labels, name):
    rows = scores.where("held_out").join(labels, "doc_id").select("score", name).collect()
    return np.array([r["score"] for r in rows]), np.array([r[name] for r in rows])


def test_quality_scores_held_out_rows(spark):
    scores = quality_model.quality_scores(read(spark, "documents"), read(spark, "labels"))
    score, label = held_out(scores, read(spark, "labels"), "quality")
    assert ((score >= 0.3) == label).mean() > 0.9


def test_toxicity_separates_held_out_classes(spark):
    scores = toxicity.scored(read(spark, "documents"), read(spark, "labels"))
    score, label = held_out(scores, read(spark, "labels"), "toxic")
    assert score[label == 1].mean() > score[label == 0].mean()
    assert ((score >= 0.7) & (label == 0)).mean() < 0.02


@pytest.mark.parametrize("score", [toxicity.scored, quality_model.quality_scores])
def test_odd_rows(spark, score):
    rows = [(1, "word " * 30, "x"), (2, None, "x"), (3, "", "x"), (None, "text", "x"), (None, None, "x"), (1, "word " * 30, "x"), (4, "a" * 200_000, "x")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None, 1), (2, 1, None), (None, 1, 0), (3, 7, 7)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        found = score(documents, known).collect()
        assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in found)
        assert score(documents.limit(0), known).count() == 0


def test_isotonic_pools_neighbours():
    pooled = quality_model.isotonic(np.array([0.1, 0.5, 0.3, 0.9, 0.2]), np.ones(5))
    assert (np.diff(pooled) >= 0).all() and np.allclose(pooled, [0.1, 0.4, 0.4, 0.55, 0.55])


def test_not_toxic_keeps_columns(spark):
    documents = read(spark, "documents").withColumn("score", F.lit("own"))
    left = toxicity.not_toxic(documents, read(spark, "labels"))
    assert left.columns == documents.columns and left.count() > 0.85 * documents.count()


def spelled(kind, i):
    return kind + "".join("abcdefghij"[int(c)] for c in str(i))


def insulting(rare):
    """Documents and labels: each toxic document holds two of ``rare`` insults, all else is chance."""
    random = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(1600):
        toxic = int(random.random() < 0.12)
        words = [spelled("w", n) for n in random.zipf(1.3, 80) if n < 10**6]
        if toxic:
            words += [spelled("insult", n) for n in random.integers(0, rare, 4)]
        rows.append((i, " ".join(random.permutation(words))))
        labels.append((i, toxic))
    return rows, labels


def test_rare_insults_are_found_on_held_out_rows(spark):
    """Each insult is in about four counted documents, too few to stand out alone by six deviations."""
    rows, labels = insulting(80)
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    score, label = held_out(toxicity.scored(documents, known), known, "toxic")
    assert (score[label == 1] >= 0.7).mean() > 0.8
    assert (score[label == 0] >= 0.7).mean() < 0.02


def test_toxicity_recall_on_given_tables(spark):
    read_ = lambda name: spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet")
    score, label = held_out(toxicity.scored(read_("documents"), read_("labels")), read_("labels"), "toxic")
    assert (score[label == 1] >= 0.7).mean() > 0.75
    assert (score[label == 0] >= 0.7).mean() < 0.01


def test_joined_expressions_score_like_those_at_hand(spark):
    """No expression is left out where more are counted than fit the room for lookups."""
    rows, labels = insulting(80)
    rows += [(i + 10_000, rows[i][1]) for i in range(40)] + [(None, None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = []
    for at_hand in (0, 100, 1 << 22):
        scores = toxicity.scored(documents, known, toxicity.Smoothing(at_hand=at_hand)).collect()
        found.append(sorted((-1 if r["doc_id"] is None else r["doc_id"], r["score"]) for r in scores))
    assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)


def plain_expressions(text):
    words = toxicity.WORD.findall(text.lower())
    return words, list(zip(words, words[1:], strict=False))


def test_counts_ratios_and_sums_equal_plain_ones(spark):
    """200 documents: every expression counted, weighed and summed one by one."""
    from collections import Counter, defaultdict

    rows, labels = insulting(20)
    rows, toxic = rows[:200], dict(labels[:200])
    how = toxicity.Smoothing(at_hand=50)
    frame = spark.createDataFrame([(t, toxic[i]) for i, t in rows], "text string, toxic int").repartition(3)
    n = Counter(toxic.values())
    counts = defaultdict(lambda: [0, 0])
    for i, text in rows:
        words, pairs = plain_expressions(text)
        for e in {*words, *pairs}:
            counts[e][toxic[i]] += 1
    ends = Counter(e[1] for e in counts if isinstance(e, tuple))
    kinds = {kind: [c for e, c in counts.items() if isinstance(e, kind)] for kind in (str, tuple)}
    freed = {k: max(sum(1 if c[x] == 1 else 0.75 for c in cs if c[x]) / sum(c[x] for c in cs) for x in (0, 1)) for k, cs in kinds.items()}
    held = sum(map(sum, kinds[tuple]))

    def ratio(e):
        c0, c1 = counts[e] if e in counts else (0, 0)
        if max(c0, c1) < 2:
            return 0
        shared = ends[e[1]] * held / 200 / len(kinds[tuple]) if isinstance(e, tuple) else (c0 + c1) / 200
        of = toxicity.log_ratios(*(np.array([float(x)]) for x in (c0, c1, shared, freed[type(e)])), n[0], n[1], how)
        return int(of[0])

    weights = toxicity.weighed(toxicity.tallied(toxicity.counted(frame)), n[0], n[1], how, toxicity.JoinBudget())
    wanted = {e: ratio(e) for e, c in counts.items() if max(c) > 1}
    got = sorted(r["ratio"] for r in weights.collect())
    assert len(got) == len(wanted) and np.abs(np.array(got) - sorted(wanted.values())).max() <= 1
    model = toxicity.model_of(weights, how)
    assert 0 < len(model.keys) <= 50
    texts = spark.createDataFrame([*rows, (999, ""), (1000, "never seen before")], "id long, text string")
    for r in toxicity.totals(texts, model).collect():
        words, pairs = plain_expressions(dict(rows).get(r["id"], "never seen before" if r["id"] == 1000 else ""))
        assert r["words"] == len(words)
        assert abs(r["total"] - sum(map(ratio, words)) - sum(map(ratio, pairs))) <= len(words) + len(pairs)


def test_parts_count_each_expression_once(spark, monkeypatch):
    """The parts share no expression, each moves only its own, and the model is that of a single pass."""
    rows, labels = insulting(20)
    rows, toxic = rows[:200], dict(labels[:200])
    frame = spark.createDataFrame([(t, toxic[i]) for i, t in rows], "text string, toxic int").repartition(3)
    whole = sorted(map(tuple, toxicity.counted(frame).collect()))
    parts = [toxicity.counted(frame, part, toxicity.COUNT_PARTS) for part in range(toxicity.COUNT_PARTS)]
    found = [sorted(map(tuple, part.collect())) for part in parts]
    assert sorted(sum(found, [])) == whole and max(map(len, found)) < 0.6 * len(whole)
    how, n = toxicity.Smoothing(), [sum(t == x for t in toxic.values()) for x in (0, 1)]
    weights = [toxicity.weighed(toxicity.tallied(*x), *n, how, toxicity.JoinBudget()) for x in ([toxicity.counted(frame)], parts)]
    once, in_parts = [sorted(map(tuple, w.collect())) for w in weights]
    assert in_parts == once and once

    seen, settled = [], toxicity.settled
    monkeypatch.setattr(toxicity, "settled", lambda rows, label, *more: seen.append(label) or settled(rows, label, *more))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    assert toxicity.scored(documents, spark.createDataFrame(labels, "doc_id long, toxic int")).count() == len(rows)
    assert seen.count("expressions") == toxicity.COUNT_PARTS > 1
