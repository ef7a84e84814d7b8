"""The corpus pipeline as a whole, each stage held against a plain version on what the one before kept."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from llm import brute
from llm.test_contracts import ODD

from dockside.llm.common import settled
from dockside.llm.queries import ORACLE

SF = "/root/testdata/sf0.001"


def folder_of(spark, path, documents, labels):
    documents.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.fixture
def recorded(monkeypatch):
    """Each stage's result, as the pipeline writes it."""
    kept = {}

    def record(rows, label):
        kept[label] = settled(rows, label)
        return kept[label]

    monkeypatch.setattr(corpus_pipeline, "settled", record)
    return kept


def pairs(rows):
    return [(r["doc_id"], r["text"]) for r in rows.select("doc_id", "text").collect()]


def ids(rows):
    return Counter(i for i, _ in rows)


def test_stages_on_given_and_odd_rows(spark, tmp_path, recorded):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    own = " ".join(f"own{k}" for k in range(80))
    more = [(1_000_000 + (i or 0) if i else None, t, "x", "odd", None) for i, t in ODD]
    more += [(None, own + " end", None, None, None), (None, own + " end", None, None, 3), (2_000_000, own, "x", "odd", None)]
    more += [(2_000_001, own + " password=hunter2hunter2", "x", "odd", None)]
    odd = spark.createDataFrame(more, given.schema)
    folder = folder_of(spark, tmp_path, given.unionByName(odd).repartition(3), spark.read.parquet(f"{SF}/labels.parquet"))
    packed = corpus_pipeline.run(spark, folder)
    assert list(recorded) == [name for name, _ in corpus_pipeline.STAGES]
    for name in list(recorded)[:-1]:
        assert recorded[name].columns == given.columns

    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
        judged = con.execute(f"SELECT doc_id, kept, n_words - words_removed FROM ({ORACLE['op10_quality_rules']})").fetchall()
    passed = pairs(recorded["quality_rules"])
    words = Counter((i, len(brute.WORD.findall(t))) for i, t in passed)
    assert words == Counter((i, left) for i, kept, left in judged if kept)

    clean = pairs(recorded["toxicity"])
    assert not Counter(clean) - Counter(passed)
    harmless = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    lost = Counter(passed) - Counter(clean)
    assert sum(n for (i, _), n in lost.items() if i in harmless) <= 0.02 * len(passed)

    single = pairs(recorded["near_copies"])
    rows = sorted(clean, key=lambda row: (row[0] is None, row[0] or 0))
    groups = brute.near_copies(dict(enumerate(t for _, t in rows)), 5)
    firsts = {group for _, group in groups.values()}
    assert ids(single) == Counter(rows[n][0] for n in firsts)
    assert not Counter(single) - Counter(clean)

    masked = pairs(recorded["secret_scans"])
    assert ids(masked) == ids(single)
    held = [t for _, t in single if any(brute.secrets(t)[c] for c in ("n_assign", "n_access", "n_hex"))]
    assert not any(brute.secrets(t)[c] for _, t in masked for c in ("n_assign", "n_access", "n_hex"))
    assert Counter(t for _, t in single) - Counter(held) <= Counter(t for _, t in masked)

    tokens = brute.all_ids(corpus_pipeline.BYTE_VOCABULARY, [t for _, t in masked])
    sizes = Counter()
    for row in packed.collect():
        sizes[row["doc_id"]] += row["length"]
    wanted = Counter()
    for (doc_id, _), found in zip(masked, tokens, strict=True):
        wanted[doc_id] += len(found) + 1
    assert sizes == wanted


def test_empty_tables(spark, tmp_path, recorded):
    given = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    labels = spark.read.parquet(f"{SF}/labels.parquet").limit(0)
    assert corpus_pipeline.run(spark, folder_of(spark, tmp_path, given, labels)).count() == 0
