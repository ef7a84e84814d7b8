"""Lines count by distinct documents of their host."""

from __future__ import annotations

import numpy as np

from dockside.llm import quality_rules


def spelled(kind, i):
    return kind + "".join("abcdefghij"[int(c)] for c in str(i))


def own_line(name):
    return " ".join(spelled(f"{name}x", n) for n in range(60))


def removed_words(documents, limits):
    rows = quality_rules.line_rules(documents, limits=limits).select("doc_id", "__rules.words_removed").collect()
    return {r["doc_id"]: r["words_removed"] for r in rows}


def test_lines_that_come_together_are_removed(spark):
    """60 documents of a host with 8 shared lines: each shared line counts 60 times, whatever its hash."""
    rows = []
    for host in range(12):
        shared = [spelled(f"h{spelled('', host)}s", k) for k in range(8)]
        for i in range(60):
            rows.append((host * 1000 + i, "\n".join([*shared, own_line(spelled("d", host * 1000 + i))]), f"host{host}"))
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    assert set(removed_words(documents, quality_rules.LineLimits()).values()) == {8}


def test_limit_grows_with_the_documents_of_the_host(spark):
    """A line of 15 documents stays in a host of 200, of which 20 are a tenth; copies of one document count once."""
    rows = []
    for host in range(12):
        name = spelled("h", host)
        shared = [spelled(f"{name}s", k) for k in range(10)]
        for i in range(180):
            rows.append((host * 1000 + i, "\n".join([*shared, own_line(spelled(name, i))]), name))
        for i in range(180, 200):
            again = [spelled(f"{name}r", 0)] if i < 195 else []
            rows.append((host * 1000 + i, "\n".join([*again, own_line(spelled(name, i))]), name))
        rows += [(host * 1000 + 500 + i, rows[-1][1] + "\n" + spelled(f"{name}c", 0), name) for i in range(100)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found = removed_words(documents, quality_rules.LineLimits(documents=5, share=0.1))
    at = np.array([i % 1000 for i in found])
    words = np.array(list(found.values()))
    assert (words[at < 180] == 10).all() and (words[at >= 180] == 0).all()
