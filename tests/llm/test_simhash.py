"""SimHash groups against all pairs of fingerprints."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash
from llm import brute
from llm.test_contracts import empty, odd, small  # noqa: F401

from dockside.llm import simhash_links


def plain_fingerprint(text: str | None) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = brute.WORD.findall(lower)
    width = min(3, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + width]), 42).intdigest() for i in range(len(words) - width + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(marks: list[int]) -> list[int]:
    """The least member of each mark's component, all pairs compared."""
    root = {m: m for m in marks}

    def find(m):
        while root[m] != m:
            m = root[m]
        return m

    known = sorted(root)
    array = np.array(known, dtype=np.uint64)
    for at, mark in enumerate(known):
        near = np.flatnonzero(np.bitwise_count(array[at + 1 :] ^ np.uint64(mark)) <= 3) + at + 1
        for other in near:
            a, b = sorted((find(mark), find(known[other])))
            root[b] = a
    return [find(m) for m in marks]


@pytest.mark.parametrize("which", ["small", "odd"])
def test_groups(request, which):
    documents = request.getfixturevalue(which)
    found = simhash_links.simhash_groups(documents).collect()
    texts = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    marks = [plain_fingerprint(t) for _, t in texts]
    roots = plain_groups(marks)
    least = {}
    for (i, _), root in zip(texts, roots, strict=True):
        if i is not None:
            least[root] = min(i, least.get(root, i))
    wanted = [(i, f"{m:016x}", least.get(r)) for (i, _), m, r in zip(texts, marks, roots, strict=True)]
    assert sorted(map(repr, wanted)) == sorted(repr(tuple(r)) for r in found)
    assert len(set(roots)) < len(roots)


def test_empty_table(empty):  # noqa: F811
    assert simhash_links.simhash_groups(empty).count() == 0


def test_bits_of_long_texts_are_counted_in_blocks():
    text = " ".join(f"w{i * 7919 % 1003}" for i in range(70_000))
    hashes = simhash_links.shingle_hashes(text)
    assert len(hashes) == 69_998
    ones = [int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)]
    assert simhash_links.fingerprint(hashes) % (1 << 64) == sum(1 << b for b in range(64) if 2 * ones[b] > len(hashes))


@pytest.mark.parametrize("direct", [0, 2, 32])
def test_crowded_segments_lose_no_link(spark, direct):
    """Clusters around one value that share a segment, links of each distance, and strangers."""
    draw = np.random.default_rng(3)
    marks = set()
    for centre, half in ((0x0123456789ABCDEF, (0, 32)), (0xF0F0A5A512345678, (32, 64)), (0, (0, 64))):
        for _ in range(150):
            flips = draw.choice(np.arange(*half), draw.integers(0, 7), replace=False)
            marks.add(centre ^ sum(1 << int(b) for b in flips))
    marks |= {int(m) for m in draw.integers(0, 2**63, 200)}
    marks = sorted(marks)
    frame = spark.createDataFrame([(m - (1 << 64) if m >> 63 else m,) for m in marks], "fp bigint").repartition(3)
    found = simhash_links.linked_fingerprints(frame, direct).collect()
    root = {m: m for m in marks}

    def find(m):
        while root[m] != m:
            m = root[m]
        return m

    for r in found:
        a, b = r["a"] % (1 << 64), r["b"] % (1 << 64)
        assert 1 <= (a ^ b).bit_count() <= 3
        a, b = sorted((find(a), find(b)))
        root[b] = a
    assert [find(m) for m in marks] == plain_groups(marks)
    if direct == 0:
        assert len(found) < 40 * len(marks)
