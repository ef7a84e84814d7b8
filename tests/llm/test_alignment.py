"""Token alignment against all pairs of byte ranges, one text at a time."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm.test_contracts import empty, odd, small  # noqa: F401
from tokenizers import Tokenizer

from dockside.llm import token_alignment
from dockside.llm.encoding import byte_of_character

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def spans(tokens: list[bytes]) -> list[tuple[int, int]]:
    ends = np.cumsum([len(t) for t in tokens]).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def plain(texts: list[str | None]) -> list[dict]:
    library = Tokenizer.from_file(public_tokenizers.path(A))
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(B))
    of = byte_of_character()
    rows, linked = [], []
    for text in texts:
        a = library.encode(" " + (text or ""), add_special_tokens=False).ids
        b = pieces.encode(text or "")
        bytes_a = [bytes(of[c] for c in library.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = b" " + (text or "").encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            rows.append(None)
            continue
        spans_a, spans_b = spans(bytes_a), spans(bytes_b)
        links, j = [], 0
        for i, (begin, end) in enumerate(spans_a):
            while spans_b[j][1] <= begin:
                j += 1
            k = j
            while k < len(b) and spans_b[k][0] < end:
                links.append((a[i], b[k]))
                k += 1
        groups, i, j = [], 0, 0
        for end in sorted({e for _, e in spans_a} & {e for _, e in spans_b}):
            left, right = [], []
            while i < len(a) and spans_a[i][1] <= end:
                left.append(a[i])
                i += 1
            while j < len(b) and spans_b[j][1] <= end:
                right.append(b[j])
                j += 1
            groups.append((left, right))
        rows.append((len(a), len(b), groups, links))
        linked.append(set(links))
    count = Counter(p for s in linked for p in s)
    most: dict = {}
    for (x, _), n in count.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for row in rows:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, "", 0))
            continue
        n_a, n_b, groups, links = row
        spelled = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append(
            (
                n_a, n_b, len(groups), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
                hashlib.sha256(spelled.encode()).hexdigest(), sum(len(x) * len(y) for x, y in groups),
            )
        )
    return out


@pytest.mark.parametrize(("which", "room"), [("small", 1 << 20), ("small", 500), ("odd", 1 << 20), ("odd", 0)])
def test_alignment(request, which, room):
    documents = request.getfixturevalue(which)
    found = token_alignment.token_alignment(documents, A, B, room).collect()
    texts = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    wanted = [(i, *w) for (i, _), w in zip(texts, plain([t for _, t in texts]), strict=True)]
    assert sorted(map(repr, wanted)) == sorted(repr(tuple(r)) for r in found)


def test_awkward_texts(spark, monkeypatch):
    """Byte fallback, piece marks, special strings, and spans that are shorter than a text."""
    monkeypatch.setattr(token_alignment, "SPAN", 16)
    texts = ["a▁b", "<s> </s> <0x41> <|endoftext|>", "\U0001f642" * 9 + "字字", "=" * 300, " \t\n lead", "x", "\x00\x01", "naïve Σ İ"]
    pair = token_alignment.tokenizer_pair(A, B)
    for text, one, wanted in zip(texts, pair.align(texts), plain(texts), strict=True):
        if one is None:
            assert not wanted[0]
            continue
        a, b = one.overlap_links()
        assert (len(a), len(one.common), one.shared_group_count()) == (wanted[3], wanted[2], wanted[7])
        assert hashlib.sha256(pair.spell(one).encode()).hexdigest() == wanted[6]
        shared = set(zip(*(x.tolist() for x in one.shared_group_links()), strict=True))
        assert len(shared) == wanted[7] and set(zip(a.tolist(), b.tolist(), strict=True)) <= shared
    assert pair.align(texts)[0] is None


def test_products_equal_dense_ones():
    draw = np.random.default_rng(2)
    for _ in range(30):
        n, k, m = draw.integers(1, 9, 3)
        left, right = draw.random((n, k)) < 0.4, draw.random((k, m)) < 0.4
        csr = [
            token_alignment.Csr(np.concatenate([[0], np.cumsum(x.sum(1))]), np.nonzero(x)[1], x.shape[1]) for x in (left, right)
        ]
        found = np.zeros((n, m), bool)
        got = token_alignment.product(*csr)
        found[got.rows(), got.columns] = True
        assert (found == (left.astype(int) @ right > 0)).all() and got.height == n
        back = csr[0].transposed()
        turned = np.zeros((k, n), bool)
        turned[back.rows(), back.columns] = True
        assert (turned == left.T).all()
        assert (token_alignment.row_sizes(*csr) == (left.astype(int) @ right.sum(1))).all()


def test_empty_table(empty):  # noqa: F811
    assert token_alignment.token_alignment(empty, A, B).count() == 0
