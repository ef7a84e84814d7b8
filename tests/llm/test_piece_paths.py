"""Paths of the piece transducers: both kinds of models equal the library, and weights are least."""

from __future__ import annotations

import random
import struct
from itertools import product

import numpy as np
import pytest

from dockside.llm.common import tokenizer_path
from dockside.llm.piece_transducer import BARE, BYTE, NORMAL, Transducer

LETTERS = "abcde"


def field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, float):
        return bytes([number << 3 | 5]) + struct.pack("<f", value)

    def varint(n: int) -> bytes:
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def model(path, kind: int, pieces: dict[str, float], with_bytes: bool) -> str:
    """A small model file: unknown, begin, end, bytes, then the pieces."""
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    rows += [(f"<0x{b:02X}>", 0.0, BYTE) for b in range(256) if with_bytes]
    rows += [(text, score, NORMAL) for text, score in pieces.items()]
    body = b"".join(field(1, field(1, t.encode()) + field(2, s) + field(3, k)) for t, s, k in rows)
    trainer = field(3, kind) + field(35, int(with_bytes))
    normaliser = field(1, b"identity") + field(3, 1) + field(4, 0) + field(5, 1)
    path.write_bytes(body + field(2, trainer) + field(3, normaliser))
    return str(path)


def summed_pieces(seed: int) -> dict[str, float]:
    """Scores in sixty-fourths, so sums are exact and ties occur; 'e' is no piece alone."""
    draw = random.Random(seed)
    texts = ["▁", *LETTERS[:-1]]
    texts += sorted({"".join(draw.choices(LETTERS + "▁", k=draw.randint(2, 5))) for _ in range(60)} - set(texts))
    return {text: -draw.randint(64, 640) / 64 for text in texts}


def some_texts(seed: int) -> list[str]:
    draw = random.Random(seed)
    return ["", " ", "e", "xé世🙂", "ee e"] + ["".join(draw.choices(LETTERS + "  é世", k=draw.randint(1, 60))) for _ in range(300)]


@pytest.mark.parametrize("with_bytes", [True, False])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_summed_scores_equal_the_library(tmp_path, seed, with_bytes):
    import sentencepiece

    path = model(tmp_path / "summed.model", 1, summed_pieces(seed), with_bytes)
    library, machine = sentencepiece.SentencePieceProcessor(model_file=path), Transducer(path)
    for text in some_texts(seed):
        assert machine.encode(text).tolist() == library.encode(text), text


@pytest.mark.parametrize("with_bytes", [True, False])
def test_merges_equal_the_library(tmp_path, with_bytes):
    import sentencepiece

    draw = random.Random(4)
    texts = ["▁", *LETTERS[:-1]]
    for _ in range(60):  # each piece merges two earlier ones
        texts.append("".join(draw.choices(texts, k=2)))
    pieces = {text: -float(rank) for rank, text in enumerate(dict.fromkeys(t for t in texts if len(t) < 9))}
    path = model(tmp_path / "merges.model", 2, pieces, with_bytes)
    library, machine = sentencepiece.SentencePieceProcessor(model_file=path), Transducer(path)
    for text in some_texts(5):
        assert machine.encode(text).tolist() == library.encode(text), text


def test_path_has_the_least_weight(tmp_path):
    """Against all ways to cut a word."""
    machine = Transducer(model(tmp_path / "summed.model", 1, summed_pieces(6), True))

    def weight(parts: list[str]) -> float:
        if not all(p in machine.number or (len(p) == 1 and p not in machine.number) for p in parts):
            return float("inf")
        return sum(-machine.score[p] if p in machine.number else machine.unknown_weight for p in parts)

    for word in map("".join, product(LETTERS, repeat=5)):
        ways = []
        for cuts in product([False, True], repeat=len(word) - 1):
            parts = [word[0]]
            for char, cut in zip(word[1:], cuts):
                parts = [*parts, char] if cut else [*parts[:-1], parts[-1] + char]
            ways.append(weight(parts))
        taken, at = 0.0, 0
        for number in machine.shortest(word):
            byte = machine.kinds[number] == BYTE
            taken += machine.unknown_weight if byte else -machine.score[machine.texts[number]]
            at += 1 if byte else len(machine.texts[number])
        assert at == len(word) and taken == min(ways)


def test_one_path_of_finite_weight_to_each_place():
    """In a model of merges, every place is reached with the pieces that merging its beginning leaves."""
    machine = Transducer(tokenizer_path("piece_bpe_32k.model"))
    for word in ["▁tokenisation", "▁abracadabra", "▁Donaudampfschiff", "éclaircissement", "▁xyzzyx"]:
        for end in range(1, len(word) + 1):
            wanted = machine.merged(word[:end])
            numbers = [machine.number[p] for p in wanted]
            assert machine.shortest(word[:end]) == numbers
            assert all(machine.apart(a, b) for a, b in zip([BARE, *numbers], numbers))


def test_very_long_word(tmp_path):
    machine = Transducer(model(tmp_path / "summed.model", 1, summed_pieces(7), True))
    word = "abcd" * 50_000
    assert machine.decode(np.asarray(machine.shortest(word))) == word


def test_refused_models(tmp_path):
    with pytest.raises(ValueError, match="up to 0"):
        Transducer(model(tmp_path / "m", 1, {"a": 1.0}, True))
    with pytest.raises(ValueError, match="summed scores"):
        Transducer(model(tmp_path / "m", 3, {"a": -1.0}, True))
