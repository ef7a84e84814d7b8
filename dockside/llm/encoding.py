"""Token ids of whole texts, as the tokenizers library gives them for a vocabulary file.

The merges of the file are run by tiktoken, which is several times as fast, for
texts in which both libraries provably split alike: Latin-1 characters (stable
under NFC, with known letter and digit classes), no special strings.  Any other
text goes through the tokenizers library itself.  Tests compare the two.
"""

from __future__ import annotations

import json
import os
import re
from functools import cache

import numpy as np

# White space, letters and digits of Latin-1, as Unicode has them.
SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0"
LETTER = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff"
DIGIT = "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"

#: Pieces of a lower-cased text in the vocabulary with word ends; other characters drop out.
WORD_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{DIGIT}]|[^{SPACE}{LETTER}{DIGIT}]+")

#: Split of a text in the byte-level vocabulary, where words keep the space before them.
BYTE_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def class_of_each_byte() -> bytes:
    """0 for white space, 1 for letters, 2 for digits, 3 for the rest of Latin-1."""
    kinds = [(0, re.compile(f"[{SPACE}]")), (1, re.compile(f"[{LETTER}]")), (2, re.compile(f"[{DIGIT}]"))]
    return bytes(next((k for k, of in kinds if of.match(chr(b))), 3) for b in range(256))


CLASSES = class_of_each_byte()
BLANKED = bytes(32 if CLASSES[b] == 0 else b for b in range(256))


def byte_of_character() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies, reversed."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class TextEncoder:
    """Ids of texts, as arrays of unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.vocabulary = self.library.get_vocab_size()
        self.kind = self.kind_of(spec)
        self.merges = self.fast_merges(spec) if self.kind else None

    @staticmethod
    def kind_of(spec: dict) -> str:
        """Which of the two known splits the file describes; empty for any other."""
        pre = spec.get("pre_tokenizer") or {}
        if spec["model"].get("dropout") or spec["model"].get("ignore_merges"):
            return ""
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            return "" if spec.get("normalizer") else "bytes"
        steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        first = (pre.get("pretokenizers") or [{}])[0]
        words = first.get("behavior") == "Removed" and first.get("invert") and "'s|'t|'re|'ve|'m|'ll|'d" in str(first)
        if words and steps == ["NFC", "Replace", "Lowercase"] and spec["model"].get("end_of_word_suffix") == "</w>":
            return "words"
        return ""

    def fast_merges(self, spec: dict):
        """The file's merges for tiktoken, or None where ids do not rank them.

        A word end is written as a trailing space, which no piece contains.  A
        byte with a word end has a lower id than any merge, so it forms first.
        """
        import tiktoken

        of = byte_of_character()
        vocabulary, special = spec["model"]["vocab"], set(self.special)
        ranks = {}
        for token, number in vocabulary.items():
            if token in special:
                continue
            body = token.removesuffix("</w>") if self.kind == "words" else token
            end = b" " if body != token else b""
            ranks[bytes(of[c] for c in body) + end] = number
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        order = [vocabulary[m] for m in merged]
        ranked = order == sorted(order) and order[0] == (512 if self.kind == "words" else 256)
        if not ranked or len(ranks) != len(vocabulary) - len(special & vocabulary.keys()):
            return None
        pattern = "[^ ]+ " if self.kind == "words" else BYTE_PIECES
        return tiktoken.Encoding("merges", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def pieces_apart(text: str) -> str:
        """A Latin-1 text's pieces, each with a space behind it."""
        text = text.lower()
        if "'" in text:
            return " ".join([*WORD_PIECES.findall(text), ""])
        raw = text.encode("latin-1")
        kinds = np.frombuffer(raw.translate(CLASSES), dtype=np.uint8)
        if not len(kinds):
            return ""
        # A piece ends where the class changes, and behind each digit.
        apart = np.concatenate([[False], (kinds[1:] != kinds[:-1]) | (kinds[1:] == 2)])
        places = np.arange(len(kinds)) + np.cumsum(apart)
        spaced = np.full(places[-1] + 2, 32, dtype=np.uint8)
        spaced[places] = np.frombuffer(raw.translate(BLANKED), dtype=np.uint8)
        return spaced.tobytes().decode("latin-1")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        slow = []
        for i, text in enumerate(texts):
            if self.merges is None or any(s in text for s in self.special):
                slow.append(i)
                continue
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                slow.append(i)
                continue
            ready = self.pieces_apart(text) if self.kind == "words" else text
            out[i] = np.array(self.merges.encode_ordinary(ready), dtype=np.uint32)
        for i, found in zip(slow, self.library.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False), strict=True):
            out[i] = np.array(found.ids, dtype=np.uint32)
        return out


@cache
def text_encoder(path: str) -> TextEncoder:
    """One encoder per worker process."""
    return TextEncoder(path)
