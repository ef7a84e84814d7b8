"""Plain versions of the corpus operators, one text at a time."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def library_ids(name: str, text: str | None) -> list[int]:
    return Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids


def all_ids(name: str, texts: list[str | None]) -> list[list[int]]:
    library = Tokenizer.from_file(public_tokenizers.path(name))
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


BASE = [
    ("assign", re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+")),
]


def secrets(text: str | None) -> dict:
    least = {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}
    spans = []
    counts = {}
    for k, (kind, pattern) in enumerate(BASE):
        found = [m.span() for m in pattern.finditer(text or "") if least[kind](m)]
        counts[f"n_{kind}"] = len(found)
        spans += [(start, k, end, kind) for start, end in found]
    listed = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans))
    return counts | {"base_sha256": hashlib.sha256(listed.encode()).hexdigest(), "base": listed}


def quality_base(text: str | None) -> dict:
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "base_failed": len(words) < 50 or 100 * len(repeated) > 50 * len(words),
    }


def shingle_set(text: str | None, width: int) -> frozenset:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def near_copies(texts: dict[int, str | None], width: int) -> dict[int, tuple[int, int]]:
    """doc_id to (size of its set, least doc_id reachable), all pairs compared."""
    sets = {i: shingle_set(t, width) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders: dict = {}
    for i, s in sets.items():
        for shingle in s:
            holders.setdefault(shingle, []).append(i)
    common: Counter = Counter()
    for ids in holders.values():
        for x in range(len(ids)):
            for y in range(x + 1, len(ids)):
                common[ids[x], ids[y]] += 1
    for (a, b), n in common.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}
