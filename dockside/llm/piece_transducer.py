"""SentencePiece encoding and decoding by weighted finite-state transducers.

Three machines are compiled from a model file:

* the normaliser, of one state: an arc per character, blanks become the visible
  one, and one is written in front of a text;
* the pieces: an arc per piece over its characters.  In a model of summed scores it
  weighs the negated score.  In a model of pair merges the state after an arc
  remembers its piece, and an arc weighs nothing if merging the text of the last
  piece and its own alone leaves both as they are, else infinitely much;
* the byte fallback: an arc per character without a piece, over its UTF-8 bytes.
  It weighs one per byte, or in a model of summed scores what an unknown piece does.

They are composed with each input as it is read, and the answer is the shortest
path in the tropical semiring: weights add along a path, the least total wins.
Arcs are weighed only when the search comes to them.

Merging a text never crosses the ends of the pieces it leaves, so it leaves any two
neighbours of them apart also when they are merged alone; and the first merge that
crossed an end would show in the two pieces at that end.  So the merges of a text
are the one path of finite weight, and for each place in the text there is one state
of finite weight.  No path crosses a place that no piece spans, so texts are
cut there and the path of each word is found once per worker and remembered.

Refused are models with a character map, with blanks removed, with user-defined or
unused pieces, or with scores above zero where they are summed.  Sums are kept in double
precision; the library's single precision may settle near ties in very long words otherwise.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockside.llm.common import tokenizer_path, whole_text

BLANK = "▁"

# Fixed values of the model file's format: kinds of pieces, and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SUMMED_SCORES, PAIR_MERGES = 1, 2

#: How far the score of an unknown piece is below the least one; fixed value.
UNKNOWN_BELOW = 10.0

#: In a path, a character without a piece.
BARE = -1

#: Characters read, weight, and the piece written.
Arc = tuple[int, float, int]

#: Words and pairs remembered per worker; a full memory of pairs starts anew.
KEPT_WORDS = 400_000
KEPT_PAIRS = 500_000


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = number(at)
        if tag & 7 == 0:
            value, at = number(at)
        else:
            size, at = number(at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class Paths(dict[str, bytes]):
    """Ids of the words met of late; of two halves of the memory the older one is dropped."""

    def __init__(self, machine: Transducer):
        self.machine = machine
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        path = self.older.get(word)
        if path is None:
            ids = self.machine.shortest(word)
            path = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= KEPT_WORDS // 2:
            self.older = dict(self)
            self.clear()
        self[word] = path
        return path


class Transducer:
    def __init__(self, path: str):
        with open(path, "rb") as file:
            message = list(fields(file.read()))
        trainer = dict(fields(next(v for k, v in message if k == 2)))
        normaliser = dict(fields(next((v for k, v in message if k == 3), b"")))
        self.merges = trainer.get(3, SUMMED_SCORES) == PAIR_MERGES
        if trainer.get(3, SUMMED_SCORES) not in (SUMMED_SCORES, PAIR_MERGES) or normaliser.get(2):
            raise ValueError("only models of pair merges or summed scores without a character map are compiled")
        if normaliser.get(4, 1) or not normaliser.get(5, 1):
            raise ValueError("only normalisers that keep all blanks and show them are compiled")
        self.dummy_prefix = bool(normaliser.get(3, 1))
        self.texts: list[str] = []
        self.kinds: list[int] = []
        self.score: dict[str, float] = {}
        self.number: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        for number, piece in enumerate(v for k, v in message if k == 1):
            parts = dict(fields(piece))
            text, kind = parts[1].decode(), parts.get(3, NORMAL)
            self.texts.append(text)
            self.kinds.append(kind)
            if kind == BYTE:
                self.bytes[int(text[3:5], 16)] = number
            elif kind == NORMAL:
                self.number[text] = number
                self.score[text] = float(np.frombuffer(parts[2], "<f4")[0])
            elif kind in (USER_DEFINED, UNUSED):
                raise ValueError("user-defined and unused pieces are not compiled")
        self.raw = [b"" if kind == CONTROL else text.encode() for text, kind in zip(self.texts, self.kinds)]
        for byte, number in self.bytes.items():
            self.raw[number] = bytes([byte])
        self.unknown = self.kinds.index(UNKNOWN)
        if self.merges and not set("".join(self.number)) <= set(self.number):
            raise ValueError("only merges in which every character of a piece is a piece are compiled")
        if not self.merges and max(self.score.values()) > 0:
            raise ValueError("only scores up to 0 are summed")
        self.unknown_weight = UNKNOWN_BELOW - min(self.score.values())
        self.lengths = [*map(len, self.texts), 1]
        #: The arcs along each beginning of a piece: length, weight and number, long ones first.
        self.arcs: dict[str, tuple[Arc, ...]] = {}
        for text in sorted(self.number, key=len):
            for end in range(1, len(text) + 1):
                front = text[:end]
                if front not in self.arcs:
                    less = self.arcs[front[:-1]] if end > 1 else ()
                    self.arcs[front] = (self.arc(front), *less) if front in self.number else less or (self.bare(front),)
        #: Where no piece spans a cut, no merge does; letters may be cut from the rest in most models.
        odd = re.escape("".join(c for c in self.number if re.fullmatch("[^\\W\\d_]", c) and not c.isalpha()))
        letter, other = f"[^\\W\\d_{odd}]", f"(?:(?!{BLANK})[\\W\\d_{odd}])"
        cuts = (f"{BLANK}*(?:{letter}+|{other}+)|{BLANK}+", f"{BLANK}*[^{BLANK}]+|{BLANK}+", "(?s).+")
        self.words = next(re.compile(c) for c in cuts if all(re.fullmatch(c, t) and len(re.findall(c, t)) == 1 for t in self.number))
        self.paths = Paths(self)
        self.pairs: dict[int, bool] = {}

    def normalised(self, text: str) -> str:
        return ((" " if self.dummy_prefix and text else "") + text).replace(" ", BLANK)

    def arc(self, piece: str) -> Arc:
        """The arc of a piece, apart from what its neighbour adds."""
        return len(piece), 0.0 if self.merges else -self.score[piece], self.number[piece]

    def bare(self, char: str) -> Arc:
        """The fallback's arc over a character."""
        return 1, float(len(char.encode("utf-8", "replace"))) if self.merges else self.unknown_weight, BARE

    def merged(self, text: str) -> list[str]:
        """The pieces that merges leave of a short text, best score first, then leftmost."""
        parts, score = list(text), self.score.get
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                value = score(parts[i] + parts[i + 1])
                if value is not None and (best is None or value > best):
                    best, at = value, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def apart(self, left: int, right: int) -> bool:
        """Whether merging leaves the two pieces (the second alone, after ``BARE``) as they are."""
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        pieces = [self.texts[number] for number in (left, right) if number != BARE]
        found = self.pairs[left << 32 | right] = self.merged("".join(pieces)) == pieces
        return found

    def fallback(self, char: str) -> list[int]:
        """Output for a character without a piece."""
        if len(self.bytes) < 256:
            return [self.unknown]
        return [self.bytes[b] for b in char.encode("utf-8", "replace")]

    def shortest(self, word: str) -> list[int]:
        """Ids along the path of least weight through the composition with one word.

        The arc of least total is settled place by place; of equal totals the farther
        place comes first, then the arc from the earlier place.
        """
        arcs, pairs, merges, size = self.arcs, self.pairs, self.merges, len(word)
        into: list[int | None] = [None] * (size + 1)
        agenda: list[tuple[float, int, int, int]] = []
        total, end, number = 0.0, 0, BARE
        while True:
            into[end] = number
            if end == size:
                break
            along, stop = None, end + 1
            while stop <= size and (longer := arcs.get(word[end:stop])) is not None:
                along, stop = longer, stop + 1
            for length, weight, number in along or (self.bare(word[end]),):
                heappush(agenda, (total + weight, -end - length, end, number))
            while True:
                total, end, start, number = heappop(agenda)
                if into[-end] is None:
                    if number == BARE or not merges:
                        break
                    finite = pairs.get(into[start] << 32 | number)
                    if self.apart(into[start], number) if finite is None else finite:
                        break
            end = -end
        path: list[int] = []
        at = size
        while at:
            number = into[at]
            path.append(number)
            at -= self.lengths[number]
        path.reverse()
        if min(path) != BARE:
            return path
        out = []
        for number in path:
            out += [number] if number != BARE else self.fallback(word[at])
            at += self.lengths[number]
        return out

    def encode(self, text: str) -> np.ndarray:
        parts = self.words.findall(self.normalised(text))
        ids = np.frombuffer(b"".join(map(self.paths.__getitem__, parts)), dtype="<u4")
        if len(self.bytes) == 256 or len(ids) < 2:
            return ids
        # Without bytes, a run of unknown characters is one unknown piece.
        again = np.concatenate([[False], (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)])
        return ids[~again]

    def decode(self, ids: np.ndarray) -> str:
        """The machines run backwards: pieces and bytes to text, without the blank in front."""
        raw = b"".join(map(self.raw.__getitem__, ids.tolist()))
        text = raw.decode("utf-8", "replace").replace(BLANK, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


@cache
def transducer(path: str) -> Transducer:
    """One transducer per worker process."""
    return Transducer(path)


def encoded(documents: DataFrame, model: str) -> DataFrame:
    """doc_id and ids (array) of every row; a missing text counts as empty and has no ids."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = transducer(tokenizer_path(model))
        for batch in batches:
            ids = [machine.encode(text).astype(np.int32) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "ids": ids})

    given = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return given.mapInPandas(encode, "doc_id bigint, ids array<int>")


def decoded(rows: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows with ids."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = transducer(tokenizer_path(model))
        for batch in batches:
            texts = [machine.decode(np.asarray(ids)) for ids in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text": texts})

    return rows.select("doc_id", "ids").mapInPandas(decode, "doc_id bigint, text string")


def round_trips(documents: DataFrame, model: str) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 and text_sha256 of the decoded text, of every row.

    Ids are taken as little-endian unsigned 32-bit integers; a missing text
    counts as empty; rows that repeat are encoded alike; an empty table gives no
    rows.  The blank before a text and the visible blank in a text are the same
    to the model, so a text that holds the latter comes back with blanks.
    """
    import hashlib

    def both(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = transducer(tokenizer_path(model))
        for batch in batches:
            ids = [machine.encode(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "n_pieces": [len(i) for i in ids],
                    "ids_crc32": [zlib.crc32(i.tobytes()) for i in ids],
                    "text_sha256": [hashlib.sha256(machine.decode(i).encode("utf-8", "replace")).hexdigest() for i in ids],
                }
            )

    given = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return given.mapInPandas(both, "doc_id bigint, n_pieces bigint, ids_crc32 bigint, text_sha256 string")
