"""Alignment of two tokenizers over the same bytes, by products of sparse incidence matrices.

Each tokenization of a text is a matrix of tokens by bytes, in compressed rows: a
token's row names the bytes it covers.  The product A . B' of two of them, row by
row after Gustavson, holds an entry for each pair of tokens that overlap.  Bytes
behind which a token of both ends cut the text into groups; a second pair of
matrices says which token is in which group, and their product holds the pairs
that share a group.

Over a corpus, the documents in which two ids are linked are counted.  The most
frequent pairs, as many as fit a fixed room, are looked up where documents are
read; all others are joined, with the same results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockside.llm.common import settled, tokenizer_path, whole_text
from dockside.llm.encoding import TextEncoder, byte_of_character

#: Bytes of text whose overlaps are multiplied at once; a longer single group is one product.
SPAN = 1 << 20

#: Characters of text that are tokenized together.
TEXTS_AT_ONCE = 1 << 20

#: Most id pairs that are looked up without a join.
AT_HAND = 1 << 20


@dataclass(frozen=True)
class Csr:
    """A matrix of zeros and ones: row i has its ones in columns ``columns[first[i]:first[i + 1]]``."""

    first: np.ndarray
    columns: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.first) - 1

    def rows(self) -> np.ndarray:
        """The row of each one."""
        return np.repeat(np.arange(self.height), np.diff(self.first))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        first = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(first, self.rows()[order], self.height)


def bytes_of_tokens(lengths: np.ndarray) -> Csr:
    """Tokens by bytes, for tokens that lie one behind the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]), np.arange(total), total)


def groups_of_tokens(group: np.ndarray, groups: int) -> Csr:
    """Tokens by groups, each token in one."""
    return Csr(np.arange(len(group) + 1), group, groups)


def row_sizes(a: Csr, b: Csr) -> np.ndarray:
    """Terms in each row of a . b, before equal columns are joined."""
    terms = np.diff(b.first)[a.columns]
    sums = np.concatenate([[0], np.cumsum(terms)])
    return sums[a.first[1:]] - sums[a.first[:-1]]


def product(a: Csr, b: Csr) -> Csr:
    """Where a . b is not zero: row i joins the rows of ``b`` that row i of ``a`` names."""
    terms = np.diff(b.first)[a.columns]
    before = np.cumsum(terms) - terms
    place = np.arange(int(terms.sum())) + np.repeat(b.first[:-1][a.columns] - before, terms)
    code = np.repeat(a.rows() * b.width, terms) + b.columns[place]
    if (code[1:] < code[:-1]).any():
        code.sort()
    code = code[np.concatenate([[True], code[1:] != code[:-1]])] if len(code) else code
    rows, columns = np.divmod(code, max(1, b.width))
    return Csr(np.searchsorted(rows, np.arange(a.height + 1)), columns, b.width)


@dataclass(frozen=True)
class Alignment:
    """Tokens of one text by two tokenizers: ids, lengths in bytes, and the group of each token."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    lengths_a: np.ndarray
    lengths_b: np.ndarray
    common: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray

    def overlap_links(self) -> tuple[np.ndarray, np.ndarray]:
        """(a, b): places of the tokens whose byte ranges overlap, by A . B' over spans of whole groups."""
        found_a, found_b = [], []
        at = i = j = 0
        while at < len(self.common):
            begin = self.common[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(self.common, begin + SPAN, side="right")))
            i_end, j_end = (int(np.searchsorted(g, to)) for g in (self.group_a, self.group_b))
            a, b = bytes_of_tokens(self.lengths_a[i:i_end]), bytes_of_tokens(self.lengths_b[j:j_end])
            links = product(a, b.transposed())
            found_a.append(links.rows() + i)
            found_b.append(links.columns + j)
            at, i, j = to, i_end, j_end
        if not found_a:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_a), np.concatenate(found_b)

    def incidences(self) -> tuple[Csr, Csr]:
        """Tokens of A by groups, and groups by tokens of B."""
        n = len(self.common)
        return groups_of_tokens(self.group_a, n), groups_of_tokens(self.group_b, n).transposed()

    def shared_group_links(self) -> tuple[np.ndarray, np.ndarray]:
        """(a, b): places of the tokens that are in one group."""
        links = product(*self.incidences())
        return links.rows(), links.columns

    def shared_group_count(self) -> int:
        """How many of them there are, without spelling them out."""
        return int(row_sizes(*self.incidences()).sum())


def aligned(ids_a: np.ndarray, ids_b: np.ndarray, lengths_a: np.ndarray, lengths_b: np.ndarray) -> Alignment:
    ends_a, ends_b = np.cumsum(lengths_a), np.cumsum(lengths_b)
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    return Alignment(ids_a, ids_b, lengths_a, lengths_b, common, np.searchsorted(common, ends_a), np.searchsorted(common, ends_b))


class TokenizerPair:
    """A byte-level vocabulary (A), given a space in front of a text, and a model of pieces (B), which adds it."""

    def __init__(self, tokenizer_a: str, model_b: str):
        import sentencepiece

        # An encoder of its own: special strings in a text are plain text here.
        self.a = TextEncoder(tokenizer_a)
        self.a.library.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_b)
        of = byte_of_character()
        tokens = {i: token for token, i in self.a.library.get_vocab(with_added_tokens=True).items()}
        special = set(self.a.special)
        self.bytes_a = [
            tokens[i].encode() if tokens[i] in special else bytes(of[c] for c in tokens[i])
            for i in range(self.a.vocabulary)
        ]
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in pieces]
        self.lengths_a, self.lengths_b = (np.array([len(t) for t in side]) for side in (self.bytes_a, self.bytes_b))
        # Spelled-out ids: of A with , or | behind, then of B with , or ; behind.
        self.spelled = [f"{i}{s}" for i in range(len(self.bytes_a)) for s in ",|"]
        self.first_b = len(self.spelled)
        self.spelled += [f"{i}{s}" for i in range(len(self.bytes_b)) for s in ",;"]

    def align(self, texts: list[str]) -> list[Alignment | None]:
        """None for a text that is empty or that either tokenizer does not give back byte for byte."""
        found: list[Alignment | None] = []
        ids_a = self.a.encode([" " + text for text in texts])
        ids_b = self.b.encode(texts, num_threads=1)
        for text, a, b in zip(texts, ids_a, ids_b, strict=True):
            whole = b" " + text.encode()
            same = text and whole == b"".join(map(self.bytes_a.__getitem__, a.tolist())) == b"".join(map(self.bytes_b.__getitem__, b))
            if same:
                a, b = a.astype(np.int64), np.array(b, dtype=np.int64)
                found.append(aligned(a, b, self.lengths_a[a], self.lengths_b[b]))
            else:
                found.append(None)
        return found

    def spell(self, one: Alignment) -> str:
        """The groups as ``a1,a2|b1;a3|b2,b3``."""
        groups = len(one.common)
        count_a, count_b = (np.bincount(g, minlength=groups) for g in (one.group_a, one.group_b))
        last_a, last_b = (np.concatenate([g[1:] != g[:-1], [True]]) for g in (one.group_a, one.group_b))
        before_b = np.cumsum(count_b) - count_b
        codes = np.empty(len(one.ids_a) + len(one.ids_b), np.int64)
        codes[np.arange(len(one.ids_a)) + before_b[one.group_a]] = 2 * one.ids_a + last_a
        codes[np.arange(len(one.ids_b)) + np.cumsum(count_a)[one.group_b]] = self.first_b + 2 * one.ids_b + last_b
        return "".join(map(self.spelled.__getitem__, codes.tolist()))[:-1]


@cache
def tokenizer_pair(tokenizer_a: str, model_b: str) -> TokenizerPair:
    """One per worker process."""
    return TokenizerPair(tokenizer_path(tokenizer_a), tokenizer_path(model_b))


def runs(texts: list[str]) -> Iterator[slice]:
    """Neighbouring texts of about TEXTS_AT_ONCE characters together."""
    at = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= TEXTS_AT_ONCE or i == len(texts) - 1:
            yield slice(at, i + 1)
            at, size = i + 1, 0


ID_BITS = 32

ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_shared bigint, groups_sha256 string, "
    "pairs array<bigint>, times array<int>"
)


def document_links(documents: DataFrame, tokenizer_a: str, model_b: str) -> DataFrame:
    """Per row of ``documents`` its token, group and link counts, its groups' digest, and its linked id pairs.

    ``pairs`` holds each pair (id of A times 2^32 plus id of B) once, ``times``
    how many links have it.
    """

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = tokenizer_pair(tokenizer_a, model_b)
        none = (0, 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int32))
        for batch in batches:
            texts = batch["text"].tolist()
            for run in runs(texts):
                out = []
                for one in pair.align(texts[run]):
                    if one is None:
                        out.append(none)
                        continue
                    a, b = one.overlap_links()
                    keys, times = np.unique((one.ids_a[a] << ID_BITS) + one.ids_b[b], return_counts=True)
                    digest = hashlib.sha256(pair.spell(one).encode()).hexdigest()
                    sizes = (len(one.ids_a), len(one.ids_b), len(one.common), len(a), one.shared_group_count())
                    out.append((*sizes, digest, keys, times.astype(np.int32)))
                names = ["n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256", "pairs", "times"]
                frame = pd.DataFrame(dict(zip(names, zip(*out, strict=True), strict=True)))
                frame.insert(0, "doc_id", batch["doc_id"].iloc[run].astype("Int64").to_numpy())
                yield frame.astype({"doc_id": "Int64"})

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInPandas(links, ALIGNED)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, documents, best): how many documents hold it linked, and whether that is the most of its id of A."""
    counts = settled(links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents")), "pairs")
    id_a = F.shiftright("pair", ID_BITS).alias("id_a")
    most = counts.groupBy(id_a).agg(F.max("documents").alias("most"))
    # One row per id of A: no more than its vocabulary has.
    counts = counts.withColumn("id_a", id_a).join(F.broadcast(most), "id_a")
    return counts.select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def at_hand(counts: DataFrame, room: int) -> int:
    """From how many documents on a pair is looked up, so that at most ``room`` are."""
    level = F.floor(4 * F.log2("documents")).alias("level")
    together, least = 0, None
    steps = counts.groupBy(level).agg(F.count("*").alias("n"), F.min("documents").alias("least"))
    for row in steps.orderBy(F.desc("level")).collect():  # a few hundred steps at most
        together += row["n"]
        if together > room:
            break
        least = row["least"]
    return least if least is not None else 1 << 62


def token_alignment(documents: DataFrame, tokenizer_a: str, model_b: str, room: int = AT_HAND) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_shared.

    n_best counts the links whose pair of ids is linked in the most documents
    among the pairs of its id of A, ties included; count_sum adds up those
    documents over the links.  A missing or empty text, or one that either
    tokenizer does not give back byte for byte, has zeros and no digest.  Very
    long texts are multiplied in spans of whole groups.  Rows that repeat count
    as documents of their own and a missing doc_id stays missing; other columns
    are not looked at; an empty table gives no rows.
    """
    spark = documents.sparkSession
    table = document_links(documents, tokenizer_a, model_b).withColumn("row", F.monotonically_increasing_id())
    table = settled(table, "alignments", compression="zstd")
    counts = settled(pair_counts(table), "pair-counts")
    least = at_hand(counts, room)
    near = counts.where(F.col("documents") >= least).toArrow()  # at most ``room`` rows
    keys = near["pair"].to_numpy()
    order = np.argsort(keys)
    known = spark.sparkContext.broadcast(
        (keys[order], near["documents"].to_numpy()[order], near["best"].to_numpy(zero_copy_only=False)[order])
    )
    own = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_shared"]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, documents, best = known.value
        for batch in batches:
            out = []
            for pairs, times in zip(batch["pairs"], batch["times"], strict=True):
                place = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
                hit = keys[place] == pairs if len(keys) else np.zeros(len(pairs), bool)
                place, seen = place[hit], times[hit]
                out.append((int((best[place] * seen).sum()), int((documents[place] * seen).sum()), pairs[~hit], times[~hit]))
            frame = batch[own].copy()
            for name, values in zip(("n_best", "count_sum", "pairs", "times"), zip(*out, strict=True), strict=True):
                frame[name] = pd.Series(values, index=frame.index)
            yield frame

    kinds = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_shared bigint, "
    scored = table.mapInPandas(score, kinds + "n_best bigint, count_sum bigint, pairs array<bigint>, times array<int>")
    rest = counts.where(F.col("documents") < least)
    shown = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"]
    if rest.isEmpty():
        return scored.select(*shown)
    scored = settled(scored, "scored", compression="zstd")
    far = scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
    far = far.withColumnRenamed("pairs", "pair").join(rest, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("best").cast("int")).alias("far_best"),
        F.sum(F.col("times") * F.col("documents")).alias("far_sum"),
    )
    both = scored.drop("pairs", "times").join(far, "row", "left")
    both = both.withColumn("n_best", F.col("n_best") + F.coalesce("far_best", F.lit(0)))
    return both.withColumn("count_sum", F.col("count_sum") + F.coalesce("far_sum", F.lit(0))).select(*shown)
