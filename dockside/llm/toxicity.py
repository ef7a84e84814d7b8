"""Toxicity by class-conditional Kneser-Ney models of expressions.

An expression is a word or a pair of neighbours.  Per class (toxic, ordinary)
its documents are counted over all labelled rows; a text counts once.  Every
expression of a text is scored.  Its probability in a class is its discounted
count, interpolated with a probability that both classes share:

    P(e | c) = A(e) * (n(e, c) - D(n)) / n(c)  +  (1 - A(e) * (1 - L)) * S(e)

S of a word is the share of documents that hold it; S of a pair is the
continuation count of its last word, the distinct pairs that end in it.  The
discount D is the whole of a count of one, and 0.75 of a larger one; L is the mass
that discounting frees.  A is the probability, by Bayes' rule, that the classes
use the expression at different rates: near 0 for rare expressions, which back
off to what both classes share, and near 1 where counts tell them apart.  What no
class holds twice has the shared probability in both: its log-ratio is zero, so
it takes part in the freed mass and in the continuation counts, and no lookup is
needed to score it.  A text's score compares its log-likelihoods under both
models, per word; a logistic curve, fitted on labelled rows that the counts have
not seen, makes a probability of it.

The log-ratios are a written table.  The most frequent expressions, as many as
fit a fixed room, are looked up where texts are read; all others are met by
buckets of hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockside.llm.common import fold, settled, whole_text
from dockside.llm.hashing import WordHashes, windows
from dockside.operators.joins import JoinBudget, sized

WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Smoothing:
    #: Of counts from two on; a count of one is discounted whole.
    discount: float = 0.75
    #: Share of expressions that are taken to differ between the classes before any count is seen.
    differing: float = 0.001
    #: Most expressions that are looked up without a join; the others' ratios are joined, with the same result.
    at_hand: int = 1 << 20
    #: One in so many labelled rows calibrates; the others are counted.
    calibration: int = 4


def expressions(text: str, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and, in front of each, of the pair that ends there (0 for the first)."""
    words = hashes.array(WORD.findall(text.lower()))
    pairs = np.zeros(len(words), np.uint64)
    if len(words) > 1:
        pairs[1:] = windows(words, 2)
    return words, pairs


def classes_of(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the usable labels; the greater where an id has several."""
    usable = labels.where(F.col("toxic").isin(0, 1)).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    return usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def labelled(documents: DataFrame, labels: DataFrame, budget: JoinBudget) -> DataFrame:
    """(doc_id, text, toxic, part) of rows with a usable label.

    The labels are measured; only while they fit the budget are they broadcast.
    """
    side = sized(classes_of(labels), budget=budget)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return rows.join(F.broadcast(side.rows) if side.small() else side.rows, "doc_id")


#: Parts that the expressions are dealt into by hash, a power of two.  Each is counted in a pass of its own, so only its share is on disk.
COUNT_PARTS = 2


def counted(rows: DataFrame, part: int = 0, parts: int = 1) -> DataFrame:
    """(e, word, c0, c1) of one part of the expressions, all by default.

    The documents of each class that hold the expression; its last word, which is
    ``e`` for a word.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            found = {0: [], 1: []}
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                words, pairs = expressions(text, hashes)
                both, last = np.concatenate([words, pairs[1:]]), np.concatenate([words, words[1:]])
                own = both & np.uint64(parts - 1) == part
                both, last = both[own], last[own]
                e, first = np.unique(both, return_index=True)
                found[toxic].append((e, last[first]))
            for toxic, sets in found.items():
                if sets:
                    last = np.concatenate([x for _, x in sets])
                    e, first, n = np.unique(np.concatenate([x for x, _ in sets]), return_index=True, return_counts=True)
                    yield pd.DataFrame({"e": e.view(np.int64), "word": last[first].view(np.int64), "c0": n * (1 - toxic), "c1": n * toxic})

    found = rows.select("text", "toxic").mapInPandas(count, "e bigint, word bigint, c0 bigint, c1 bigint")
    return found.groupBy("e").agg(F.max("word").alias("word"), F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))


#: A row of ``tallied`` is one expression that some class holds twice, or the sums over the pairs that end in a word, or over
#: all words; sums are of one part of the expressions.
REPEATED, ENDING, WORDS = 0, 1, 2


def tallied(*counts: DataFrame) -> DataFrame:
    """What the model needs of the counts, given by parts, in written tables of kinds.

    Expressions that no class holds twice, most of all, go in as sums only, so the
    tables are far smaller than the counts; both kinds come from one shuffle.  Each
    part is written, and its shuffle removed, before the next is counted.
    """
    return reduce(DataFrame.unionByName, map(tallied_part, counts))


def tallied_part(counts: DataFrame) -> DataFrame:
    repeated = counts.where(F.greatest("c0", "c1") > 1)
    repeated = repeated.select(F.lit(REPEATED).alias("kind"), "e", "word", "c0", "c1", *[F.lit(0).cast("bigint").alias(c) for c in ("k", "k0", "k1", "s0", "s1")])
    is_pair = F.col("e") != F.col("word")
    sums = counts.groupBy(F.when(is_pair, ENDING).otherwise(WORDS).alias("kind"), F.when(is_pair, F.col("word")).alias("word")).agg(
        F.sum("c0").alias("c0"),
        F.sum("c1").alias("c1"),
        F.count("*").alias("k"),
        *[F.count_if(F.col(f"c{c}") > 0).alias(f"k{c}") for c in (0, 1)],
        *[F.count_if(F.col(f"c{c}") == 1).alias(f"s{c}") for c in (0, 1)],
    )
    return settled(repeated.unionByName(sums.withColumn("e", F.lit(None).cast("bigint"))), "expressions")


def log_factorial(n: np.ndarray) -> np.ndarray:
    """log(n!) by Stirling's series of log((n + 8)!), divided down."""
    x = np.asarray(n, float)
    down = sum(np.log(x + k) for k in range(1, 9))
    z = x + 9
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) - down


def differs(c0: np.ndarray, c1: np.ndarray, share: float, before: float) -> np.ndarray:
    """Probability that the classes differ on expressions with these counts.

    Where they agree, a holder is toxic with probability ``share``; where they
    differ, all probabilities are as likely.
    """
    split = log_factorial(c0) + log_factorial(c1) - log_factorial(c0 + c1 + 1)
    same = c1 * np.log(share) + c0 * np.log(1 - share)
    return 1 / (1 + np.exp(-np.clip(split - same + np.log(before / (1 - before)), -500, 500)))


#: Log-ratios are summed as whole multiples of 1 / SCALE, so that sums do not depend on the order.
SCALE = 1 << 24


def discounted(c: np.ndarray, how: Smoothing) -> np.ndarray:
    return np.where(c > 1, c - how.discount, 0.0)


def log_ratios(c0, c1, shared, backoff, n0: int, n1: int, how: Smoothing) -> np.ndarray:
    """log P(e | toxic) / P(e | ordinary), times SCALE."""
    a = differs(c0, c1, n1 / (n0 + n1), how.differing)
    left = (1 - a * (1 - backoff)) * shared
    toxic, ordinary = (a * discounted(c, how) / n + left for c, n in ((c1, n1), (c0, n0)))
    return np.rint(np.log(toxic / ordinary) * SCALE).astype(np.int64)


def weighed(tallies: DataFrame, n0: int, n1: int, how: Smoothing, budget: JoinBudget) -> DataFrame:
    """(e, level, ratio) of every expression that some class holds twice; ``level`` is a fourth-root-of-two step of its documents."""
    sums = tallies.where(F.col("kind") != REPEATED)
    total = sums.groupBy("kind").agg(*[F.sum(c).alias(c) for c in ("c0", "c1", "k", "k0", "k1", "s0", "s1")])
    mass = {r["kind"]: r for r in total.collect()}

    def freed(kind: int) -> float:
        """The share of mass that discounting frees: that of the class which frees more, for both."""
        found = mass.get(kind)
        parts = [(r[f"s{c}"] + how.discount * (r[f"k{c}"] - r[f"s{c}"])) / max(1, r[f"c{c}"]) for r in ([found] if found else []) for c in (0, 1)]
        return max(parts, default=0.0)

    n = n0 + n1
    columns = ["e", "c0", "c1"]
    repeated = tallies.where(F.col("kind") == REPEATED)
    is_pair = F.col("e") != F.col("word")
    words = repeated.where(~is_pair).select(*columns, ((F.col("c0") + F.col("c1")) / n).alias("shared"), F.lit(freed(WORDS)).alias("backoff"))
    ends = sized(sums.where(F.col("kind") == ENDING).groupBy("word").agg(F.sum("k").alias("ending")), budget=budget)
    pairs = repeated.where(is_pair).join(F.broadcast(ends.rows) if ends.small() else ends.rows, "word")
    # Of all pairs that documents hold, so many a document would end in the word.
    per_pair = (mass[ENDING]["c0"] + mass[ENDING]["c1"]) / n / mass[ENDING]["k"] if ENDING in mass else 0.0
    pairs = pairs.select(*columns, (F.col("ending") * per_pair).alias("shared"), F.lit(freed(ENDING)).alias("backoff"))

    def ratio(c0: pd.Series, c1: pd.Series, shared: pd.Series, backoff: pd.Series) -> pd.Series:
        return pd.Series(log_ratios(*(x.to_numpy(float) for x in (c0, c1, shared, backoff)), n0, n1, how))

    level = F.floor(4 * F.log2(F.col("c0") + F.col("c1"))).cast("int")
    of_each = F.pandas_udf(ratio, "bigint")("c0", "c1", "shared", "backoff").alias("ratio")
    return settled(words.unionByName(pairs).select("e", level.alias("level"), of_each), "weights")


#: Bits of the filter that keeps expressions without a ratio from being joined; it may only let more through.
FILTER_BITS = 1 << 26


@dataclass(frozen=True)
class Model:
    """Log-ratios of the expressions that some class holds twice, and the logistic curve.

    ``keys`` (ascending hashes) and ``ratios`` are those at hand, bounded by
    ``Smoothing.at_hand``; ``others`` (e, ratio) is the table of the rest, and
    ``bits`` its filter; about ``far`` times a counted document holds one of them.
    """

    keys: np.ndarray
    ratios: np.ndarray
    bits: np.ndarray
    others: DataFrame
    far: float
    curve: np.ndarray

    def score(self, total: Column, words: Column) -> Column:
        """The probability, from a text's summed log-ratios and its number of words."""
        n = F.greatest(words, F.lit(1)).cast("double")
        of_text = [F.lit(1.0), total / SCALE / n, total / SCALE / F.sqrt(n), F.log(n)]
        z = sum((float(b) * x for b, x in zip(self.curve, of_text, strict=True)), F.lit(0.0))
        return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def model_of(weights: DataFrame, how: Smoothing) -> Model:
    """The model without its curve, from the written ``weights``."""
    at_hand, least, far = 0, None, 0.0
    for row in weights.groupBy("level").count().orderBy(F.desc("level")).collect():
        at_hand += row["count"]
        if at_hand > how.at_hand:
            far += row["count"] * 2 ** ((row["level"] + 1) / 4)
        else:
            least = row["level"]
    near = F.col("level") >= F.lit(least) if least is not None else F.lit(False)
    table = weights.where(near).select("e", "ratio").toArrow()
    keys, ratios = (table[c].to_numpy().astype(np.int64) for c in ("e", "ratio"))
    order = np.argsort(keys.view(np.uint64))
    others = weights.where(~near).select("e", "ratio")
    cells = FILTER_BITS // 64
    marks = others.groupBy(F.expr(f"pmod(shiftright(e, 6), {cells})").alias("cell")).agg(F.expr("bit_or(shiftleft(1L, CAST(e & 63 AS INT)))").alias("bits")).toArrow()
    bits = np.zeros(cells, np.uint64)
    bits[marks["cell"].to_numpy().astype(np.int64)] = marks["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return Model(keys.view(np.uint64)[order], ratios[order], bits, others, far, np.zeros(4))


def text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("key"), F.hash(text).alias("more")]


#: Texts that are looked up between two looks at what has gathered.
TEXTS_AT_ONCE = 1024

#: Distinct texts of a chunk, whose expressions travel together: places in it have 16 bits.
CHUNK_TEXTS = 1 << 16

#: Expressions that a chunk gathers before it is handed on.
CHUNK_EXPRESSIONS = 1 << 20

#: Expressions that share a bucket, as far as the counts foretell.
BUCKET_EXPRESSIONS = 1 << 20


def packed(*columns: np.ndarray) -> bytes:
    """Unsigned 64-bit columns of one length, each in as few bytes a number as its largest needs."""
    out = [len(columns[0]).to_bytes(4, "little")]
    for values in columns:
        width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
        planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
        out += [bytes([width]), planes.tobytes()]
    return b"".join(out)


def unpacked(data: bytes) -> list[np.ndarray]:
    """What ``packed`` was given."""
    n, at, out = int.from_bytes(data[:4], "little"), 4, []
    while at < len(data):
        width = data[at]
        values = np.zeros((n, 8), np.uint8)
        values[:, :width] = np.frombuffer(data, np.uint8, n * width, at + 1).reshape(width, n).T
        out.append(values.reshape(-1).view("<u8").astype(np.uint64))
        at += 1 + n * width
    return out


class Chunk:
    """Distinct texts of one task, and those of their expressions that are not at hand."""

    def __init__(self, number: int):
        self.number = number
        self.texts: dict[bytes, tuple[int, int, int]] = {}
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def full(self) -> bool:
        return self.size >= CHUNK_EXPRESSIONS or len(self.texts) + TEXTS_AT_ONCE > CHUNK_TEXTS

    def add(self, slot: int, e: np.ndarray, times: np.ndarray) -> None:
        self.found.append((e, np.full(len(e), slot, np.uint64), times.astype(np.uint64)))
        self.size += len(e)

    def by_bucket(self, bits: int) -> Iterator[tuple[int, bytes]]:
        """(bucket, packed steps from hash to hash, slots, times); a bucket has the hashes with the same first bits."""
        if not self.size:
            return
        e, slots, times = (np.concatenate(x) for x in zip(*self.found, strict=True))
        order = np.argsort(e)
        e, slots, times = e[order], slots[order], times[order]
        bucket = e >> np.uint64(64 - bits)
        edges = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(e)]
        for a, b in zip(edges, edges[1:], strict=False):
            yield int(bucket[a]), packed(np.diff(e[a:b], prepend=np.uint64(0)), slots[a:b], times[a:b])


def summed(data: bytes, keys: np.ndarray, ratios: np.ndarray) -> bytes:
    """Packed (slots, sums of log-ratios) of one bucket of a chunk; sums in two's complement, sign folded into the last bit."""
    steps, slots, times = unpacked(data)
    e = np.cumsum(steps, dtype=np.uint64)
    place = np.minimum(np.searchsorted(keys, e), len(keys) - 1)
    known = keys[place] == e
    held, inverse = np.unique(slots[known], return_inverse=True)
    sums = np.zeros(len(held), np.int64)
    np.add.at(sums, inverse, ratios[place[known]] * times[known].astype(np.int64))
    return packed(held, ((sums << 1) ^ (sums >> 63)).view(np.uint64))


#: Rows on their way to the weights: a weight (``_at`` its hash, ``_amount`` its ratio), a bucket of a chunk, a text
#: (``_amount`` what was at hand).  Of a chunk's rows on their way back, the sums come first.
WEIGHT, PART, TEXT = 0, 1, 2
TRAVEL = "_bucket int, _kind int, _at bigint, _slot int, _amount bigint, _words bigint, _data binary"
TRAVEL_TYPES = {
    "_bucket": pa.int32(), "_kind": pa.int32(), "_at": pa.int64(), "_slot": pa.int32(),
    "_amount": pa.int64(), "_words": pa.int64(), "_data": pa.binary(),
}


def batch_of(schema: pa.Schema, rows: int, **columns) -> pa.RecordBatch:
    """A batch in which all other columns are null."""
    arrays = [
        pa.nulls(rows, f.type) if f.name not in columns else columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
        for f in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def travelling(own: pa.Schema, *, back: bool = False) -> pa.Schema:
    kinds = [(n, t) for n, t in TRAVEL_TYPES.items() if not (back and n == "_bucket")]
    return pa.schema([(f.name, f.type) for f in own if f.name != "text" and f.name not in TRAVEL_TYPES] + kinds)


def runs_of(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """(begin, end) of each run of equal neighbours."""
    edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return ((a, b) for a, b in zip(edges, edges[1:], strict=False) if a < b)


def weighed_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by bucket and kind: each chunk's part becomes its sums, texts pass; one bucket's weights are held at a time."""
    bucket, parts, table = None, [], None
    for batch in batches:
        schema = travelling(batch.schema, back=True)
        buckets, kinds = (batch.column(c).to_numpy() for c in ("_bucket", "_kind"))
        at, data = [], []
        for a, b in runs_of(buckets):
            if buckets[a] != bucket:
                bucket, parts, table = buckets[a], [], None
            weights, some = (int((kinds[a:b] == kind).sum()) for kind in (WEIGHT, PART))
            if weights:
                parts.append(tuple(batch.column(c).slice(a, weights).to_numpy() for c in ("_at", "_amount")))
            if some and table is None:
                keys, ratios = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 2
                keys = keys.view(np.uint64)
                order = np.argsort(keys)
                table = keys[order], ratios[order]
            if some and len(table[0]):
                at.append(batch.column("_at").slice(a + weights, some))
                data += [summed(x, *table) for x in batch.column("_data").slice(a + weights, some).to_pylist()]
        if data:
            yield batch_of(schema, len(data), _kind=np.full(len(data), PART), _at=pa.concat_arrays(at), _data=data)
        yield batch.filter(pa.array(kinds == TEXT)).select(schema.names)


def added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by chunk and kind: each text with its sum; one chunk's sums are held at a time."""
    chunk, sums = None, np.zeros(CHUNK_TEXTS, np.int64)
    for batch in batches:
        chunks, kinds = (batch.column(c).to_numpy() for c in ("_at", "_kind"))
        texts = batch.filter(pa.array(kinds == TEXT))
        total = []
        for a, b in runs_of(chunks):
            if chunks[a] != chunk:
                chunk = chunks[a]
                sums[:] = 0
            some = int((kinds[a:b] == PART).sum())
            for data in batch.column("_data").slice(a, some).to_pylist():
                slots, folded = unpacked(data)
                sums[slots.astype(np.int64)] += (folded >> np.uint64(1)).view(np.int64) ^ -(folded & np.uint64(1)).view(np.int64)
            slots, near = (batch.column(c).slice(a + some, b - a - some).to_numpy() for c in ("_slot", "_amount"))
            total.append(near + sums[slots])
        own = [n for n in texts.schema.names if n not in TRAVEL_TYPES]
        total = np.concatenate(total) if total else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([*map(texts.column, own), pa.array(total), texts.column("_words")], [*own, "total", "words"])


def totals(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (own columns and ``text``) with total and words instead of the text: summed log-ratios and number of words.

    A text sums what is at hand where it is read.  The rest, of it only what the
    filter lets through, meets the table by buckets of hashes: the texts of a task
    go in chunks, one packed row per chunk and bucket, and their sums come back
    the same way.  Equal texts of a chunk are looked up once.  ``rows`` must come
    in the same order when a task is repeated.
    """
    context = rows.sparkSession.sparkContext
    shared = context.broadcast((model.keys, model.ratios, model.bits))  # bounded by Smoothing.at_hand and FILTER_BITS
    bits = max(8 * context.defaultParallelism, int(model.far / BUCKET_EXPRESSIONS), 2).bit_length()
    own = T.StructType([f for f in rows.schema.fields if f.name != "text"])
    names = own.names

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        keys, ratios, marks = shared.value
        first = TaskContext.get().partitionId() << 32
        chunk, schema = Chunk(first), None

        def handed_on() -> Iterator[pa.RecordBatch]:
            parts = list(chunk.by_bucket(bits))
            if parts:
                bucket, data = zip(*parts, strict=True)
                n = len(parts)
                yield batch_of(schema, n, _bucket=bucket, _kind=np.full(n, PART), _at=np.full(n, chunk.number), _data=data)

        def looked_up(text: str) -> tuple[int, int, int]:
            """(slot, sum of what is at hand, number of words)"""
            key = xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))
            if key not in chunk.texts:
                words, pairs = expressions(text, hashes)
                e, times = np.unique(np.concatenate([words, pairs[1:]]), return_counts=True)
                near, known = 0, np.zeros(len(e), bool)
                if len(keys):
                    place = np.minimum(np.searchsorted(keys, e), len(keys) - 1)
                    known = keys[place] == e
                    near = int((ratios[place] * times)[known].sum())
                known |= (marks[(e >> np.uint64(6)) % np.uint64(len(marks))] >> (e & np.uint64(63))) & np.uint64(1) == 0
                slot = len(chunk.texts)
                chunk.add(slot, e[~known], times[~known])
                chunk.texts[key] = slot, near, len(words)
            return chunk.texts[key]

        for batch in batches:
            schema = travelling(batch.schema)
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(at, TEXTS_AT_ONCE)
                if chunk.full():
                    yield from handed_on()
                    chunk = Chunk(chunk.number + 1)
                slot, near, words = zip(*map(looked_up, some.column("text").to_pylist()), strict=True)
                n = some.num_rows
                travel = {"_bucket": np.full(n, chunk.number & ((1 << bits) - 1)), "_kind": np.full(n, TEXT), "_at": np.full(n, chunk.number)}
                yield batch_of(schema, n, _slot=slot, _amount=near, _words=words, **travel, **{c: some.column(c) for c in names})
        yield from handed_on()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own)
    found = rows.mapInArrow(look_up, f"{schema}, {TRAVEL}".lstrip(", "))
    if not model.far:
        return found.select(*names, F.col("_amount").alias("total"), F.col("_words").alias("words"))
    weights = model.others.select(
        F.shiftrightunsigned("e", 64 - bits).cast("int").alias("_bucket"), F.lit(WEIGHT).alias("_kind"), F.col("e").alias("_at"), F.col("ratio").alias("_amount")
    )
    met = found.unionByName(weights, allowMissingColumns=True).repartition("_bucket").sortWithinPartitions("_bucket", "_kind")
    back = TRAVEL.removeprefix("_bucket int, ")
    parts = met.mapInArrow(weighed_parts, f"{schema}, {back}".lstrip(", "))
    parts = parts.repartition("_at").sortWithinPartitions("_at", "_kind")
    return parts.mapInArrow(added_up, f"{schema}, total bigint, words bigint".lstrip(", "))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients with an intercept, by Newton steps with a small ridge."""
    mean = np.average(x, axis=0, weights=weight)
    spread = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=weight)) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / spread]
    b = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        grad = z.T @ (weight * (y - p)) - 1e-2 * b
        b += np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(b)), grad)
    slopes = b[1:] / spread
    return np.concatenate([[b[0] - slopes @ mean], slopes])


def counts_model(rows: DataFrame, how: Smoothing, budget: JoinBudget) -> tuple[Model, dict[tuple[int, bool], int]] | None:
    """The model of ``rows`` (doc_id, text, toxic) without its curve, and the rows per class and part.

    Counts cover all rows but those of the calibration part.  None without rows
    of both classes.
    """
    found = rows.groupBy("toxic", calibrates(how, F.xxhash64("doc_id", "text")).alias("held")).agg(F.count("*").alias("n")).collect()
    sizes = {(r["toxic"], r["held"]): r["n"] for r in found}
    n0, n1 = sizes.get((0, False), 0), sizes.get((1, False), 0)
    if not n0 or not n1:
        return None
    seen = rows.where(~calibrates(how, F.xxhash64("doc_id", "text")))
    tallies = tallied(*[counted(seen, part, COUNT_PARTS) for part in range(COUNT_PARTS)])
    return model_of(weighed(tallies, n0, n1, how, budget), how), sizes


def calibrates(how: Smoothing, pick: Column) -> Column:
    """Whether a labelled row, by its hash, belongs to the part that is not counted."""
    return F.pmod(pick, F.lit(how.calibration)) == 0


def drawn(doc: Column, text: Column, sizes: dict[tuple[int, bool], int], how: Smoothing, calibrate: int) -> Column:
    """``doc`` on rows that the curve is fitted on if they are labelled, null on others.

    At most about ``calibrate`` rows of the calibration part, chosen by hash.
    """
    held = sum(n for (_, part), n in sizes.items() if part)
    chosen = calibrates(how, F.xxhash64(doc, text))
    if held > calibrate:
        chosen &= F.pmod(F.xxhash64(text, doc), F.lit(1_000_000)) < int(1_000_000 * calibrate / held)
    return F.when(chosen, doc)


def curve_of(found: DataFrame, known: DataFrame, sizes: dict[tuple[int, bool], int], budget: JoinBudget) -> np.ndarray:
    """The logistic curve, from the totals of the rows that are ``drawn``."""
    side = sized(classes_of(known), budget=budget)
    seen = found.select(F.col("_doc").alias("doc_id"), "total", "words").where(F.col("doc_id").isNotNull())
    seen = seen.join(F.broadcast(side.rows) if side.small() else side.rows, "doc_id")
    seen = seen.select("total", "words", "toxic").collect()
    seen.sort()  # sums of the fit depend on the order
    y = np.array([r["toxic"] for r in seen], dtype=float)
    if not len(y) or y.min() == y.max():
        return np.array([np.log(sizes[1, False] / sizes[0, False]), 1.0, 0.0, 0.0])
    total, words = (np.array([r[c] for r in seen], dtype=float) for c in ("total", "words"))
    words = np.maximum(words, 1)
    return logistic(np.c_[total / SCALE / words, total / SCALE / np.sqrt(words), np.log(words)], y, np.ones(len(y)))


def judged(
    documents: DataFrame, labels: DataFrame, own: list[Column], how: Smoothing, calibrate: int = 50_000, budget: JoinBudget = JoinBudget()
) -> DataFrame | None:
    """The columns ``own`` of every document, and its score; None without labels of both classes.

    The model is learnt from rows whose crc32(doc_id) mod 3 is not 1.  Every text is
    looked up once: the curve is fitted on the written totals of the same pass.
    """
    known = labels.where(fold(3) != 1)
    learnt = counts_model(labelled(documents, known, budget), how, budget)
    if learnt is None:
        return None
    model, sizes = learnt
    doc, text = F.col("doc_id").cast("bigint"), whole_text()
    rows = documents.select(*own, drawn(doc, text, sizes, how, calibrate).alias("_doc"), text.alias("text"))
    found = settled(totals(rows, model), "totals")
    model = replace(model, curve=curve_of(found, known, sizes, budget))
    return found.withColumn("score", model.score(F.col("total"), F.col("words"))).drop("_doc", "total", "words")


def scored(documents: DataFrame, labels: DataFrame, how: Smoothing = Smoothing()) -> DataFrame:
    """doc_id, held_out, score of every row of ``documents``.

    A missing text counts as empty and gets the score of an empty text; a
    missing or other label is not learnt from; rows that repeat score alike; an
    empty table gives no rows.  Without labels of both classes every score is 0.5.
    """
    own = [F.col("doc_id").cast("bigint").alias("doc_id"), (fold(3) == 1).alias("held_out")]
    found = judged(documents, labels, own, how)
    return documents.select(*own, F.lit(0.5).alias("score")) if found is None else found


def not_toxic(
    documents: DataFrame, labels: DataFrame, limit: float = 0.7, how: Smoothing = Smoothing(), budget: JoinBudget = JoinBudget()
) -> DataFrame:
    """The rows of ``documents`` that score below ``limit``, in their own columns.

    Equal texts stay or go together, ties with ``limit`` go.  An empty table gives
    no rows; without labels of both classes every score is 0.5.
    """
    found = judged(documents, labels, text_key(whole_text()), how, budget=budget)
    if found is None:
        return documents.where(F.lit(0.5) < limit)
    high = found.where(F.col("score") >= limit)
    high = settled(high.select(F.col("key").alias("__key"), F.col("more").alias("__more")).distinct(), "toxic")
    side = sized(high, budget=budget)
    key, more = text_key(whole_text())
    return documents.join(F.broadcast(side.rows) if side.small() else side.rows, (F.col("__key") == key) & (F.col("__more") == more), "left_anti")
