"""Best-fit packing of documents into sequences, by fitted length patterns.

Lengths are counted exactly.  Patterns are the ways to fill a sequence with at
most three of ``UNITS`` bins of lengths.  Non-negative least squares
fits how often to repeat each pattern so that together they use up the
histogram; the counts are rounded, and what is left over is packed best-fit
decreasing, by counts of exact lengths, so that the plan for any number of
documents is made from the histogram alone.  Documents then take the places of
their length by rank.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockside.llm.common import settled, tokenizer_path, whole_text
from dockside.llm.encoding import text_encoder

SEQUENCE = 2048

#: Bins of the fitted patterns; rooms are counted in exact lengths.
UNITS = 256

#: Documents of a bin are numbered in so many shards at least, so that no bin is one task's.
SHARDS = 64

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def piece_bounds(length: int, sequence: int) -> list[int]:
    """Where a document's pieces begin, and its end; only the first piece may be shorter."""
    first = length % sequence or sequence
    return [0, *range(first, length + 1, sequence)]


def cut(documents: DataFrame, tokenizer: str, end_id: int = 0, sequence: int = SEQUENCE) -> DataFrame:
    """One row per piece of each document's ids, which end with ``end_id``."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = text_encoder(tokenizer_path(tokenizer))
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch["doc_id"], encoder.encode(batch["text"].tolist()), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                bounds = piece_bounds(len(ids), sequence)
                for piece, (begin, end) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    rows.append((doc_id, piece, begin, end - begin, zlib.crc32(ids[begin:end].tobytes())))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    given = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return given.mapInPandas(pieces, PIECE_SCHEMA)


def patterns(units: int) -> np.ndarray:
    """Fillings of a sequence by one, two or three bins; zeros fill up the rows."""
    a = np.arange(1, units + 1)
    pairs = np.array([(x, units - x, 0) for x in a if x <= units - x], dtype=int).reshape(-1, 3)
    triples = [(x, y, units - x - y) for x in a for y in range(x, units) if y <= units - x - y]
    return np.concatenate([[(units, 0, 0)], pairs, np.array(triples, dtype=int).reshape(-1, 3)])


def non_negative_fit(matrix: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Least squares with no negative coefficient, by active sets (Lawson and Hanson)."""
    x = np.zeros(matrix.shape[1])
    active: list[int] = []
    scale = max(1.0, float(wanted.max()))
    for _ in range(3 * matrix.shape[0]):
        gain = matrix.T @ (wanted - matrix @ x)
        gain[active] = -1
        best = int(np.argmax(gain))
        if gain[best] <= 1e-9 * scale or len(active) >= matrix.shape[0]:
            break
        active.append(best)
        while active:
            part = matrix[:, active]
            fit = np.linalg.lstsq(part, wanted, rcond=None)[0]
            if (fit > 1e-12).all():
                x[:] = 0
                x[active] = fit
                break
            bad = [(x[k] / (x[k] - f), k) for k, f in zip(active, fit, strict=True) if f <= 1e-12 and x[k] > f]
            step = min([s for s, _ in bad], default=0.0)
            for k, f in zip(active, fit, strict=True):
                x[k] += step * (f - x[k])
            active = [k for k in active if x[k] > 1e-12]
    return x


Filling = tuple[int, ...]


def patterned(left: np.ndarray, units: int) -> list[tuple[Filling, int]]:
    """Fillings by the fitted patterns, in exact lengths; what they use is taken from ``left``."""
    capacity = len(left) - 1
    step = -(-capacity // units)
    bins = capacity // step
    plan = []
    at = -(-np.arange(len(left)) // step)
    counts = np.bincount(at, weights=left, minlength=bins + 1).astype(np.int64)[: bins + 1]
    ways = patterns(bins)[1:]
    ways = ways[[all(counts[u] > 0 for u in set(w) - {0}) for w in ways.tolist()]]
    if not len(ways):
        return plan
    matrix = np.zeros((bins + 1, len(ways)))
    for slot in range(3):
        np.add.at(matrix, (ways[:, slot], np.arange(len(ways))), 1)
    matrix[0] = 0
    repeats = non_negative_fit(matrix, counts.astype(float))
    for k in np.argsort(-repeats, kind="stable"):
        way = sorted((int(u) for u in ways[k] if u), reverse=True)
        times = round(float(repeats[k]))
        while times > 0:
            filling = exact_filling(left, [u * step for u in way], step)
            used = min([times, *(int(left[u]) // filling.count(u) for u in filling)])
            if not filling or not used:  # nothing is left for a bin, or one document for a bin that comes twice
                break
            plan.append((filling, used))
            for u in filling:
                left[u] -= used
            times -= used
    return plan


def exact_filling(left: np.ndarray, most: list[int], slack: int) -> Filling:
    """Lengths for the bins of a pattern, the longest that are left up to each; empty where a bin has none.

    Lengths fall short of their bins, so the last one may be as long as the room
    that the others really leave.  A filling that would leave more than ``slack``
    is not begun: best fit finds better ones.
    """
    filling: list[int] = []
    for at, limit in enumerate(most):
        room = len(left) - 1 - sum(filling)
        limit = room if at == len(most) - 1 else limit
        fitting = np.flatnonzero(left[: limit + 1])
        if not len(fitting) or not fitting[-1]:
            return ()
        filling.append(int(fitting[-1]))
    return tuple(filling) if len(left) - 1 - sum(filling) <= slack else ()


def best_fit(left: np.ndarray, begun: list[tuple[Filling, int]]) -> list[tuple[Filling, int]]:
    """``begun`` and the documents in ``left``: longest first, into the least room that is enough."""
    capacity = len(left) - 1
    left = left.copy()
    spaces: dict[int, list[tuple[Filling, int]]] = {}
    for filling, times in begun:
        spaces.setdefault(capacity - sum(filling), []).append((filling, times))
    for u in range(capacity, 0, -1):
        while left[u] > 0:
            room = min((r for r in spaces if r >= u and spaces[r]), default=None)
            if room is None:
                room, per = capacity, capacity // u
                full, rest = divmod(int(left[u]), per)
                opened = [((u,) * per, full), ((u,) * rest, 1 if rest else 0)]
            else:
                filling, times = spaces[room].pop()
                per = min(room // u, max(1, int(left[u]) // times))
                used = min(times, int(left[u]) // per)
                if used < times:
                    spaces[room].append((filling, times - used))
                opened = [(filling + (u,) * per, used)]
            for filling, times in opened:
                if times:
                    left[u] -= times * filling.count(u)
                    spaces.setdefault(capacity - sum(filling), []).append((filling, times))
    return [one for open_ in spaces.values() for one in open_]


def plan_of(histogram: np.ndarray, units: int = UNITS) -> list[tuple[Filling, int]]:
    """How often to use which filling, so that every document has a place.

    ``histogram[u]`` documents have length ``u``, up to a whole sequence.  Only
    the fitted patterns see lengths in ``units`` bins; capacities are exact.
    What the patterns leave is packed best-fit, into their fillings' rooms first.
    """
    left = histogram.astype(np.int64)
    begun = patterned(left, units)
    return best_fit(left, begun)


def slots_of(plan: list[tuple[Filling, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Per run of equal lengths in a filling: length, first rank, number of ranks, repeats, first sequence, place."""
    taken: dict[int, int] = {}
    slots, sequence = [], 0
    for filling, times in plan:
        place = 0
        for u, run in Counter(filling).items():
            slots.append((u, taken.get(u, 0), run * times, times, sequence, place))
            taken[u] = taken.get(u, 0) + run * times
            place += run
        sequence += times
    return slots


def packed(pieces: DataFrame, sequence: int = SEQUENCE, units: int = UNITS, shards: int = SHARDS) -> DataFrame:
    """``pieces`` (at least doc_id, piece, start, length) with sequence_id and offset.

    Every piece, of at most ``sequence`` tokens, gets a place; those of one
    sequence lie in it without gaps from 0.  Ranks come from counts per bin and
    shard, so a bin with a third of all pieces is numbered by many tasks; a
    shard grows with the number of shuffle partitions, not with the input.
    """
    spark = pieces.sparkSession
    parts = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [c for c in pieces.columns]
    placed = settled(
        pieces.withColumn("_bin", F.col("length").cast("int")).withColumn(
            # By a number of the row: rows that repeat, or have no id, are spread like others.
            "_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int")
        ),
        "pieces",
    )
    counts = placed.groupBy("_bin", "_shard").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_bin").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = settled(counts.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))), "firsts")
    histogram = np.zeros(sequence + 1, dtype=np.int64)
    for row in firsts.groupBy("_bin").agg(F.sum("_n").alias("n")).collect():
        histogram[row["_bin"]] = row["n"]
    slots = spark.createDataFrame(
        slots_of(plan_of(histogram, units)), "_bin int, _from long, _ranks long, _times long, _sequence long, _place int"
    )
    within = Window.partitionBy("_bin", "_shard").orderBy(*order)
    ranked = (
        placed.withColumn("_row", F.row_number().over(within) - 1)
        .join(firsts.select("_bin", "_shard", "_first"), ["_bin", "_shard"])
        .withColumn("_rank", F.col("_first") + F.col("_row"))
        .drop("_first", "_row", "_shard")
    )
    # The slots are bounded by the lengths and their fillings, not by the documents.
    s = F.broadcast(slots).alias("s")
    fits = (F.col("r._bin") == F.col("s._bin")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_from") + F.col("_ranks"))
    seated = ranked.alias("r").join(s, fits).select(
        *[F.col(f"r.{c}") for c in order],
        (F.col("_sequence") + (F.col("_rank") - F.col("_from")) % F.col("_times")).alias("sequence_id"),
        (F.col("_place") + F.expr("(_rank - _from) div _times")).alias("_place"),
    )
    ahead = Window.partitionBy("sequence_id").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    return seated.select(
        *order, "sequence_id", F.coalesce(F.sum("length").over(ahead), F.lit(0)).cast("bigint").alias("offset")
    )


def pack_documents(documents: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """All documents' pieces with their places.

    A missing text counts as empty and is one piece with the end id; rows that
    repeat are packed as often as they occur; an empty table gives no rows.
    """
    return packed(cut(documents, tokenizer, sequence=sequence), sequence)
