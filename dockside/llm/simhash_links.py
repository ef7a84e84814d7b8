"""Near-duplicate groups by SimHash fingerprints and multi-index hashing.

A fingerprint has 64 bits; bit i is set where it is set in over half of the
hashes of a text's 3-word shingles.  Two fingerprints link at three or fewer
differing bits.  They are cut into two segments of 32 bits: linked ones differ
in at most one bit of either segment.  Each distinct fingerprint is therefore
stored under its segments, and looks itself up under the Hamming ball of radius
one around each.  Of the ball only the values with a bit less are enumerated:
of two segments that differ in one bit, exactly one has that bit set.  What a
lookup fetches is verified on the complete distance.

A segment value that many fingerprints share would fetch all pairs of them.  Its
members meet at midpoints of the other segment instead: two values that differ in
at most three bits have one within two bits of the one (two of its set bits
cleared) and within one bit of the other.  All that meet at a midpoint which
somebody reaches within one bit are linked to that one: one row per member, and
all of these links are within three bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockside.llm.common import attached, settled, whole_text
from dockside.llm.near_copies import components

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 3
SEGMENT_BITS = 32

#: Holders of one segment value that are compared directly; beyond it they meet at midpoints.
DIRECT = 32

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Shingles whose bits are counted at once.
AT_ONCE = 1 << 16


def shingle_hashes(text: str) -> np.ndarray:
    """XXH64 of each 3-word shingle, repeats included; of the whole sequence where there are fewer words."""
    # Without arguments bytes split at \x20 and \x09-\x0D.
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    width = min(SHINGLE_WORDS, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Majority per bit, as a signed 64-bit integer; 0 without hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), AT_ONCE):
        some = hashes[at : at + AT_ONCE]
        bits = np.unpackbits(some.astype("<u8").view(np.uint8), bitorder="little").view(np.uint64).reshape(len(some), 8)
        # Eight counters a word: 255 rows do not overflow one.
        sums = np.add.reduceat(bits, np.arange(0, len(some), 255), axis=0)
        ones += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little").view("<i8")[0])


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, fp) per row of ``documents``; a missing text counts as empty."""

    def marks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = [fingerprint(shingle_hashes(text)) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "fp": pd.Series(fp, dtype="int64")})

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInPandas(marks, "doc_id bigint, fp bigint")


def one(at: Column) -> Column:
    """The number with this bit only."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at)


def bits_of(segment: Column) -> Column:
    """The numbers of the bits that are set."""
    return F.filter(F.sequence(F.lit(0), F.lit(SEGMENT_BITS - 1)), lambda b: segment.bitwiseAND(one(b)) != 0)


def segments(marks: DataFrame) -> DataFrame:
    """(fp, place, segment, other): each fingerprint twice, by either segment."""
    low = F.col("fp").bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))
    high = F.shiftrightunsigned("fp", SEGMENT_BITS)
    both = F.array(
        F.struct(F.lit(0).cast("bigint").alias("place"), low.alias("segment"), high.alias("other")),
        F.struct(F.lit(1).cast("bigint").alias("place"), high.alias("segment"), low.alias("other")),
    )
    return marks.select("fp", F.explode(both).alias("s")).select("fp", "s.*")


def address(place: Column, segment: Column) -> Column:
    return segment + F.shiftleft(place, SEGMENT_BITS)


def stored(parts: DataFrame) -> DataFrame:
    """(address, fp, other, probe): each fingerprint under its own segments."""
    return parts.select(address(F.col("place"), F.col("segment")).alias("address"), "fp", "other", F.lit(False).alias("probe"))


def looked_up(parts: DataFrame) -> DataFrame:
    """(address, fp, other, probe): each fingerprint under its segments with one set bit less."""
    less = F.transform(bits_of(F.col("segment")), lambda b: F.col("segment") - one(b))
    rows = parts.select("fp", "place", "other", F.explode(less).alias("segment"))
    return rows.select(address(F.col("place"), F.col("segment")).alias("address"), "fp", "other", F.lit(True).alias("probe"))


def distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def fetched(table: DataFrame, lookups: DataFrame) -> DataFrame:
    """Links (a, b) by lookup in ``table``, whose addresses hold at most DIRECT fingerprints each."""
    asked = table.unionByName(lookups).select("address", F.col("fp").alias("b"), "probe")
    found = table.select("address", F.col("fp").alias("a")).join(asked, "address")
    linked = (F.col("probe") | (F.col("a") < F.col("b"))) & (distance("a", "b") <= RADIUS)
    return found.where(linked).select("a", "b")


def met(table: DataFrame, lookups: DataFrame) -> DataFrame:
    """Links (a, b) among what shares an address, through midpoints of the other segment.

    Holders of an address agree in the segment and may differ in three bits of
    the other; a lookup differs in one bit of the segment already and may differ
    in two more.  So few distinct fingerprints are near a midpoint (some 1,500) that
    a group stays small however many share the address.
    """
    other = F.col("other")
    near = F.concat(F.array(other), F.transform(F.sequence(F.lit(0), F.lit(SEGMENT_BITS - 1)), lambda b: other.bitwiseXOR(one(b))))
    set_bits = bits_of(other)
    less = F.flatten(
        F.transform(set_bits, lambda x: F.transform(F.filter(set_bits, lambda y: y < x), lambda y: other - one(x) - one(y)))
    )
    within_one = table.unionByName(lookups).select("address", "fp", (~F.col("probe")).alias("head"), F.explode(near).alias("middle"))
    within_two = table.select("address", "fp", F.lit(False).alias("head"), F.explode(less).alias("middle"))
    groups = (
        within_one.unionByName(within_two)
        .groupBy("address", "middle")
        .agg(F.min(F.when(F.col("head"), F.col("fp"))).alias("a"), F.collect_set("fp").alias("members"))
        .where(F.col("a").isNotNull() & (F.size("members") > 1))
    )
    links = groups.select("a", F.explode("members").alias("b"))
    return links.where((F.col("a") != F.col("b")) & (distance("a", "b") <= RADIUS)).distinct()


def linked_fingerprints(marks: DataFrame, direct: int = DIRECT) -> DataFrame:
    """Links (a, b) that join the distinct fingerprints ``fp`` of ``marks`` as all pairs within three bits would."""
    parts = segments(marks)
    table, lookups = stored(parts), looked_up(parts)
    often = table.groupBy("address").count().where(F.col("count") > direct).select("address")
    often = settled(often, "often")
    few = fetched(table.join(often, "address", "left_anti"), lookups)
    if often.isEmpty():
        return few
    return few.unionByName(met(table.join(often, "address", "left_semi"), lookups.join(often, "address", "left_semi")))


def simhash_groups(documents: DataFrame, direct: int = DIRECT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of ``documents``.

    component_id is the least doc_id that links reach, the row's own included.
    A text without words, or a missing one, has fingerprint zero and is linked
    like any other.  Very long texts are hashed whole, their bits counted in
    blocks.  Rows that repeat, or share a doc_id, count one by one; a row without
    a doc_id takes part with its text and gets the least id of its group, null if
    there is none.  Other columns are not looked at; an empty table gives no rows.
    """
    rows = settled(fingerprints(documents), "fingerprints")
    classes = settled(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("copies")), "classes")
    links = settled(linked_fingerprints(classes.select("fp"), direct), "links")
    roots = components(links).withColumnRenamed("node", "fp")
    named = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    table = settled(named.join(least, "root").select("fp", "component_id", "copies"), "named")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return attached(rows, table, "fp", "copies").select("doc_id", shown, "component_id")
