"""Near-duplicate groups by MinHash signatures and an inverted join of their coordinates.

A document is the set of its word shingles; documents with equal sets form one
class, and only classes are compared.  A class posts itself under its signature's
(coordinate, value) pairs.  Two signatures with at least ``matches`` equal
coordinates share a pair among the rarest ones of each (the prefix), so only
those are posted; pairs that no other class holds match nothing and are skipped,
and so is a class with fewer shared pairs than the threshold.

A posting list first links its members to one of them, in one row per member.
Where confirmed links already join a whole list, it is skipped; otherwise
members of different components are paired where they share one of their rarest
shingles, which all alike sets do, and the places of that shingle in both orders
and the parities of both sets leave room for enough common ones.  Every link is confirmed on the full sets.  At 0.8 similarity a pair stays below the threshold (19 of 40) with a
probability of one in a million.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockside.llm.common import BLANK_CLASS, settled, whole_text
from dockside.llm.hashing import STEP, WordHashes, mixed, windows

WORD = re.compile("[^" + BLANK_CLASS[1:-1] + "]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Likeness:
    """What counts as a near copy, and how it is searched."""

    words: int = 5
    percent: int = 80
    coordinates: int = 40
    matches: int = 19


class Shingler:
    """Sets of hashed shingles."""

    def __init__(self, words: int):
        self.words = words
        self.hashes = WordHashes()

    def shingles(self, text: str) -> np.ndarray:
        """Distinct shingles as sorted 64-bit hashes; a shorter text is one shingle."""
        words = WORD.findall(text.lower() if text.isascii() else text.translate(LOWER))
        if not words:
            return np.zeros(0, np.uint64)
        return np.unique(windows(self.hashes.array(words), min(self.words, len(words))))


#: Length of a set's marks in 64-bit integers.
MARK_LONGS = 8


def parity_marks(shingles: np.ndarray) -> np.ndarray:
    """One bit per slot of hashes: whether an odd number of shingles falls into it.

    Each bit in which two sets differ stands for a shingle that only one of them
    holds, so the number of such bits bounds their common shingles from above.
    """
    slots = MARK_LONGS * 64
    counts = np.bincount((mixed(shingles) % np.uint64(slots)).astype(np.int64), minlength=slots)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Per coordinate the least value of its hash over the set.

    The shingles are scattered already, so multiplying by an odd number of the
    coordinate's own gives an order of its own.
    """
    factors = mixed(np.arange(1, coordinates + 1, dtype=np.uint64) * STEP) | np.uint64(1)
    return np.array([(shingles * factor).min() for factor in factors], dtype=np.uint64)


def signed(documents: DataFrame, how: Likeness) -> DataFrame:
    """(row key, doc_id, n_shingles, class, signature) per row."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(how.words)
        for batch in batches:
            sets = [shingler.shingles(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "row_key": batch["row_key"],
                    "doc_id": batch["doc_id"],
                    "n_shingles": [len(s) for s in sets],
                    "cls": [set_digest(s) if len(s) else None for s in sets],
                    "sig": [signature(s, how.coordinates).view(np.int64) if len(s) else None for s in sets],
                }
            ).astype({"doc_id": "Int64"})

    schema = "row_key bigint, doc_id bigint, n_shingles bigint, cls binary, sig array<bigint>"
    return keyed(documents).mapInPandas(sign, schema)


def keyed(documents: DataFrame) -> DataFrame:
    text = whole_text()
    return documents.select(
        F.xxhash64("doc_id", text).alias("row_key"), F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")
    )


def shared_coordinates(classes: DataFrame, how: Likeness) -> DataFrame:
    """(post, id, n_shingles): each class under the prefix of its shared coordinates."""
    every = classes.select("id", F.col("n_shingles").cast("int").alias("n_shingles"), F.posexplode("sig").alias("at", "value"))
    every = every.select("id", "n_shingles", F.xxhash64("at", "value").alias("post"))
    often = every.groupBy("post").agg(F.count("*").alias("holders")).where(F.col("holders") > 1)
    shared = every.join(often, "post")
    ordered = shared.groupBy("id", "n_shingles").agg(
        F.array_sort(F.collect_list(F.struct("holders", "post"))).alias("posts")  # one per coordinate at most
    )
    prefix = F.slice("posts", 1, F.size("posts") - how.matches + 1)
    return (
        ordered.where(F.size("posts") >= how.matches)
        .select("id", "n_shingles", F.explode(prefix).alias("p"))
        .select("p.post", "id", "n_shingles")
    )


def alike(pairs: DataFrame, signatures: DataFrame, sets: DataFrame, how: Likeness) -> DataFrame:
    """The distinct ``pairs`` (a, b) that enough coordinates and then the full sets confirm."""
    equal = F.size(F.filter(F.arrays_zip("sig_a", "sig_b"), lambda s: s["sig_a"] == s["sig_b"]))
    likely = (
        pairs.join(signatures.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
        .join(signatures.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b")
        .where(equal >= how.matches)
        .select("a", "b")
    )
    both = likely.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b"
    )
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return both.where(100 * common >= how.percent * union).select("a", "b")


def rare_shingles(members: DataFrame, sets: DataFrame, how: Likeness) -> DataFrame:
    """(shingle, place, id, root, n_shingles, marks): each member under the rarest shingles of its set.

    ``place`` counts from 1 in the order of rarity.  Two sets that are alike share
    one among the rarest ``n - least common + 1`` of each, whatever the order, so
    pairs by these lose no link.  A passage that many texts share is not among
    them unless it is nearly all of a text.
    """
    each = members.join(sets.select("id", "shingles"), "id").select("id", "root", "n_shingles", F.explode("shingles").alias("shingle"))
    each = settled(each, "shingles")
    often = each.groupBy("shingle").agg(F.count("*").alias("holders")).where(F.col("holders") > 1)
    shared = each.join(often, "shingle")
    # Shingles of one member only come first; they need no list.
    ordered = shared.groupBy("id", "root", "n_shingles").agg(
        F.array_sort(F.collect_list(F.struct("holders", "shingle"))).alias("all")
    )
    alone = F.col("n_shingles") - F.size("all")
    length = F.col("n_shingles") - F.ceil(F.col("n_shingles") * how.percent / 100) + 1 - alone
    chosen = ordered.select("id", "root", "n_shingles", "all", alone.alias("alone"), length.cast("int").alias("length"))
    chosen = chosen.where(F.col("length") > 0)
    listed = chosen.join(sets.select("id", "marks"), "id").select(
        "id", "root", "n_shingles", "marks", "alone", F.posexplode(F.slice("all", F.lit(1), F.col("length"))).alias("at", "s")
    )
    return listed.select(
        F.col("s.shingle").alias("shingle"),
        (F.col("alone") + F.col("at") + 1).alias("place"),
        "id",
        "root",
        "n_shingles",
        "marks",
    )


def crossing_pairs(rare: DataFrame, how: Likeness) -> DataFrame:
    """The distinct pairs (a, b) of different roots that may be alike, from ``rare_shingles``.

    Sets of n and m shingles are alike from ``percent * (n + m) / (100 + percent)``
    common ones on.  All of them stand at or behind the first one in both orders,
    so its places bound their number.  That also shortens the smaller set's list.
    So do the bits in which their marks differ: no pair that is alike is left out.
    """
    total = 100 + how.percent
    kept = ("place", "id", "root", "n_shingles", "marks")
    larger = rare.select("shingle", *[F.col(c).alias(f"{c}_x") for c in kept])
    smaller = rare.select("shingle", *[F.col(c).alias(f"{c}_y") for c in kept])
    smaller = smaller.where(total * (F.col("n_shingles_y") - F.col("place_y") + 1) >= 2 * how.percent * F.col("n_shingles_y"))
    n, m = F.col("n_shingles_x"), F.col("n_shingles_y")
    ordered = (m < n) | ((m == n) & (F.col("id_y") < F.col("id_x")))
    behind = F.least(n - F.col("place_x"), m - F.col("place_y")) + 1
    differ = sum((F.bit_count(F.col("marks_x")[i].bitwiseXOR(F.col("marks_y")[i])) for i in range(MARK_LONGS)), F.lit(0))
    near = (100 * m >= how.percent * n) & (total * behind >= how.percent * (n + m))
    near = near & (total * (n + m - differ) >= 2 * how.percent * (n + m))
    found = larger.join(smaller, "shingle").where((F.col("root_x") != F.col("root_y")) & ordered & near)
    return found.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()


def full_sets(documents: DataFrame, wanted: DataFrame, how: Likeness) -> DataFrame:
    """(id, shingles, marks) of the classes in ``wanted`` (id), from one text each."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(how.words)
        for batch in batches:
            found = [shingler.shingles(text) for text in batch["text"]]
            marks = [parity_marks(s) for s in found]
            yield pd.DataFrame({"id": batch["id"], "shingles": [s.view(np.int64) for s in found], "marks": marks})

    texts = keyed(documents).withColumnRenamed("row_key", "id").join(wanted, "id", "left_semi")
    one = texts.groupBy("id").agg(F.first("text").alias("text"))
    return settled(one.mapInPandas(sets, "id bigint, shingles array<bigint>, marks array<bigint>"), "sets")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): root is the component's least node.

    Each round gives a node the least root among its neighbours and itself, and
    then the root of that root.  Rounds are written out, so lost executors cost
    one round at most.
    """
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = settled(links.unionByName(turned).distinct(), "links")
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    roots = settled(least.select(F.col("a").alias("node"), F.least("a", "least").alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), F.col("root").alias("theirs")), "b")
        best = near.groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("theirs"))
        closer = roots.join(best, "node").select("node", "root", F.least("root", "theirs").alias("new"))
        jump = roots.select(F.col("node").alias("new"), F.col("root").alias("further"))
        # A root is a node, so it has a row of its own.
        next_roots = settled(
            closer.join(jump, "new").select("node", F.least("new", "further").alias("root"), F.col("root").alias("was")), "roots"
        )
        settled_down = next_roots.where(F.col("root") != F.col("was")).isEmpty()
        roots = next_roots.select("node", "root")
        if settled_down:
            return roots


def grouped_classes(documents: DataFrame, how: Likeness) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and (cls, component_id, stays) of their classes, both written.

    ``stays`` is the row key that one_of_each_group leaves of the component: the
    one with the least doc_id, rows without one last, then the least key.
    """
    rows = settled(signed(documents, how), "signed")
    classes = settled(
        rows.where(F.col("cls").isNotNull())
        .groupBy("cls")
        .agg(
            F.min("row_key").alias("id"),
            F.min("doc_id").alias("least_id"),
            F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")).alias("first"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sig").alias("sig"),
        ),
        "classes",
    )
    posts = settled(shared_coordinates(classes, how), "posts")
    # Lists link their members to one member first: a row each, whatever their length.
    heads = posts.groupBy("post").agg(F.min_by("id", F.xxhash64("id", "post")).alias("head"), F.count("*").alias("members"))
    heads = settled(heads.where(F.col("members") > 1), "heads")
    stars = posts.join(heads, "post").where(F.col("id") != F.col("head"))
    tried = settled(stars.select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).distinct(), "tried")
    involved = posts.join(heads, "post", "left_semi").select("id").distinct()
    signatures = settled(classes.join(involved, "id", "left_semi").select("id", "sig"), "signatures")
    sets = full_sets(documents, signatures.select("id"), how)
    links = settled(alike(tried, signatures, sets, how), "stars")
    grouped = components(links)
    # What is left: members of one list in different components.
    member = (
        posts.join(heads.select("post"), "post")
        .join(grouped.withColumnRenamed("node", "id"), "id", "left")
        .withColumn("root", F.coalesce("root", "id"))
    )
    split_lists = member.groupBy("post").agg(F.min("root").alias("one"), F.max("root").alias("other"))
    split_lists = split_lists.where(F.col("one") != F.col("other")).select("post")
    open_ = settled(member.join(split_lists, "post").select("id", "root", "n_shingles").distinct(), "open")
    rare = rare_shingles(open_, sets, how)
    crossing = settled(crossing_pairs(rare, how).join(tried, ["a", "b"], "left_anti"), "crossing")
    more = settled(alike(crossing, signatures, sets, how), "more")
    if not more.isEmpty():
        grouped = components(links.unionByName(more))
    ids = classes.select("cls", "id", "least_id", "first").join(grouped.withColumnRenamed("node", "id"), "id", "left")
    ids = ids.withColumn("root", F.coalesce("root", "id"))
    least = ids.groupBy("root").agg(F.min("least_id").alias("component_id"), F.min("first")["row_key"].alias("stays"))
    return rows, settled(ids.join(least, "root").select("cls", "component_id", "stays"), "named")


def near_copy_groups(documents: DataFrame, how: Likeness = Likeness()) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``documents``.

    component_id is the least doc_id that links reach, the row's own included.
    A text without words, or a missing one, has an empty set and is linked with
    nothing.  Rows that share a doc_id count one by one; a row without one takes
    part with its text and gets the least id of its group, if there is any.  An
    empty table gives no rows.
    """
    rows, named = grouped_classes(documents, how)
    return (
        rows.select("doc_id", "n_shingles", "cls")
        .join(named.drop("stays"), "cls", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", F.when(F.col("cls").isNull(), F.col("doc_id"))).alias("component_id"))
    )


#: Name of a column that only lives inside ``one_of_each_group``.
ROW_OF_GROUP = "__near_copies_row_of_group"


def one_of_each_group(documents: DataFrame, how: Likeness = Likeness()) -> DataFrame:
    """One row of ``documents`` for each group of near copies, in its own columns.

    The row with the least doc_id stays, rows without one last; what a group is
    depends on texts only, so rows that share a doc_id but not their text are kept
    or dropped each with its own group, and of repeated rows one stays.  Texts
    without words, or missing ones, are in no group and all stay.  Very long texts
    are compared whole; columns of any name come through; an empty table stays empty.
    """
    has_words = whole_text().rlike("[^" + BLANK_CLASS[1:-1] + "]")
    _, named = grouped_classes(documents, how)
    stays = named.select(F.col("stays").alias(ROW_OF_GROUP)).distinct()
    keyed_rows = documents.where(has_words).withColumn(ROW_OF_GROUP, F.xxhash64(F.col("doc_id"), whole_text()))
    chosen = keyed_rows.join(stays, ROW_OF_GROUP, "left_semi")
    numbered = Window.partitionBy(ROW_OF_GROUP).orderBy(F.lit(0))
    place = ROW_OF_GROUP + "_place"
    one = chosen.withColumn(place, F.row_number().over(numbered)).where(F.col(place) == 1)
    return one.select(*[F.col(f"`{c}`") for c in documents.columns]).unionByName(documents.where(~has_words))
