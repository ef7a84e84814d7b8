"""Exact top-k search by inner product, a block of vectors at a time.

Vectors are cut into document-range blocks, each with the least and greatest
value of every dimension (a term).  A query's bound for a block is the sum of
the larger products; a task visits its blocks in descending order of the bounds
and scores them through their forward index (the matrix of the block) until no
bound reaches the k-th score of any query.  Where no sum can reach 2^53, floating
point products are exact and fast; beyond that integers are multiplied.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockside.llm.common import settled

BLOCK = 256
QUERIES_A_GROUP = 512
RANGES = 24


def scaled(vector: str, factor: int = 1024) -> Column:
    """floor(factor * x) of each component, computed in double precision; an error where no bigint holds it."""
    large = F.raise_error(F.lit("a component is too large for an integer")).cast("bigint")

    def whole(x: Column) -> Column:
        product = x.cast("double") * factor
        return F.when(F.abs(product) < float(1 << 63), F.floor(product).cast("bigint")).otherwise(large)

    return F.transform(F.col(vector), whole)


#: Stands for no score; also below it no score of a vector can be told apart.
NO_SCORE = -(1 << 63) + 1


def reach(rows: np.ndarray, queries: np.ndarray) -> int:
    """No sum of products, nor a part of one, is larger than this in size."""
    most = [max(abs(int(m.max())), abs(int(m.min()))) for m in (rows, queries)]
    return most[0] * most[1] * rows.shape[1]


def inner_products(queries: np.ndarray, rows: np.ndarray, largest: int) -> np.ndarray:
    """Exact, as int64; an error where a score is beyond that."""
    if largest < 1 << 53:
        return (queries.astype(float) @ rows.T.astype(float)).astype(np.int64)
    if largest < 1 << 63:
        return queries @ rows.T
    exact = queries.astype(object) @ rows.T.astype(object)
    if max(abs(x) for x in exact.ravel()) > -NO_SCORE - 1:
        raise ArithmeticError("a score is too large for a bigint")
    return exact.astype(np.int64)


def whole_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """Rows with an id and a vector of finite components."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & finite)


def best_of_blocks(ids: np.ndarray, matrix: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple:
    """Top k of the rows for each query, as (query row, vec_id, score) arrays."""
    order = np.argsort(ids, kind="stable")
    ids, matrix = ids[order], matrix[order]
    # Blocks of like vectors have tight bounds: order by the strongest dimension, then by its value.
    peak = np.abs(matrix).argmax(axis=1)
    near = np.lexsort((matrix[np.arange(len(matrix)), peak], peak))
    blocks = [near[at : at + BLOCK] for at in range(0, len(near), BLOCK)]
    low = np.stack([matrix[b].min(axis=0) for b in blocks])
    high = np.stack([matrix[b].max(axis=0) for b in blocks])
    largest = reach(matrix, queries)
    signed = queries.astype(float)
    bounds = np.maximum(signed, 0) @ high.T.astype(float) + np.minimum(signed, 0) @ low.T.astype(float)
    if largest >= 1 << 53:  # sums of rounded products may fall short of the true ones
        bounds += largest * 2.0**-40
    scores = np.full((len(queries), k), NO_SCORE)
    found = np.full((len(queries), k), np.iinfo(np.int64).max)
    for b in np.argsort(-bounds.max(axis=0), kind="stable"):
        # A tie with the k-th score may still win by its smaller id.
        wanted = np.flatnonzero(bounds[:, b] >= scores[:, -1])
        if not len(wanted):
            continue
        members = blocks[b]
        new = inner_products(queries[wanted], matrix[members], largest)
        new[query_ids[wanted][:, None] == ids[members][None, :]] = NO_SCORE
        all_scores = np.concatenate([scores[wanted], new], axis=1)
        all_ids = np.concatenate([found[wanted], np.broadcast_to(ids[members], new.shape)], axis=1)
        all_ids = np.where(all_scores == NO_SCORE, np.iinfo(np.int64).max, all_ids)
        best = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
        scores[wanted] = np.take_along_axis(all_scores, best, axis=1)
        found[wanted] = np.take_along_axis(all_ids, best, axis=1)
    rows, places = np.nonzero(scores > NO_SCORE)
    return rows, found[rows, places], scores[rows, places]


def exact_top_k(vectors: DataFrame, queries: DataFrame, vector: str = "embedding", k: int = 10) -> DataFrame:
    """The k highest inner products of each query: query_id, rank, vec_id, score.

    A query never meets rows of its own id; ties go to the smaller vec_id.
    Vectors that are missing or hold missing or non-finite components, or that
    have another length than the query, take no part.  Ids that repeat are
    searched as one row each.  Queries are dealt in groups and vectors in ranges
    of ids; each pair of a group and a range is one unit of work, and a unit
    returns at most k rows per query.
    """
    spark = vectors.sparkSession
    whole = settled(
        whole_vectors(vectors, vector).select(F.col("vec_id").cast("bigint").alias("vec_id"), scaled(vector).alias("v")),
        "vectors",
    )
    asked = whole_vectors(queries, vector).select(F.col("vec_id").cast("bigint").alias("query_id"), scaled(vector).alias("q"))
    asked = asked.dropDuplicates(["query_id", "q"])
    size = whole.count()
    groups = max(1, -(-asked.count() // QUERIES_A_GROUP))
    ranges = max(RANGES, -(-size // (BLOCK * 64)))
    spread = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n)).cast("int")
    # Each query group meets each range once; what a unit holds stays bounded as both grow.
    left = asked.select(
        F.col("query_id").alias("id"), F.col("q").alias("v"), F.lit(True).alias("asks"),
        spread("query_id", groups).alias("grp"), F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias("rng"),
    )
    # By a number of the row: vectors and ids that a third of the rows share are spread out.
    right = whole.withColumn("row", F.monotonically_increasing_id()).select(
        F.col("vec_id").alias("id"), "v", F.lit(False).alias("asks"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), F.pmod(F.xxhash64("row"), F.lit(ranges)).cast("int").alias("rng"),
    )

    def search(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        widths = part["v"].map(len)
        for width in widths[part["asks"]].unique():
            same = part[widths == width]
            asks, rows = same[same["asks"]], same[~same["asks"]]
            if not len(rows) or not width:
                continue
            q_ids = asks["id"].to_numpy(np.int64)
            pick, ids, scores = best_of_blocks(
                rows["id"].to_numpy(np.int64), np.stack(rows["v"].to_list()),
                q_ids, np.stack(asks["v"].to_list()), k,
            )
            out.append(pd.DataFrame({"query_id": q_ids[pick], "vec_id": ids, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    units = left.unionByName(right).groupBy("grp", "rng")
    found = units.applyInPandas(search, "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
