"""Update-or-insert of one DataFrame into another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockside.operators.latest import latest_per_key


def upsert(target: DataFrame, source: DataFrame, key: str, small_source: bool = False) -> DataFrame:
    """``target`` with every row of ``source`` put in its place or added.

    Both sides hold at most one row per non-NULL key.  A NULL key matches
    nothing: such rows stay on both sides.
    """
    columns = target.columns
    incoming = source.select(*columns)
    if small_source:
        # The target is filtered where it is read, without a shuffle.
        keys = F.broadcast(incoming.select(key))
        return target.join(keys, key, "left_anti").select(*columns).unionByName(incoming)
    # NULL keys would all hash to one task; the spread column scatters them.  A
    # literal on one side would be folded away and not take part in the hash.
    spread = F.when(F.col(key).isNull(), F.xxhash64(*columns)).otherwise(F.lit(0).cast("bigint"))
    old = target.withColumn("_spread", spread).alias("old")
    new = incoming.withColumn("_spread", spread).withColumn("_present", F.lit(True)).alias("new")
    same = (F.col(f"old.{key}") == F.col(f"new.{key}")) & (F.col("old._spread") == F.col("new._spread"))
    present = F.col("new._present").isNotNull()
    return old.join(new, same, "full_outer").select(
        *[F.when(present, F.col(f"new.`{c}`")).otherwise(F.col(f"old.`{c}`")).alias(c) for c in columns]
    )


def upsert_newest(target: DataFrame, batches: DataFrame, key: str, newest_first: tuple[str, ...]) -> DataFrame:
    """Upsert of the newest row per key of ``batches``, in one shuffle and without a join.

    Target rows compete with the batches and lose to any of them.  Rows of the
    target without a key match nothing and stay out of it.
    """
    columns = target.columns
    rivals = (
        batches.select(*columns)
        .withColumn("_incoming", F.lit(1))
        .unionByName(target.where(F.col(key).isNotNull()).withColumn("_incoming", F.lit(0)))
    )
    winners = latest_per_key(rivals, key, ("_incoming", *newest_first)).select(*columns)
    return winners.unionByName(target.where(F.col(key).isNull()))
