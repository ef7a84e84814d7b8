"""One row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, key: str, newest_first: tuple[str, ...]) -> DataFrame:
    """The first row of each key, all named columns descending, NULLs last.

    Ties are settled by the remaining columns, so the result does not depend on
    how rows are spread over tasks.  Filtering row_number to 1 lets Spark keep
    one candidate per key in every map task before the shuffle, so a key that
    holds much of the table costs one row per task.
    """
    rest = [c for c in rows.columns if c != key and c not in newest_first]
    order = [F.col(c).desc_nulls_last() for c in (*newest_first, *rest)]
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")
