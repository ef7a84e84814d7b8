"""Record keys: two identifying columns and a day, joined by underscores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockside.functions.dates import compact_day

# Texts a missing part and a missing day turn into.
MISSING_PART = "None"
MISSING_DAY = "NULL"


def strict_key(first: Column, second: Column, day: Column) -> Column:
    """NULL as soon as one part is NULL."""
    return F.concat(first.cast("string"), F.lit("_"), second.cast("string"), F.lit("_"), compact_day(day))


def tolerant_key(first: Column, second: Column, day: Column) -> Column:
    """Never NULL: missing parts are spelled out."""
    return F.concat_ws(
        "_",
        F.coalesce(first.cast("string"), F.lit(MISSING_PART)),
        F.coalesce(second.cast("string"), F.lit(MISSING_PART)),
        F.coalesce(compact_day(day), F.lit(MISSING_DAY)),
    )
