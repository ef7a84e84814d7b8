"""Raw column to typed column, with the defaults the target tables rely on.

Built from ``try_cast``, so bad input never fails under ANSI mode.  The one
input that must fail a load, a number that no BIGINT holds unchanged, raises inside
the expression, or is left NULL where the load counts such rows and refuses the batch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# First and last day a nanosecond timestamp can hold in full.
FIRST_DAY = "1677-09-22"
LAST_DAY = "2262-04-11"

# Java's parser takes suffixes ("12d") and hex floats; plain decimals only here.
# Infinity counts as a number, so it fails the load like any other misfit.
DECIMAL_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


WHOLE_KINDS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def readings(value: Column, kind: T.DataType | None) -> tuple[Column, Column]:
    """``value`` as BIGINT where that loses nothing, and as DOUBLE where it is a number; else NULL."""
    text = value.cast("string")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        real = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    else:
        real = F.when(text.rlike(DECIMAL_TEXT), text.try_cast("double"))
    rounded = F.when(real == F.floor(real), real.try_cast("bigint"))
    return F.coalesce(text.try_cast("bigint"), rounded), real


def is_misfit(value: Column, kind: T.DataType | None = None) -> Column:
    """TRUE for a number that no BIGINT holds unchanged: a fraction, one too large, an infinity."""
    if isinstance(kind, WHOLE_KINDS):
        return F.lit(False)
    whole, real = readings(value, kind)
    return whole.isNull() & real.isNotNull()


def to_integer(value: Column, kind: T.DataType | None = None, label: str = "value", strict: bool = True) -> Column:
    """BIGINT; unreadable or missing is 0, a misfit is an error (NULL if not ``strict``)."""
    zero = F.lit(0).cast("bigint")
    if isinstance(kind, WHOLE_KINDS):
        return F.coalesce(value.cast("bigint"), zero)
    whole, real = readings(value, kind)
    failure = F.lit(None)
    if strict:
        failure = F.raise_error(F.concat(F.lit(f"{label}: not a whole number: "), value.cast("string")))
    return F.when(whole.isNotNull(), whole).when(real.isNotNull(), failure.cast("bigint")).otherwise(zero)


def to_day(value: Column, kind: T.DataType | None = None) -> Column:
    """DATE; ISO or yyyymmdd text.  Unreadable or out of bounds is NULL."""
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        day = value.cast("date")
    else:
        text = value.cast("string")
        day = F.coalesce(text.try_cast("date"), F.try_to_date(text, "yyyyMMdd"))
    return F.when(day.between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")), day)


def to_text(value: Column) -> Column:
    """STRING; missing, or the text 'None', is empty."""
    return F.coalesce(F.nullif(value.cast("string"), F.lit("None")), F.lit(""))
