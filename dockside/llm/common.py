"""What several of the corpus operators share."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockside.session import scratch_path

#: Characters between words, as a regular expression class and spelled out.
BLANK_CLASS = "[\\x20\\x09-\\x0D]"
BLANKS = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Whether Spark removes a query's shuffle files at its end; otherwise they stay until the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(rows: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``rows`` written to the shared checkpoint folder and read back.

    Cuts the lineage: what is built on it survives the loss of any executor
    without computing ``rows`` again, and sees the same rows each time.  The
    shuffle files behind it serve nothing any more and go with the write.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        rows.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(rows.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text; a missing one counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key(*columns: str) -> Column:
    """A 64-bit key of a row's content, equal for repeated rows."""
    return F.xxhash64(*[F.col(c) for c in columns])


def fold(divisor: int) -> Column:
    """crc32 of the document's id as text, modulo ``divisor``; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % divisor


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row.

    Inside the lambdas of array functions Spark would compute an inlined
    expression again for each element.
    """
    return F.transform(F.array(value), body)[0]


def as_columns(rows: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The columns of ``schema`` in order, cast where they differ."""
    wanted = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])


#: Most keys of one join that are broadcast for being frequent.
FREQUENT_KEYS = 1 << 16


def attached(rows: DataFrame, table: DataFrame, key: str, copies: str) -> DataFrame:
    """Each of ``rows`` with its row of ``table``, which says in ``copies`` how many rows share its key.

    Keys of more than one in FREQUENT_KEYS of all rows cannot outnumber
    FREQUENT_KEYS: they are broadcast, so no task gets all rows of one.
    """
    total = table.agg(F.sum(copies)).first()[0] or 0
    often = F.col(copies) > total // FREQUENT_KEYS
    frequent = F.broadcast(table.where(often).drop(copies))
    others = rows.join(F.broadcast(table.where(often).select(key)), key, "left_anti")
    return rows.join(frequent, key).unionByName(others.join(table.where(~often).drop(copies), key))


@cache
def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)
