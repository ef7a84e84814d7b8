"""Token counts through a cache of content digests.

The cache is a parquet table of (tokenizer digest, content digest, count).
Documents are looked up by the digests of their normalised content and of the
tokenizer's version; only distinct contents without an entry are encoded, and
their counts are appended.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockside.llm.common import settled, tokenizer_path, whole_text
from dockside.llm.encoding import text_encoder

CACHE_SCHEMA = "tokenizer string, content binary, n_tokens bigint"


def tokenizer_digest(path: str, options: str = "plain") -> str:
    """Digest of the vocabulary file and of how it is used."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + options.encode()).hexdigest()


def content_digest(text: Column) -> Column:
    """sha-256 of the text.  The normalisation is the identity: nothing else is sure to keep a count."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def counted(texts: DataFrame, tokenizer: str) -> DataFrame:
    """(content, text) with each text encoded once, as (content, n_tokens)."""

    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = text_encoder(tokenizer_path(tokenizer))
        for batch in batches:
            found = [len(ids) for ids in encoder.encode(batch["text"].tolist())]
            yield pd.DataFrame({"content": batch["content"], "n_tokens": pd.Series(found, dtype="int64")})

    return texts.mapInPandas(lengths, "content binary, n_tokens bigint")


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Entries for one tokenizer version; each content once, whatever a repeated append has left."""
    rows = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == version)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(documents: DataFrame, tokenizer: str, cache: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row; ``cache`` is a folder, made if absent.

    A missing text counts as empty.  Repeated rows and copies are encoded once;
    a copied text with a third of all rows meets its one cache entry in a join
    whose big partition Spark splits, and only one copy per task is shuffled as
    text.
    """
    spark = documents.sparkSession
    version = tokenizer_digest(tokenizer_path(tokenizer))
    text = whole_text()
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)
    keyed = rows.withColumn("content", content_digest(F.col("text")))
    known = read_cache(spark, cache, version)
    misses = keyed.select("content", "text").join(known, "content", "left_anti")
    distinct = misses.groupBy("content").agg(F.first("text").alias("text"))
    entries = counted(distinct, tokenizer).select(F.lit(version).alias("tokenizer"), "content", "n_tokens")
    entries.write.mode("append").parquet(cache)
    narrow = keyed.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "content")
    return settled(narrow.join(read_cache(spark, cache, version), "content").drop("content"), "counts")
