"""A corpus through five stages; each is written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dockside.llm.common import read_table, settled
from dockside.llm.near_copies import one_of_each_group
from dockside.llm.packing import pack_documents
from dockside.llm.quality_rules import kept_documents
from dockside.llm.queries import BYTE_VOCABULARY
from dockside.llm.secrets_scan import masked
from dockside.llm.toxicity import not_toxic
from dockside.session import tune

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that run through their host."""
    tune(spark)
    return kept_documents(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the limit; the labels name rows of the stage's input."""
    tune(spark)
    return not_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    tune(spark)
    return one_of_each_group(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    tune(spark)
    return masked(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed into sequences."""
    tune(spark)
    return pack_documents(docs, BYTE_VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("secret_scans", secret_scans),
    ("packing", packing),
]

#: Models, signatures and tokenizers are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that come through all stages."""
    docs = read_table(tune(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name)
    return docs
