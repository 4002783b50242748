"""A corpus pipeline of five stages over ``documents``, each by one training-data operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountpulse.llm import bpe, decontaminate, exact_dedup, quality, simhash
from accountpulse.llm.common import table
from accountpulse.llm.queries import VOCABULARY
from accountpulse.sources.staging import stage


def quality_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier, with its sites' evidence, accepts."""
    model = quality.train(docs, table(spark, folder, "labels"))
    rated = quality.assess(docs, model, host=F.col("source"), path=F.col("lang"))
    return rated.filter("__keep").select(docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return exact_dedup.drop_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.drop_near_duplicates(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.drop_contaminated(docs, table(spark, folder, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with their token ids and the digest of what these decode to."""
    return bpe.tokenized(docs, public_tokenizers.path(VOCABULARY), decoded=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("tokens", token_stage),
]

#: SQL can express neither the fitted classifier nor the tokens; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages, each written as Parquet and read again by the next."""
    docs = table(spark, folder, "documents")
    for number, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, folder)
        if number < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
