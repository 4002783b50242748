"""Written hand-off tables in the shared folder.

A weekly export is small against the events behind it and is read several times (checks,
label discovery, prepare). Writing it once cuts the lineage at the cheapest point, and a
lost executor costs no recomputation.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return the written table."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/stage/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_observed(df: DataFrame, name: str, measures: Mapping[str, Column]) -> tuple[DataFrame, dict]:
    """As ``stage``, with aggregates of the written rows taken by the job that writes them."""
    seen = Observation(name)
    written = stage(df.observe(seen, *[measure.alias(m) for m, measure in measures.items()]), name)
    return written, seen.get


def fingerprint(spark: SparkSession, paths: list[str]) -> int:
    """Number that changes when a file under ``paths`` is added, removed or rewritten.

    Only the listing is read: the content column of the binary source is pruned.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    digest = files.agg(F.bit_xor(F.xxhash64("path", "modificationTime", "length")).alias("digest"))
    return digest.first()["digest"]
