"""Join helpers for keys that are often NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_lookup(df: DataFrame, lookup: DataFrame, key: str, spread_by: Column, lookup_key: str = "id") -> DataFrame:
    """LEFT JOIN on a key that is NULL on many rows.

    A plain left join sends every NULL key to one task. Here the join key is a pair: the
    key itself and, for NULL keys only, a hash of ``spread_by``. The lookup side carries
    no hash, so a NULL key still finds nothing, but its rows go to all tasks. The pair is
    one struct; with two separate conditions the optimizer would fold the constant half
    away. A hot non-NULL key is left to the adaptive skew join, which splits it.
    """
    ours = F.struct(F.col(key).alias("k"), F.when(F.col(key).isNull(), F.xxhash64(spread_by)).alias("s"))
    theirs = F.struct(F.col(lookup_key).alias("k"), F.lit(None).cast("bigint").alias("s"))
    right = lookup.where(F.col(lookup_key).isNotNull()).withColumn("__key", theirs).drop(lookup_key)
    left = df.withColumn("__key", ours)
    return left.join(right, "__key", "left").drop("__key")
