"""Exact duplicates with the frequent digests split off.

A digest that a large share of the rows carries would send them all to one shuffle partition.
Misra-Gries counting (``DataFrame.stat.freqItems``) proposes at most ``1 / support`` digests,
among them every one that more than ``support`` of the rows carry. One aggregate over only those
gives their true winners; that table has at most ``1 / support`` rows, so it is broadcast and the
frequent rows never meet in a shuffle. The other digests are ranked after an ordinary shuffle, in
which no digest holds more than ``support`` of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import ascii_lower

#: A digest above this share of the rows is surely split off; at most 1 / SUPPORT are broadcast.
SUPPORT = 0.001


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z lower-cased; null counts as empty."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256)


def _digests(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Written table of id, digest and row number: the text is read and hashed once."""
    return stage(
        docs.select(
            F.col(id_column).alias("id"),
            text_digest(F.col(text_column)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )


def _groups(rows: DataFrame, support: float) -> DataFrame:
    frequent = F.broadcast(
        rows.stat.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest"))
    )
    winners = (
        rows.join(frequent, "digest")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", "row")).alias("winner"))
    )
    hot = rows.join(F.broadcast(winners), "digest").select(
        "id",
        F.col("winner.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"),
        "digest",
    )
    group = Window.partitionBy("digest")
    rank = F.row_number().over(group.orderBy(F.col("id").desc_nulls_last(), F.col("row").desc()))
    rest = rows.join(frequent, "digest", "left_anti").select(
        "id",
        F.max("id").over(group).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("group_size"),
        (rank == 1).alias("kept"),
        "digest",
    )
    return hot.unionByName(rest)


def duplicate_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", support: float = SUPPORT
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Of equal texts the row with the largest id stays. Null text counts as empty, so null and empty
    texts form one group. A null id ranks below every other; a group of null ids has a null
    ``keep_id`` and still keeps one row. Where rows repeat id and text, one of them stays.
    An empty table gives an empty result; other columns are not read.
    """
    return _groups(_digests(docs, id_column, text_column), support).select(
        F.col("id").alias(id_column), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def drop_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", support: float = SUPPORT
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; cases as in ``duplicate_groups``.

    Rows are found again by id and digest. Where rows repeat both, an aggregate of its own over
    just those rows keeps one; it combines before its shuffle. A column may have any name but
    ``__own``, ``__id`` and ``__digest``.
    """
    rows = _digests(docs, id_column, text_column)
    key = ["__id", "__digest"]
    kept = _groups(rows, support).filter("kept").select(F.col("id").alias("__id"), F.col("digest").alias("__digest"))
    repeated = rows.groupBy("id", "digest").count().filter("count > 1").toDF(*key, "__rows").select(key)

    own = docs.withColumn("__own", text_digest(F.col(text_column)))

    def keyed(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        same = F.col(id_column).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__digest"))
        return left.join(right, same, how)

    found = keyed(own, kept, "left_semi")
    if not repeated.isEmpty():
        twins = keyed(found, repeated, "left_semi").dropDuplicates([id_column, "__own"])
        found = keyed(found, repeated, "left_anti").unionByName(twins)
    return found.drop("__own")
