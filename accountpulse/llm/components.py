"""Connected components of a graph that is far larger than one task.

Large-star and small-star steps alternate: each node links its larger (smaller) neighbours to the
least node it knows. Both are an aggregate and a join on the node, so a node with very many links
is combined before the shuffle and its join partition can be split. Every step's links are a
written table; only their count and checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of a link ``(u, v)``; the root is its component's least node.

    Links may repeat, point either way or join a node to itself; nulls link nothing. Without
    links the result is empty.
    """
    ordered = links.filter("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    links = stage(ordered.distinct(), "links")
    state = _state(links)
    while True:
        links = stage(_small_star(_large_star(links)), "links")
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
