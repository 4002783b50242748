"""Exact quantiles of many different values, without one task that holds them all.

A summary with a bounded error gives two values around each wanted rank. Counting the rows below
and between them shows whether the rank does lie there, and only the values between are sorted: about
one in a thousand. Where the count should show that the rank lies elsewhere, all values are sorted,
so the result is exact in any case.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The summary's ranks are right to one part in this many.
ACCURACY = 10_000
#: How far beside a wanted share the two values are looked for.
MARGIN = 5 / ACCURACY


def exact_quantiles(rows: DataFrame, value: str, shares: Sequence[float]) -> DataFrame:
    """One row: ``n`` non-null values and ``q``, a quantile for each share, by linear interpolation.

    ``shares`` ascend. NULL values don't count; without any value the quantiles are NULL.
    """
    slim = rows.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    asked = [min(max(p + side, 0.0), 1.0) for p in shares for side in (-MARGIN, MARGIN)]
    summary = slim.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("v", asked, ACCURACY).alias("bounds"))
    known = summary.select(F.struct("n", "bounds")).scalar()
    v, s, c = F.col("v"), F.col("__summary"), F.col("__counts")

    def between(i: int) -> Column:
        return v.between(s["bounds"][2 * i], s["bounds"][2 * i + 1])

    counted = slim.withColumn("__summary", known).agg(
        F.array(*[F.count_if(v < s["bounds"][2 * i]) for i in range(len(shares))]).alias("below"),
        F.array(*[F.count_if(between(i)) for i in range(len(shares))]).alias("inside"),
    )
    place = F.element_at(F.array(*map(F.lit, shares)), F.col("i") + 1) * (s["n"] - 1)
    low = F.floor(place)
    high = F.least(low + 1, s["n"] - 1)

    def found(i: int) -> Column:
        """Whether the two ranks around a share lie between its bounds."""
        first = F.floor(F.lit(shares[i]) * (s["n"] - 1))
        return (c["below"][i] <= first) & (F.least(first + 1, s["n"] - 1) < c["below"][i] + c["inside"][i])

    tagged = F.array(*[F.when(between(i) | ~found(i), F.lit(i)) for i in range(len(shares))])
    with_counts = slim.withColumn("__summary", known).withColumn("__counts", counted.select(F.struct("below", "inside")).scalar())
    picked = with_counts.select("v", "__summary", "__counts", F.explode(F.filter(tagged, lambda i: i.isNotNull())).alias("i"))
    offset = F.element_at(F.array(*[F.when(found(i), c["below"][i]).otherwise(0) for i in range(len(shares))]), F.col("i") + 1)
    values = picked.groupBy("i", "v", place.alias("place"), low.alias("low"), high.alias("high"), offset.alias("offset")).agg(
        F.count(F.lit(1)).alias("n")
    )
    reached = F.col("offset") + F.sum("n").over(Window.partitionBy("i").orderBy("v"))
    ranked = values.withColumn("reached", reached).groupBy("i").agg(
        F.min(F.when(F.col("reached") > F.col("low"), v)).alias("a"),
        F.min(F.when(F.col("reached") > F.col("high"), v)).alias("b"),
        F.any_value("place").alias("place"),
        F.any_value("low").alias("low"),
    )
    part = F.col("place") - F.col("low")
    quantile = F.when(part > 0, (1 - part) * F.col("a") + part * F.col("b")).otherwise(F.col("a"))
    pairs = F.array_sort(F.collect_list(F.struct("i", quantile.alias("q"))))
    listed = ranked.agg(F.transform(pairs, lambda p: p["q"]).alias("q"))
    q = F.array(*[F.try_element_at("q", F.lit(i + 1)) for i in range(len(shares))])
    return listed.select(known["n"].alias("n"), q.alias("q"))
