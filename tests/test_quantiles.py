"""Exact quantiles against numpy, and how few values meet in one task."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from accountpulse.operators import quantiles, views

SHARES = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


def result(df, shares=SHARES):
    return quantiles.exact_quantiles(df, "v", shares).collect()


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3, 1, 2], [5] * 9 + [1], [0.1, None, 0.7, None, 0.3], list(range(101))])
def test_small(spark, values):
    (row,) = result(spark.createDataFrame([(None if x is None else float(x),) for x in values], "v double"))
    known = [x for x in values if x is not None]
    assert row["n"] == len(known)
    assert row["q"] == pytest.approx(np.quantile(known, SHARES).tolist(), rel=1e-12)


def test_no_values(spark):
    (row,) = result(spark.createDataFrame([(None,)], "v double"), [0.5])
    assert row["n"] == 0 and row["q"] == [None]


def many(spark):
    """A million different fractions, very unevenly spread."""
    return spark.range(0, 1_000_000, 1, 8).select(F.exp(F.pmod(F.col("id") * 7919, F.lit(1_000_003)) / 50_000.0).alias("v"))


def test_a_million_values(spark):
    values = np.exp(np.arange(1_000_000) * 7919 % 1_000_003 / 50_000.0)
    (row,) = result(many(spark))
    assert row["q"] == pytest.approx(np.quantile(values, SHARES).tolist(), rel=1e-12)


def test_few_values_are_sorted(spark):
    """The sort and the window above it get about one value in a thousand."""
    found = quantiles.exact_quantiles(many(spark), "v", [0.5])
    found.collect()
    sorted_rows = []

    def walk(node):
        if node.nodeName() == "Window":
            below = node.children().apply(0)
            while not below.metrics().contains("numOutputRows"):
                below = below.plan() if "QueryStage" in below.nodeName() else below.children().apply(0)
            sorted_rows.append(below.metrics().apply("numOutputRows").value())
        kids = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else []
        kids += [node.plan()] if "QueryStage" in node.nodeName() else []
        kids += [node.children().apply(i) for i in range(node.children().size())]
        for kid in kids:
            walk(kid)

    walk(found._jdf.queryExecution().executedPlan())
    assert sorted_rows and max(sorted_rows) < 10_000


def test_wrong_bounds_cost_time_only(spark, monkeypatch):
    """Where the summary is off, the count tells and all values are sorted."""
    monkeypatch.setattr(quantiles, "MARGIN", -0.2)
    df = spark.range(5000).select((F.col("id") * 1.5).alias("v"))
    (row,) = result(df, [0.25, 0.5, 0.75])
    assert row["q"] == pytest.approx(np.quantile(np.arange(5000) * 1.5, [0.25, 0.5, 0.75]).tolist())


def test_views_with_fractions(spark):
    pick = np.random.default_rng(2)
    values = pick.lognormal(size=4001).tolist()
    rows = [(str(i), "2025-01-05", x) for i, x in enumerate(values)] + [("x", "2025-01-05", None), ("y", "2025-01-12", 9.0)]
    df = spark.createDataFrame(rows, "companyId string, w string, m double").withColumn("w", F.to_date("w"))
    day = df.where("companyId = '0'").first()["w"]
    box = views.distribution_box(df, "w", "m", day).first()
    assert [box["q1"], box["median"], box["q3"]] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]).tolist())
    high = box["q3"] + 1.5 * (box["q3"] - box["q1"])
    assert box["outliers"] == sum(x > high for x in values) and box["max"] == max(values)
    assert views.distribution_stats(df, "w", "m", day).first()["median"] == pytest.approx(float(np.median(values)))
