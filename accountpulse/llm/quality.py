"""Text quality by hierarchical empirical Bayes over documents, hosts and paths.

A logistic classifier on surface features gives each document its own evidence. Sums of those
probabilities per host and per path of a host, taken in one grouped aggregate each, give every site a
rate. How much a site's rate counts is estimated from the data: the ratio of the variance inside
sites to that between them is the number of documents at which a site weighs as much as what it
is shrunk to. A path is shrunk to its host and a host to the whole corpus, so sparse sites
stay near the global rate. A document's own part is left out of its sites' sums, and the site's
evidence is added to the document's on the log-odds scale.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import labelled_sample, map_batches

#: Labelled rows that the classifier is fitted on, at most.
SAMPLE = 20_000
#: Documents with at least this score are kept.
THRESHOLD = 0.5
#: Sites that are broadcast, at most; a site takes about a hundred bytes.
BROADCAST_SITES = 100_000
#: Probabilities are kept this far from 0 and 1.
EDGE = 1e-4
#: Variance between sites, at least this share of that inside them.
LEAST_BETWEEN = 1e-6

UPPER = bytes(range(ord("A"), ord("Z") + 1))
DIGITS = bytes(range(ord("0"), ord("9") + 1))
STOPS = b".,;:?'\"()-"
OTHER = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in STOPS)


def features(text: str | None) -> list[float] | None:
    """Surface features of a text; None without a word."""
    data = (text or "").encode("utf-8")
    words = data.split()
    if not words:
        return None
    size, lines = len(data), [x for x in data.split(b"\n") if x.strip()]

    def share(kind: bytes) -> float:
        return (size - len(data.translate(None, kind))) / size

    marked = sum(len(w) != len(w.translate(None, OTHER)) for w in words) / len(words)
    return [
        math.log(len(words)),
        size / len(words) / 10,
        10 * share(OTHER),
        10 * share(UPPER),
        10 * share(DIGITS),
        10 * share(STOPS),
        marked,
        len(set(words)) / len(words),
        len(set(lines)) / len(lines),
    ]


@dataclass(frozen=True)
class Classifier:
    """Logistic weights on standardised features; without them every text has probability ``rate``."""

    mean: tuple = ()
    scale: tuple = ()
    weights: tuple = ()
    rate: float = 0.5

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        rows = [features(t) for t in texts]
        out = np.zeros(len(texts))
        full = [i for i, r in enumerate(rows) if r is not None]
        if full:
            if self.weights:
                x = (np.array([rows[i] for i in full]) - self.mean) / self.scale
                z = x @ np.array(self.weights[1:]) + self.weights[0]
                out[full] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            else:
                out[full] = self.rate
        return out


def fit(rows: list[list[float] | None], labels: list[int], ridge: float = 1.0, steps: int = 25) -> Classifier:
    """Newton steps of a ridge logistic regression; with one class only, that class's rate."""
    pairs = sorted((f, y) for f, y in zip(rows, labels) if f is not None)
    y = np.array([p[1] for p in pairs], float)
    if len(y) == 0 or y.min() == y.max():
        return Classifier(rate=float(y[0]) * (1 - 2 * EDGE) + EDGE if len(y) else 0.5)
    x = np.array([p[0] for p in pairs])
    mean, scale = x.mean(0), x.std(0) + 1e-6
    x = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return Classifier(tuple(mean), tuple(scale), tuple(w))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample: int = SAMPLE,
) -> Classifier:
    """Classifier fitted on at most ``sample`` labelled rows, those of the least hashes of their ids."""
    rows = labelled_sample(docs, labels, id_column, text_column, label_column, sample)
    parts = map_batches(rows, _feature_batches, "label int, x array<double>").collect()
    return fit([r["x"] for r in parts], [r["label"] for r in parts])


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns))
        rows = [features(t) for t in columns["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [columns["label"].cast(pa.int32()), pa.array(rows, pa.list_(pa.float64()))], ["label", "x"]
        )


def with_evidence(docs: DataFrame, model: Classifier, text_column: str = "text", name: str = "__p") -> DataFrame:
    """``docs`` with the classifier's probability as a last column; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.probabilities(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(p)], [*batch.schema.names[1:], name])

    source = docs.select(F.col(text_column).alias("__text"), *docs.columns)
    return map_batches(source, run, type(docs.schema)([*docs.schema.fields]).add(name, "double"))


def _strength(sites: DataFrame) -> float:
    """Documents at which a site's own rate weighs as much as what it is shrunk to.

    One-way analysis of variance from the sites' counts, sums and sums of squares.
    """
    row = sites.agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("n").alias("n"),
        F.sum("s").alias("s"),
        F.sum("q").alias("q"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("c"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
    ).first()
    n, groups = row["n"] or 0, row["groups"]
    if groups < 2 or n <= groups:
        return 1 / LEAST_BETWEEN
    inside = max((row["q"] - row["c"]) / (n - groups), 1e-12)
    between = (row["c"] - row["s"] ** 2 / n - (groups - 1) * inside) / (n - row["nn"] / n)
    return inside / max(between, LEAST_BETWEEN * inside)


def _log_odds(p: Column) -> Column:
    safe = F.greatest(F.least(p, F.lit(1 - EDGE)), F.lit(EDGE))
    return F.log(safe / (1 - safe))


def assess(
    docs: DataFrame,
    model: Classifier,
    host: Column,
    path: Column,
    text_column: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with ``__p``, ``__host_rate``, ``__path_rate``, ``__score`` and ``__keep``, one row per input row.

    A text without a word (null and empty ones too) has probability and score 0 and is not kept. A
    null host or path is a site like any other. Repeated rows count as often as they occur. Without
    labels every other text has 0.5 and is kept. An empty table gives an empty result.
    """
    named = docs.withColumn("__host", host).withColumn("__path", path)
    evidence = with_evidence(named, model, text_column)
    totals = [F.count(F.lit(1)).alias("n"), F.sum("__p").alias("s"), F.sum(F.col("__p") * F.col("__p")).alias("q")]
    slim = named.select(F.col(text_column).alias("text"), "__host", "__path")
    paths = stage(with_evidence(slim, model).groupBy("__host", "__path").agg(*totals), "paths")
    hosts = paths.groupBy("__host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    whole = paths.agg(F.sum("n"), F.sum("s")).first()
    rate = whole[1] / whole[0] if whole[0] else 0.5
    host_strength, path_strength = _strength(hosts), _strength(paths)

    sites = paths.select(
        F.col("__host").alias("__h"), F.col("__path").alias("__r"), F.col("n").alias("__n"), F.col("s").alias("__s")
    ).join(
        hosts.select(F.col("__host").alias("__g"), F.col("n").alias("__hn"), F.col("s").alias("__hs")),
        F.col("__h").eqNullSafe(F.col("__g")),
    )
    # Few enough sites go to every task; more meet their documents in a shuffle.
    if paths.count() <= BROADCAST_SITES:
        sites = F.broadcast(sites)
    p = F.col("__p")
    joined = evidence.join(sites, F.col("__host").eqNullSafe(F.col("__h")) & F.col("__path").eqNullSafe(F.col("__r")))
    host_rate = (F.col("__hs") - p + host_strength * rate) / (F.col("__hn") - 1 + host_strength)
    path_rate = (F.col("__s") - p + path_strength * F.col("__host_rate")) / (F.col("__n") - 1 + path_strength)
    odds = _log_odds(p) + _log_odds(F.col("__path_rate")) - _log_odds(F.lit(rate))
    score = F.when(p == 0, 0.0).otherwise(1 / (1 + F.exp(-odds)))
    return (
        joined.withColumn("__host_rate", host_rate)
        .withColumn("__path_rate", path_rate)
        .withColumn("__score", score)
        .withColumn("__keep", F.col("__score") >= threshold)
        .select(*docs.columns, "__p", "__host_rate", "__path_rate", "__score", "__keep")
    )
