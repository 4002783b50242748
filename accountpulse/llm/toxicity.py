"""Toxicity by multiple-instance learning on sentences.

Only documents carry labels. A sentence's probability is logistic in the words and word beginnings
it holds, and a document's is the noisy-or of its sentences: one minus the product of their complements. Fitting
that product to the documents' labels tells which sentences made a document toxic, so scoring also
returns where the worst sentence lies.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import column_lists, labelled_sample, map_batches

#: Labelled rows that the model is fitted on, at most about.
SAMPLE = 20_000
#: Documents of the sample a term must occur in.
LEAST_DOCS = 4
#: Absolute standard score of a term's share among toxic documents, at least.
LEAST_SCORE = 3.0

SENTENCE = re.compile(r"[^.!?\n]*[^.!?\s][^.!?\n]*")
WORD = re.compile(r"\w+")
#: Lengths of the word beginnings that are terms beside the words themselves.
STEMS = (3, 4, 5, 6)
#: Words whose terms a worker keeps.
MEMORY = 200_000


def terms(word: str) -> list[str]:
    """A word and its beginnings, those marked by a hyphen."""
    return [word, *(word[:n] + "-" for n in STEMS if len(word) > n)]


class KnownTerms(dict):
    """The known terms of each word, kept for words that come again."""

    def __init__(self, known: frozenset[str]):
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) >= MEMORY:
            self.clear()
        found = self[word] = tuple(t for t in terms(word) if t in self.known)
        return found

    def of(self, sentence: str) -> set[str]:
        return set().union(*map(self.__getitem__, WORD.findall(sentence.lower())))


@dataclass(frozen=True)
class Model:
    """Weights of terms and the bias of every sentence; ``constant`` where labels had one class only."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -20.0
    constant: float | None = None

    @cached_property
    def known(self) -> KnownTerms:
        return KnownTerms(frozenset(self.weights))

    def sentences(self, text: str | None) -> Iterator[tuple[int, int, float]]:
        """Start, end and log-odds of each sentence."""
        get, known = self.weights.__getitem__, self.known
        for found in SENTENCE.finditer(text or ""):
            hits = known.of(found[0])
            yield found.start(), found.end(), self.bias + sum(map(get, sorted(hits))) if hits else self.bias

    def score(self, text: str | None) -> tuple[float, int, int, float]:
        """The document's score; start, end and probability of its worst sentence."""
        left, worst, place, plain = 0.0, -math.inf, (0, 0), -_softplus(self.bias)
        for start, end, odds in self.sentences(text):
            left += plain if odds == self.bias else -_softplus(odds)
            if odds > worst:
                worst, place = odds, (start, end)
        if worst == -math.inf:
            return 0.0, 0, 0, 0.0
        if self.constant is not None:
            return self.constant, *place, self.constant
        return -math.expm1(left), *place, 1 / (1 + math.exp(-max(min(worst, 700), -700)))


def _softplus(x: float) -> float:
    return x + math.log1p(math.exp(-x)) if x > 0 else math.log1p(math.exp(x))


def _word_counts(rows: DataFrame) -> DataFrame:
    """Documents per term and label; only a task's sums leave it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for labels, texts in column_lists(batches):
            counts: dict[str, list[int]] = {}
            for label, text in zip(labels, texts):
                words = set(WORD.findall((text or "").lower()))
                for word in {t for w in words for t in terms(w)}:
                    counts.setdefault(word, [0, 0])[label != 0] += 1
            pairs = [*counts.values()] or [(0, 0)] * 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), *(pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1))],
                ["word", "clean", "toxic"],
            )

    found = map_batches(rows, run, "word string, clean long, toxic long")
    return found.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _instances(rows: DataFrame, words: list[str]) -> DataFrame:
    """Of each document: its label, how many sentences hold no known word, and the others' word numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(words)}
        known = KnownTerms(frozenset(words))
        for labels, texts in column_lists(batches):
            plain, bags = [], []
            for text in texts:
                hits = [known.of(s[0]) for s in SENTENCE.finditer(text or "")]
                bags.append([[number[w] for w in sorted(h)] for h in hits if h])
                plain.append(sum(not h for h in hits))
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels, pa.int32()), pa.array(plain, pa.int64()), pa.array(bags, pa.list_(pa.list_(pa.int32())))],
                ["label", "plain", "bags"],
            )

    return map_batches(rows, run, "label int, plain long, bags array<array<int>>")


def fit_noisy_or(
    labels: np.ndarray, plain: np.ndarray, bags: list[list[list[int]]], size: int, steps: int = 400, ridge: float = 0.02
) -> tuple[np.ndarray, float]:
    """Word weights and bias by gradient steps (Adam) on the noisy-or's log-likelihood."""
    doc = np.array([d for d, b in enumerate(bags) for _ in b], np.int64)
    lengths = np.array([len(s) for b in bags for s in b], np.int64)
    word = np.fromiter((w for b in bags for s in b for w in s), np.int64, int(lengths.sum()))
    sentence = np.repeat(np.arange(len(lengths)), lengths)
    y, n = labels.astype(float), len(labels)
    rate = (y.mean() + 1e-6) / max(1.0, float(plain.mean()) + len(doc) / n)
    x = np.zeros(size + 1)
    x[size] = math.log(rate)
    first, second = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        z = x[size] + np.bincount(sentence, x[word], len(lengths))
        p, base = 1 / (1 + np.exp(-np.clip(z, -40, 40))), 1 / (1 + math.exp(-x[size]))
        left = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), n) + plain * math.log1p(-base)
        whole = -np.expm1(left)
        push = np.where(y > 0, (1 - whole) / np.maximum(whole, 1e-12), -1.0)
        each = p * push[doc]
        gradient = np.append(np.bincount(word, each[sentence], size), each.sum() + (base * push * plain).sum()) / n
        gradient[:size] -= ridge * x[:size] / n
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        x += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        x[size] = min(x[size], -1e-3)
    return x[:size], float(x[size])


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample: int = SAMPLE,
    least_docs: int = LEAST_DOCS,
    least_score: float = LEAST_SCORE,
) -> Model:
    """Model fitted on at most ``sample`` labelled rows, those of the least hashes of their ids.

    A term of the sample has a weight if it occurs in ``least_docs`` of its documents and its share
    of toxic ones stands out by ``least_score`` standard deviations; there is no limit on their
    number. The driver gets those terms and the sample's term numbers.
    """
    rows = stage(labelled_sample(docs, labels, id_column, text_column, label_column, sample), "labelled")
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("label") != 0).cast("long")).alias("t")).first()
    n, toxic = totals["n"], totals["t"] or 0
    if toxic in (0, n):
        return Model(constant=float(toxic > 0))
    rate = toxic / n
    seen = F.col("clean") + F.col("toxic")
    score = (F.col("toxic") - seen * rate) / F.sqrt(seen * rate * (1 - rate))
    chosen = _word_counts(rows).filter((seen >= least_docs) & (F.abs(score) >= least_score))
    words = sorted(r["word"] for r in chosen.collect())
    parts = sorted((r["label"], r["plain"], r["bags"]) for r in _instances(rows, words).collect())
    weights, bias = fit_noisy_or(
        np.array([p[0] != 0 for p in parts]), np.array([p[1] for p in parts], float), [p[2] for p in parts], len(words)
    )
    return Model(dict(zip(words, map(float, weights))), bias)


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, ``score``, ``predicted``, and start, end and score of the worst sentence.

    Places count characters of the text, from 0. A text without a sentence (null and empty ones
    too) scores 0. Ids may be null or repeat; an empty table gives an empty result; other columns are
    not read. Trained on one class only, every other text has that class's score. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in column_lists(batches):
            rows = [model.score(t) for t in texts]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.float64(), pa.int64(), pa.int64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *columns], ["id", "score", "worst_start", "worst_end", "worst_score"]
            )

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    out = map_batches(source, run, "id long, score double, worst_start long, worst_end long, worst_score double")
    return out.select(
        F.col("id").alias(id_column), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "worst_start", "worst_end", "worst_score"
    )

