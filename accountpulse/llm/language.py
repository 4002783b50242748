"""Language identification by nearest centroid.

A text is the normalised TF-IDF vector of its letter trigrams, hashed to a fixed number of
places. Inverse document frequencies are counted over all training texts. Each language's vectors
are clustered, so a language with several kinds of text has several centroids; the language of the
centroid at the largest cosine is the answer. Each centroid also has the cosine that nearly
all of its own training texts reach; a text below it is marked as rejected, being close to nothing
learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import broadcast_within, column_lists, map_batches, map_groups

#: Places that trigrams are hashed to.
PLACES = 4096
#: Centroids of each language.
CLUSTERS = 3
#: Different training texts of each language that are clustered, about at most.
SAMPLE = 1_000
#: Share of a centroid's training texts that rejection lets go.
REJECTED = 0.005
#: Characters that are counted at once.
CHARS = 1 << 20
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def _codes(text: str) -> np.ndarray:
    """Lower-case code points; whatever is no letter is a space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letters()[codes], codes, np.uint32(32))


def counted(texts: list[str | None], places: int = PLACES) -> tuple[np.ndarray, np.ndarray]:
    """Trigram counts of each text and whether it has a letter."""
    lettered = np.zeros(len(texts), bool)
    rows, cells = [], []
    gap = np.full(2, 32, np.uint32)
    for i, text in enumerate(texts):
        if not text:
            continue
        c = np.concatenate((gap[:1], _codes(text), gap[:1]))
        lettered[i] = bool((c != 32).any())
        if not lettered[i]:
            continue
        a, b, d = c[:-2], c[1:-1], c[2:]
        full = b != 32
        h = (a[full] * np.uint32(2654435761) + b[full]) * np.uint32(2246822519) + d[full]
        h ^= h >> np.uint32(15)
        h *= np.uint32(3266489917)
        cells.append((h >> np.uint32(16)).astype(np.int64) % places + i * places)
    flat = np.concatenate(cells) if cells else np.zeros(0, np.int64)
    return np.bincount(flat, minlength=len(texts) * places).reshape(len(texts), places), lettered


def _chunks(texts: list[str | None], places: int) -> Iterator[slice]:
    """Runs of texts whose characters and counts stay small; a longer text is a run of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text or "") + places
        if i > start and held + size > CHARS:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(texts):
        yield slice(start, len(texts))


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors, with frequencies dampened by a square root."""
    x = np.sqrt(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def clustered(x: np.ndarray, weights: np.ndarray, count: int, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids by spherical k-means of weighted rows, and each row's cosines; starts far apart."""
    picks = [int(np.argmax(x @ (weights @ x)))]
    best = x @ x[picks[0]]
    while len(picks) < min(count, len(x)):
        picks.append(int(np.argmin(best)))
        best = np.maximum(best, x @ x[picks[-1]])
    centroids = x[picks]
    for _ in range(steps):
        own = np.argmax(x @ centroids.T, axis=1)
        sums = np.array([weights[own == k] @ x[own == k] if (own == k).any() else centroids[k] for k in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids, x @ centroids.T


@dataclass(frozen=True)
class Centroids:
    """Languages, unit vectors and least usual cosines, row by row, with the term weights."""

    langs: tuple[str, ...]
    vectors: np.ndarray
    limits: np.ndarray
    idf: np.ndarray

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Language, cosine from 0 to 1, and whether the text is too far from it."""
        out: list[tuple[str, float, bool]] = []
        for part in _chunks(texts, len(self.idf)):
            counts, lettered = counted(texts[part], len(self.idf))
            if not self.langs:
                out += [(UNKNOWN, 0.0, True)] * len(lettered)
                continue
            cosines = weighted(counts, self.idf) @ self.vectors.T
            for row, known in zip(cosines, lettered):
                at = int(np.argmax(row))
                score = float(min(max(row[at], 0.0), 1.0))
                out.append((self.langs[at], score, bool(row[at] < self.limits[at])) if known else (UNKNOWN, 0.0, True))
        return out


def _document_frequencies(texts: DataFrame, places: int) -> np.ndarray:
    """Texts with a letter, then texts per place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(places + 1, np.int64)
        for (rows,) in column_lists(batches):
            for part in _chunks(rows, places):
                counts, lettered = counted(rows[part], places)
                total[0] += lettered.sum()
                total[1:] += (counts > 0).sum(0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["place", "n"])

    out = np.zeros(places + 1, np.int64)
    for row in map_batches(texts, run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        out[row["place"]] = row["n"]
    return out


def train(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    places: int = PLACES,
    clusters: int = CLUSTERS,
    sample: int = SAMPLE,
    rejected: float = REJECTED,
) -> Centroids:
    """Centroids of the languages of ``docs``; rows without a language or a letter teach nothing.

    Term weights come from all rows. Of each language about ``sample`` different texts, those of the
    least hashes, are clustered in one task per language; a text weighs as often as it occurs. The
    model takes about 100 kB per language, of which there is no limit.
    """
    known = docs.filter(F.col(lang_column).isNotNull()).select(
        F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang")
    )
    seen = _document_frequencies(known.select("text"), places)
    idf = np.log((1 + seen[0]) / (1 + seen[1:])) + 1
    # Texts are told apart by a hash, so that copies are counted before anything is chosen.
    hashed = known.withColumn("hash", F.xxhash64("text"))
    copies = stage(hashed.groupBy("lang", "hash").agg(F.count(F.lit(1)).alias("n")), "copies")
    share = F.least(F.lit(1.0), F.lit(float(sample)) / F.count(F.lit(1)))
    shares = copies.groupBy("lang").agg(share.alias("share"))
    place = F.pmod(F.xxhash64("hash"), F.lit(1_000_003)) / 1_000_003.0
    picked = copies.join(shares, "lang").filter(place < F.col("share")).select("lang", "hash", "n")
    picked = broadcast_within(stage(picked, "picked"))
    chosen = hashed.join(picked, ["lang", "hash"]).groupBy("lang", "hash", "n").agg(F.min("text").alias("text"))

    def cluster(group: pa.Table) -> pa.Table:
        pairs = sorted((t, n) for t, n in zip(group.column("text").to_pylist(), group.column("n").to_pylist()) if t)
        texts, often = [t for t, _ in pairs], np.array([n for _, n in pairs], np.float32)
        vectors, weights = [], []
        for part in _chunks(texts, places):
            counts, lettered = counted(texts[part], places)
            vectors.append(weighted(counts[lettered], idf).astype(np.float32))
            weights.append(often[part][lettered])
        x = np.concatenate(vectors) if vectors else np.zeros((0, places), np.float32)
        if not len(x):
            return pa.table({"lang": pa.array([], pa.string()), "vector": pa.array([], pa.list_(pa.float64())), "limit": pa.array([], pa.float64())})
        centroids, cosines = clustered(x, np.concatenate(weights), clusters)
        own = np.argmax(cosines, axis=1)
        limits = [float(np.quantile(cosines[own == k, k], rejected)) if (own == k).any() else 1.0 for k in range(len(centroids))]
        return pa.table(
            {
                "lang": pa.array([group.column("lang")[0].as_py()] * len(centroids)),
                "vector": pa.array([c.tolist() for c in centroids.astype(float)], pa.list_(pa.float64())),
                "limit": pa.array(limits),
            }
        )

    found = map_groups(chosen, "lang", cluster, "lang string, vector array<double>, limit double").collect()
    rows = sorted((r["lang"], r["vector"], r["limit"]) for r in found)
    vectors = np.array([r[1] for r in rows], float).reshape(len(rows), places)
    return Centroids(tuple(r[0] for r in rows), vectors, np.array([r[2] for r in rows]), idf)


def identified(docs: DataFrame, model: Centroids, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, ``lang_pred``, ``score`` and ``rejected``.

    ``score`` is the cosine to the nearest centroid. A text without a letter, null and empty ones
    too, is ``und`` with score 0; without training rows every text is. Ids may be null or repeat; an
    empty table gives an empty result; other columns are not read. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in column_lists(batches):
            rows = model.predict(texts)
            kinds = (pa.string(), pa.float64(), pa.bool_())
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *columns], ["id", "lang_pred", "score", "rejected"])

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    out = map_batches(source, run, "id long, lang_pred string, score double, rejected boolean")
    return out.withColumnRenamed("id", id_column)
