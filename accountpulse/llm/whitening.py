"""Whitening of embeddings by an incremental eigendecomposition.

Every partition keeps the spectrum (eigenvalues and eigenvectors) of what it has read, about its own
mean, and updates it by symmetric rank-one terms. In the eigenvectors' basis a term turns the matrix
into a diagonal plus ``z z'``; the new eigenvalues are the roots of the secular equation, found between
the old ones by rational interpolation. Entries with no weight and equal eigenvalues are deflated
first, and ``z`` is recomputed from the roots (Loewner's formula), which keeps the vectors orthogonal.

A block of rows is centred at its own mean and brought to triangular form; the triangle's rows are
the rank-one terms, and one more term accounts for the distance of the means. The terms
add up to exactly what the block's rows would, at one update per dimension instead of one per row.
Partitions' spectra are combined in the same way, a term per eigenvector, in a tree of groups. A last
pass projects all rows on the combined basis (Rayleigh-Ritz) and turns it by the small
matrix's eigenvectors, which gives the components to double precision.

A spectrum has ``d * d`` numbers for ``d`` dimensions and must fit a task; rows never meet in one place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import map_batches, map_groups

#: Entries become whole numbers: ``floor(SCALE * entry) + SHIFT``.
SCALE, SHIFT = 1024, 100_000
#: Components that are kept.
COMPONENTS = 8
#: Spectra that one task combines.
FAN = 16
#: Largest magnitude of an entry whose whole number a double holds exactly.
LARGEST = float(2**42)
EPS = np.finfo(float).eps


# --- Rank-one updates -------------------------------------------------------


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(weights / (poles - x))``, poles ascending and apart, weights positive.

    Returned are each root's nearest pole and its distance from it, which is exact where the root itself
    would lose digits.
    """
    k = len(poles)
    at = np.arange(k)
    gaps = np.append(np.diff(poles), weights.sum())
    middle = poles + gaps / 2
    left = 1 + (weights / (poles[None, :] - middle[:, None])).sum(axis=1) > 0
    left[-1] = True
    origin = np.where(left, at, np.minimum(at + 1, k - 1))
    half = np.where(at < k - 1, gaps / 2, gaps)
    low, high = np.where(left, 0.0, -half), np.where(left, half, 0.0)
    delta = poles[None, :] - poles[origin][:, None]
    own = delta[at, at]
    following = np.append(delta[at[:-1], at[1:]], np.inf)
    below = at[None, :] <= at[:, None]
    shift = (low + high) / 2
    for _ in range(80):
        apart = delta - shift[:, None]
        terms = weights / apart
        slopes = terms / apart
        psi = np.where(below, terms, 0.0).sum(axis=1)
        phi = terms.sum(axis=1) - psi
        value = 1 + psi + phi
        done = np.abs(value) <= EPS * k * (1 + np.abs(psi) + np.abs(phi))
        low, high = np.where(value < 0, shift, low), np.where(value > 0, shift, high)
        if done.all():
            break
        # Each side's sum is replaced by one pole at its near end, with the same value and slope.
        slope_left = np.where(below, slopes, 0.0).sum(axis=1)
        slope_right = slopes.sum(axis=1) - slope_left
        a, b = own - shift, following - shift
        b[-1] = 1.0  # no pole follows the last root
        p, q = slope_left * a * a, slope_right * b * b
        c = 1 + psi - slope_left * a + phi - slope_right * b
        linear, constant = c * (a + b) + p + q, a * b * value
        root = np.sqrt(np.maximum(linear * linear - 4 * c * constant, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(linear > 0, 2 * constant / (linear + root), (linear - root) / (2 * c))
            step[-1] = a[-1] + p[-1] / c[-1]
        new = shift + step
        new = np.where((new > low) & (new < high), new, (low + high) / 2)
        moved = np.where(done, shift, new)
        if np.all(np.abs(moved - shift) <= EPS * np.abs(shift)):
            break
        shift = moved
    return origin, shift


def rank_one(values: np.ndarray, vectors: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum (ascending values, vectors as columns) after adding ``term term'``."""
    z = vectors.T @ term
    weight = float(z @ z)
    if weight == 0.0:
        return values, vectors
    limit = 8 * EPS * max(float(values[-1]), weight)
    # Equal eigenvalues: a reflection among their vectors leaves one of them with all the weight.
    edges = np.flatnonzero(np.diff(values) > limit) + 1
    for group in np.split(np.arange(len(values)), edges):
        length = np.linalg.norm(z[group]) if len(group) > 1 else 0.0
        if length:
            mirror = z[group].copy()
            mirror[-1] += np.copysign(length, mirror[-1])
            vectors = vectors.copy()
            vectors[:, group] -= np.outer(vectors[:, group] @ mirror, mirror * (2 / (mirror @ mirror)))
            z[group[-1]] = -np.copysign(length, z[group[-1]])
            z[group[:-1]] = 0.0
    active = np.abs(z) * np.sqrt(weight) > limit
    if not active.any():
        return values, vectors
    poles, part = values[active], z[active]
    origin, shift = secular_roots(poles, part * part)
    k = len(poles)
    # Root j minus pole i, and the poles' own distances, both without cancellation.
    distance = shift[:, None] + (poles[origin][:, None] - poles[None, :])
    own = poles[:, None] - poles[None, :]
    behind = np.vstack([own[1:], np.ones(k)])
    at = np.arange(k)
    ratios = distance / np.where(at[:, None] < at[None, :], own, behind)
    z_new = np.copysign(np.sqrt(np.abs(ratios.prod(axis=0))), part)
    turn = z_new[:, None] / -distance.T
    turn /= np.linalg.norm(turn, axis=0)
    new_values, new_vectors = values.copy(), vectors.copy()
    new_values[active] = poles[origin] + shift
    new_vectors[:, active] = vectors[:, active] @ turn
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_vectors[:, order]


@dataclass
class Spectrum:
    """Rows read so far: their number, exact sums, and the eigenvalues and vectors of their scatter about their mean."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dimensions: int) -> Spectrum:
        return cls(0, np.zeros(dimensions, np.int64), np.zeros(dimensions), np.eye(dimensions))

    def add(self, n: int, sums: np.ndarray, terms: np.ndarray) -> None:
        """Take in ``n`` rows with these sums, whose scatter about their mean is the sum of ``t t'`` over ``terms``."""
        for term in terms:
            self.values, self.vectors = rank_one(self.values, self.vectors, term)
        if self.n:
            apart = centred(sums[None, :], n * self.sums, self.n)[0] / n
            term = apart * np.sqrt(self.n * (n / (self.n + n)))
            self.values, self.vectors = rank_one(self.values, self.vectors, term)
        self.n, self.sums = self.n + n, self.sums + sums

    def add_rows(self, rows: np.ndarray) -> None:
        """Take in a block of whole-number rows."""
        sums = rows.sum(axis=0)
        terms = centred(rows, sums, len(rows))
        if len(rows) > rows.shape[1]:
            terms = np.linalg.qr(terms, mode="r")
        self.add(len(rows), sums, terms)

    def add_spectrum(self, other: Spectrum) -> None:
        used = other.values > 0
        self.add(other.n, other.sums, (other.vectors[:, used] * np.sqrt(other.values[used])).T)


def centred(rows: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """``rows - sums / n``, with the whole part taken off before anything is rounded."""
    whole, rest = np.divmod(sums, n)
    return (rows - whole).astype(float) - rest.astype(float) / n


# --- Rows -------------------------------------------------------------------


def whole_rows(column: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the usable vectors of a list column, and their entries as whole numbers."""
    if len(column) == 0:
        return np.zeros(0, np.int64), np.zeros((0, dimensions), np.int64)
    offsets = column.offsets.to_numpy()
    fits = (np.diff(offsets) == dimensions) & np.asarray(column.is_valid())
    at = np.flatnonzero(fits)
    entries = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    matrix = entries[offsets[:-1][at][:, None] + np.arange(dimensions)]
    finite = np.isfinite(matrix).all(axis=1)
    at, matrix = at[finite], matrix[finite]
    if matrix.size and np.abs(matrix).max() > LARGEST:
        raise ValueError(f"An embedding's entry is beyond {LARGEST:.0f}, so that it has no exact whole number.")
    return at, np.floor(SCALE * matrix).astype(np.int64) + SHIFT


def _sums_schema(*more: str) -> str:
    return ", ".join(["part long", "n long", *more])


def _spectrum_row(part: int, s: Spectrum) -> pa.RecordBatch:
    arrays = {"part": [part], "n": [s.n], "sums": [s.sums.tobytes()], "values": [s.values.tobytes()], "vectors": [s.vectors.tobytes()]}
    return pa.record_batch(arrays)


def _read_spectrum(row: dict) -> Spectrum:
    values = np.frombuffer(row["values"])
    size = len(values)
    return Spectrum(row["n"], np.frombuffer(row["sums"], np.int64), values, np.frombuffer(row["vectors"]).reshape(size, size))


def _spectra(dimensions: int) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum = Spectrum.empty(dimensions)
        for batch in batches:
            _, rows = whole_rows(batch.column(0), dimensions)
            if len(rows):
                spectrum.add_rows(rows)
        if spectrum.n:
            yield _spectrum_row(TaskContext.get().partitionId(), spectrum)

    return read


def _combine_spectra(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda row: row["part"])
    first, *others = map(_read_spectrum, rows)
    for other in others:
        first.add_spectrum(other)
    return pa.Table.from_batches([_spectrum_row(rows[0]["part"] // FAN, first)])


def _moments(project: Callable[[np.ndarray], np.ndarray], dimensions: int) -> Callable:
    """Per partition the sums of the projected rows and of their products."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, 0.0, 0.0
        for batch in batches:
            _, rows = whole_rows(batch.column(0), dimensions)
            projected = project(rows)
            n, total, products = n + len(rows), total + projected.sum(axis=0), products + projected.T @ projected
        if n:
            part = TaskContext.get().partitionId()
            yield pa.record_batch({"part": [part], "n": [n], "total": [total.tobytes()], "products": [products.tobytes()]})

    return read


def _combine_moments(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda row: row["part"])
    out = {"part": [rows[0]["part"] // FAN], "n": [sum(row["n"] for row in rows)]}
    out |= {c: [sum(np.frombuffer(row[c]) for row in rows).tobytes()] for c in ("total", "products")}
    return pa.table(out)


def _reduced(rows: DataFrame, combine: Callable) -> dict | None:
    """One row out of a row per partition, in rounds of ``FAN`` rows a task; None if there is none."""
    rows = stage(rows, "parts")
    count, last = rows.agg(F.count("*"), F.max("part")).first()
    while count > 1:
        grouped = rows.withColumn("group", F.expr(f"part div {FAN}"))
        rows = stage(map_groups(grouped, "group", _ungrouped(combine), rows.schema), "parts")
        last //= FAN
        count = last + 1
    found = rows.first()
    return found and found.asDict()


def _ungrouped(combine: Callable) -> Callable:
    return lambda table: combine(table.drop_columns(["group"]))


# --- The operator -----------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: components as columns, by falling eigenvalue.

    ``sums`` over ``n`` is the mean. ``explained`` are the eigenvalues' shares of the whole variance,
    ``identity_error`` the largest entry of the whitened fit rows' covariance minus the identity.
    """

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float

    def project(self, rows: np.ndarray) -> np.ndarray:
        return centred(rows, self.sums, self.n) @ self.components / np.sqrt(self.eigenvalues)


def _covariance(moments: dict, size: int) -> np.ndarray:
    mean = np.frombuffer(moments["total"]) / moments["n"]
    return np.frombuffer(moments["products"]).reshape(size, size) / moments["n"] - np.outer(mean, mean)


def dimensions_of(vectors: DataFrame, column: str) -> int:
    """The commonest length of a vector, the greater of equally common ones; 0 without vectors."""
    size = F.size(column)
    sizes = vectors.where(F.col(column).isNotNull()).groupBy(size.alias("size")).agg(F.count("*").alias("n"))
    found = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return found["size"] if found else 0


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Whitening of all usable rows; None where they have no variance.

    Null vectors and those with a null or non-finite entry are left out, as are vectors of another
    length than the commonest. Repeated rows count as often as they occur. Directions without variance
    (up to rounding) are no components, so fewer than ``components`` may be found. Entries beyond
    ``LARGEST`` fail.
    """
    dimensions = dimensions_of(vectors, column)
    if not dimensions:
        return None
    slim = vectors.select(F.col(column).cast("array<double>").alias("v"))
    schema = _sums_schema("sums binary", "values binary", "vectors binary")
    found = _reduced(map_batches(slim, _spectra(dimensions), schema), _combine_spectra)
    if found is None:
        return None
    spectrum = _read_spectrum(found)
    n, sums = spectrum.n, spectrum.sums
    basis = np.linalg.qr(spectrum.vectors[:, ::-1])[0]
    schema = _sums_schema("total binary", "products binary")

    def on_basis(rows: np.ndarray) -> np.ndarray:
        return centred(rows, sums, n) @ basis

    moments = _reduced(map_batches(slim, _moments(on_basis, dimensions), schema), _combine_moments)
    values, turn = np.linalg.eigh(_covariance(moments, dimensions))
    values, turn = values[::-1], turn[:, ::-1]
    kept = int((values[:components] > values[0] * dimensions * EPS).sum()) if values[0] > 0 else 0
    if not kept:
        return None
    shares = values[:kept] / values.sum()
    model = Whitening(n, sums, basis @ turn[:, :kept], values[:kept], shares, 0.0)
    moments = _reduced(map_batches(slim, _moments(model.project, dimensions), schema), _combine_moments)
    error = float(np.abs(_covariance(moments, kept) - np.eye(kept)).max())
    return Whitening(n, sums, model.components, model.eigenvalues, shares, error)


def deviations(rows: np.ndarray, sums: np.ndarray, n: int) -> list[int]:
    """Exact sum over the dimensions of ``(n * row - sums) ** 2``."""
    whole, rest = np.divmod(sums, n)
    apart = rows - whole
    largest = n * (int(np.abs(apart).max(initial=0)) + 1)
    if largest * largest * rows.shape[1] < 2**63:
        apart = n * apart - rest
        return (apart * apart).sum(axis=1).tolist()
    exact = n * apart.astype(object) - rest.astype(object)
    return (exact * exact).sum(axis=1).tolist()


def whitened(vectors: DataFrame, model: Whitening | None, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Per usable row its ``key``, ``deviation``, ``deviation_text`` and ``whitened``, an array of a number per component.

    Rows are left out as in ``fit``. ``deviation`` is null where the exact number, in ``deviation_text``,
    is too large for a long. A null key stays null, and rows may share one. Without a model, or on an
    empty table, there are no rows. Other columns don't travel.
    """
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, deviation long, deviation_text string, whitened array<double>"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dimensions = len(model.sums)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = whole_rows(batch.column(1), dimensions)
            exact = deviations(rows, model.sums, model.n)
            numbers = model.project(rows)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * numbers.shape[1]
            columns = [
                batch.column(0).take(pa.array(at)),
                pa.array([x if x < 2**63 else None for x in exact], pa.int64()),
                pa.array(map(str, exact), pa.string()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers.ravel())),
            ]
            yield pa.RecordBatch.from_arrays(columns, [key, "deviation", "deviation_text", "whitened"])

    slim = vectors.select(F.col(key), F.col(column).cast("array<double>"))
    return map_batches(slim, project, schema)
