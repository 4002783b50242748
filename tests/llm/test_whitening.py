import numpy as np
import pytest

from accountpulse.llm import whitening
from accountpulse.llm.common import table
from accountpulse.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, v long, part long, deviation string"


def usable(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]


def expected(rows, components=8):
    """Plain numpy: whole numbers, covariance about the mean, eigenvectors."""
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in r[1]] for r in usable(rows)])
    n, total = len(x), x.sum(axis=0)
    gap = x - total / n
    values, vectors = np.linalg.eigh(gap.T @ gap / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = min(components, int((values > values[0] * len(values) * 1e-15).sum()))
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total)) for row in x]
    return n, exact, gap @ vectors[:, :kept] / np.sqrt(values[:kept]), values[:kept] / values.sum()


def compare(found, rows):
    n, exact, numbers, shares = expected(rows)
    by = {}
    for r in found:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    assert len(found) == numbers.size
    ids = [r[0] for r in usable(rows)]
    signs = None
    for i, k in enumerate(ids):
        line = np.array([by[k][c + 1]["whitened"] for c in range(numbers.shape[1])])
        signs = np.sign(line * numbers[i]) if signs is None else signs
        assert np.allclose(line, numbers[i] * signs, rtol=0, atol=1e-8)
        first = by[k][1]
        assert first["n"] == n and first["deviation"] == exact[i] and first["identity_error"] < 1e-9
    for c, share in enumerate(shares):
        assert by[ids[0]][c + 1]["explained"] == pytest.approx(share, rel=1e-9)


def test_query_against_numpy(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, FOLDER, "embeddings").collect()]
    compare(QUERIES["op11_whitening"](spark, FOLDER).collect(), rows)


def test_many_parts_and_unusable_rows(spark, tmp_path):
    pick = np.random.default_rng(4)
    rows = [(i, [float(x) for x in pick.normal(size=5) * [1, 2, 3, 4, 5]], i, 0, "x") for i in range(150)]
    rows += [(150, None, 0, 0, "x"), (151, [1.0, None, 0.0, 0.0, 0.0], 0, 0, "x"), (152, [float("nan")] * 5, 0, 0, "x")]
    rows += [(153, [float("inf"), 0.0, 0.0, 0.0, 0.0], 0, 0, "x"), (154, [1.0], 0, 0, "x"), (155, [], 0, 0, "x")]
    rows += [(200 + i, rows[7][1], None, 0, None) for i in range(90)]
    spark.createDataFrame(rows, SCHEMA).repartition(40).write.parquet(f"{tmp_path}/embeddings.parquet")
    compare(QUERIES["op11_whitening"](spark, str(tmp_path)).collect(), [r for r in rows if r[0] not in (154, 155)])


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (None, [0.5, 0.5])]])
def test_without_variance(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    model = whitening.fit(frame)
    assert model is None and whitening.whitened(frame, model).collect() == []


def test_fewer_directions_than_components(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0]) for i in range(20)] + [(None, [3.0, 6.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    model = whitening.fit(frame)
    found = whitening.whitened(frame, model).collect()
    assert len(found) == 21 and {len(r["whitened"]) for r in found} == {1}
    assert model.explained[0] == pytest.approx(1.0) and model.identity_error < 1e-9


def test_exact_deviations_beyond_a_long():
    rows, n = np.array([[100_000 + 3_000_000, 100_000]]), 10**7
    sums = np.array([100_000 * n + 7, 100_000 * n - 9])
    assert whitening.deviations(rows, sums, n) == [(n * 3_000_000 - 7) ** 2 + 9**2]


@pytest.mark.parametrize("seed", range(6))
def test_rank_one_updates(seed):
    """Against a full decomposition, with equal eigenvalues, missing weights and tiny terms."""
    pick = np.random.default_rng(seed)
    size = int(pick.integers(1, 30))
    spectrum, matrix = whitening.Spectrum.empty(size), np.zeros((size, size))
    values, vectors = spectrum.values, spectrum.vectors
    for step in range(60):
        term = pick.normal(size=size) * 10.0 ** pick.integers(-9, 4)
        if step % 3 == 1:
            term[pick.integers(size)] = 0.0
        if step % 5 == 2:
            term = vectors[:, pick.integers(size)] * 2.0
        matrix += np.outer(term, term)
        values, vectors = whitening.rank_one(values, vectors, term)
        assert np.all(np.diff(values) >= 0)
    scale = max(values[-1], 1.0)
    assert np.abs(values - np.linalg.eigvalsh(matrix)).max() < 1e-12 * scale
    assert np.abs((vectors * values) @ vectors.T - matrix).max() < 1e-12 * scale
    assert np.abs(vectors.T @ vectors - np.eye(size)).max() < 1e-11
