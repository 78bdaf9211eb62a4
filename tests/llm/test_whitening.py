import math

import numpy as np
import pytest

from touchline.llm import whitening
from touchline.llm.feast import above, feast, inertia, leading, slices

SCHEMA = "vec_id long, embedding array<float>, deviation string, n int, lang string"
FOLDER = "/root/testdata/sf0.001"


def brute(vectors: list[list[float]], components: int = 16):
    """Means, eigenvalues and eigenvectors of the distinct whole-number vectors, in exact sums."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    distinct = sorted(set(map(tuple, x)))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    whole = np.array([[n * c - s for c, s in zip(v, sums)] for v in distinct], dtype=object)
    covariance = (whole.T @ whole / n**3).astype(float)
    values, found = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    return n, deviations, centred @ found[:, order] / np.sqrt(values[order]), values[order] / np.trace(covariance)


def test_query_equals_brute_force(spark):
    from touchline.llm.queries import op13_whitening

    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviations, whitened, explained = brute([r["embedding"] for r in rows])
    got = op13_whitening(spark, FOLDER).orderBy("vec_id", "component").collect()
    assert len(got) == 16 * len(rows)
    assert [r["component"] for r in got[:16]] == list(range(1, 17))
    found = np.array([r["whitened"] for r in got]).reshape(-1, 16)
    signs = np.sign((found * whitened).sum(axis=0))
    assert np.abs(found * signs - whitened).max() < 1e-9
    assert [r["deviation"] for r in got[::16]] == deviations
    assert np.allclose([r["explained"] for r in got[:16]], explained, rtol=1e-9)
    assert {r["n"] for r in got} == {n}
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9


def fitted(spark, rows, components=16):
    numbers = whitening.whole_numbers(spark.createDataFrame(rows, SCHEMA).repartition(3))
    distinct, length = whitening.distinct_vectors(numbers)
    model = whitening.fit(distinct, length, components)
    return model, whitening.identity_error(distinct, model), whitening.whiten(numbers, model)


def row(i, vector):
    return i, vector, "x", 1, "en"


def test_rows_without_usable_vectors_have_no_result(spark):
    drawn = np.random.default_rng(2)
    vectors = drawn.normal(size=(40, 3)).astype(np.float32).tolist()
    bad = [None, [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 0.0, 0.0], [3e38, 0.0, 0.0], [1.0], [1.0, 2.0], []]
    rows = [row(i, v) for i, v in enumerate(vectors + vectors[:9])] + [row(None, vectors[0]), row(7, vectors[0])]
    model, error, done = fitted(spark, rows + [row(100 + i, v) for i, v in enumerate(bad)])
    assert done.columns == ["vec_id", "embedding", "n", "lang", "deviation", "whitened"]
    got = done.collect()
    assert len(got) == len(rows) and error < 1e-9
    n, deviations, whitened, _ = brute([r[1] for r in rows])
    assert model.n == n == 40 and len(model.eigenvalues) == 3
    by_vector = {tuple(r[1]): (d, w) for r, d, w in zip(rows, deviations, whitened)}
    for r in got:
        deviation, want = by_vector[tuple(r["embedding"])]
        assert r["deviation"] == deviation
        assert np.allclose(np.abs(r["whitened"]), np.abs(want), atol=1e-9)


@pytest.mark.parametrize("rows", [[], [row(1, None)], [row(1, [])], [row(1, [1.0, 2.0])], [row(1, [1.0]), row(2, [1.0])]])
def test_too_few_vectors_have_no_components(spark, rows):
    model, error, done = fitted(spark, rows)
    assert len(model.eigenvalues) == 0 and error is None
    assert all(r["whitened"] == [] for r in done.collect())


def test_constant_dimensions_and_large_numbers(spark):
    drawn = np.random.default_rng(4)
    rows = [row(i, [1.0, float(a), float(a), 1e12]) for i, a in enumerate(drawn.normal(size=30) * 100)]
    model, error, done = fitted(spark, rows)
    assert len(model.eigenvalues) == 1 and error < 1e-6 and model.explained[0] == pytest.approx(1, rel=1e-9)
    wide = [row(i, [float(c) for c in v]) for i, v in enumerate(drawn.normal(size=(30, 2)) * 1e15)]
    deviations = brute([np.float32(r[1]).tolist() for r in wide])[1]
    _, error, done = fitted(spark, wide)
    assert error < 1e-6
    got = {r["vec_id"]: r["deviation"] for r in done.collect()}
    assert [got[i] for i in range(30)] == [None if d >= 2**63 else d for d in deviations]


def spectra():
    drawn = np.random.default_rng(6)
    turn, _ = np.linalg.qr(drawn.standard_normal((40, 40)))
    plain = drawn.standard_normal((200, 40))
    yield plain.T @ plain / 200
    for values in (np.repeat([3.0, 1.0], 20), 0.5 ** np.arange(40), np.repeat([9.0, 8.0, 7.0, 6.0, 5.0], 8), np.r_[5.0, 4.9999999, np.zeros(38)]):
        yield turn @ np.diag(values) @ turn.T
    yield from (np.eye(20), np.diag([2.0]), np.diag([5.0] * 3 + [0.0] * 10))


@pytest.mark.parametrize("at", range(8))
def test_leading_components(at):
    matrix = list(spectra())[at]
    matrix = (matrix + matrix.T) / 2
    values, vectors = leading(matrix, 16)
    want = np.linalg.eigvalsh(matrix)[::-1]
    assert len(values) == min(16, (want > 1e-10 * want.sum()).sum())
    assert np.allclose(values, want[: len(values)], rtol=1e-12, atol=1e-13 * want[0])
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-8)
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-11 * want[0]


def test_inertia_counts_and_slices():
    drawn = np.random.default_rng(8)
    for n in (1, 2, 3, 10, 33):
        a = drawn.standard_normal((n, n))
        assert inertia(a + a.T) == (np.linalg.eigvalsh(a + a.T) > 0).sum()
    assert inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1 and inertia(np.zeros((2, 2))) == 0
    matrix = np.diag(np.arange(1.0, 31.0))
    parts = slices(matrix, 16, 31.0, 1e-9, 8)
    assert sum(n for _, _, n in parts) >= 16 and parts[0][1] == 31.0
    for low, high, count in parts:
        assert above(matrix, low) - above(matrix, high) == count
        assert sorted(feast(matrix, low, high, count)[0].round(9)) == [v for v in range(1, 31) if low < v < high]
