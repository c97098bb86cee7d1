import numpy as np
import pytest
from pyspark.sql import functions as F

from perptide.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, component int, deviation string, whitened int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x", 1) for i, v in rows], SCHEMA).repartition(3)


def dense(rows, components=32):
    x = np.floor(64 * np.array(rows, float)) + 1_000_000
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return x, values, (x - x.mean(axis=0)) @ vectors / np.sqrt(values)


def found(df, model):
    rows = whitening.whitened(df, model, keep=["vec_id"]).orderBy("vec_id").collect()
    return [r["vec_id"] for r in rows], [r["deviation"] for r in rows], np.array([r["whitened"] for r in rows])


@pytest.mark.parametrize(("n", "dim", "components"), [(200, 6, 4), (300, 40, 32), (60, 5, 32)])
def test_same_as_a_dense_solver(spark, n, dim, components):
    rng = np.random.default_rng(n)
    rows = rng.standard_normal((n, dim)) @ rng.standard_normal((dim, dim)) + 3
    df = table(spark, [(i, v.tolist()) for i, v in enumerate(rows)])
    model = whitening.fit(df, components=components)
    x, values, expected = dense(rows, components)
    ids, deviations, got = found(df, model)
    assert ids == list(range(n)) and model.n == n
    assert np.allclose(model.values, values, rtol=1e-12)
    assert np.abs(np.abs(got) - np.abs(expected)).max() < 1e-8
    sums = [int(s) for s in x.sum(axis=0)]
    assert model.sums == sums
    assert deviations == [sum((n * int(c) - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    assert whitening.identity_error(df, model) < 1e-9


def test_rows_that_take_no_part_and_repeated_rows(spark):
    rows = [[1.0, 2.0], [3.0, -1.0], [0.5, 0.25], [2.0, 2.0], [2.0, 2.0]]
    bad = [None, [], [1.0, None], [float("nan"), 1.0], [1.0, float("inf")], [1e300, 0.0], [1.0, 2.0, 3.0]]
    df = table(spark, [*enumerate(rows), *((90 + i, v) for i, v in enumerate(bad)), (4, rows[4])])
    model = whitening.fit(df)
    ids, _, got = found(df, model)
    assert ids == [0, 1, 2, 3, 4, 4] and model.n == 6
    _, _, expected = dense([*rows, rows[4]])
    assert np.abs(np.abs(got) - np.abs(expected)).max() < 1e-9


def test_no_variance_gives_no_rows(spark):
    for rows in ([], [(1, [2.0, 3.0])], [(1, [2.0, 3.0]), (2, [2.0, 3.0])], [(1, None)]):
        df = table(spark, rows)
        model = whitening.fit(df)
        assert whitening.identity_error(df, model) is None
        out = whitening.whitened(df, model, keep=["vec_id"])
        assert out.select("vec_id", F.explode("whitened")).count() == 0


def test_deviation_beyond_64_bits_is_null(spark):
    df = table(spark, [(1, [2.0**40, 1.0]), (2, [0.0, 2.0]), (3, [1.0, 5.0])])
    model = whitening.fit(df)
    x = [[int(64 * c) + 1_000_000 for c in v] for v in ([2.0**40, 1.0], [0.0, 2.0], [1.0, 5.0])]
    sums = [sum(c) for c in zip(*x, strict=True)]
    exact = [sum((3 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    assert model.sums == sums
    assert found(df, model)[1] == [v if v < 1 << 63 else None for v in exact]


@pytest.mark.parametrize(
    "values",
    [[5, 5, 5, 3, 3, 1, 1e-3 + 1e-9, 1e-3], [1] * 12, [1, 1 - 1e-8, 1 - 2e-7, 0.5, 0.5 - 1e-13, 0.2], [1, 0, 0], [0, 0]],
)
def test_equal_and_close_eigenvalues(spark, values):
    values = np.array(values, float)
    turned, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((len(values), len(values))))
    matrix = (turned * values) @ turned.T
    matrix = (matrix + matrix.T) / 2
    got, vectors = whitening.leading(spark, matrix)
    assert len(got) == (values > 0).sum()
    assert np.allclose(got, values[values > 0], rtol=0, atol=1e-14)
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max(initial=0) < 1e-9
    assert np.abs(matrix @ vectors - vectors * got).max(initial=0) < 1e-14


def test_inertia_counts():
    rng = np.random.default_rng(5)
    for size in (1, 2, 3, 8, 25):
        matrix = rng.standard_normal((size, size))
        matrix = matrix + matrix.T
        if size == 8:
            np.fill_diagonal(matrix, 0)
        values = np.linalg.eigvalsh(matrix)
        for shift in [0.0, *rng.uniform(-4, 4, 10)]:
            assert whitening.above(matrix, shift) == (values > shift).sum()
    assert whitening.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert whitening.above(np.zeros((3, 3)), 0.0) == 0


def test_moments_merge_in_any_split():
    rng = np.random.default_rng(9)
    x = rng.integers(-(1 << 50), 1 << 50, (50, 3))
    total = None
    for part in np.split(x, [1, 7, 30]):
        one = whitening.Moments.of(part.astype(float), part)
        if total is None:
            total = one
        else:
            total.add(one)
    assert [(int(h) << 31) + int(w) for h, w in zip(total.high, total.low, strict=True)] == x.sum(axis=0).tolist()
    assert np.allclose(total.squares / 50, np.cov(x.T.astype(float), bias=True), rtol=1e-12)
