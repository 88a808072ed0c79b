import math

import numpy as np
import pytest

from tokenmill.llm.whitening import Whitening, WhiteningSettings, exact_squares, leading

VECTORS = "vec_id long, embedding array<float>, label int"


def model(vectors, components=8):
    """Whole numbers, deviations, eigenvalues and projections by a dense decomposition."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    own = np.array([[(n * c - s) / n for c, s in zip(row, sums, strict=True)] for row in x])
    values, turn = np.linalg.eigh(own.T @ own / n)
    values, turn = values[::-1][:components], turn[:, ::-1][:, :components]
    return deviation, values, own @ turn / np.sqrt(values), np.trace(own.T @ own / n)


def compared(whitening, vectors, ids, components=8):
    deviation, values, white, trace = model(vectors, components)
    rows = whitening.report().collect()
    assert len(rows) == len(ids) * len(values)
    place = {v: i for i, v in enumerate(ids)}
    got = np.zeros_like(white)
    for row in rows:
        assert row.n == len(ids)
        assert int(row.deviation) == deviation[place[row.vec_id]]
        assert row.explained == pytest.approx(values[row.component - 1] / trace, rel=1e-9)
        assert row.identity_error < 1e-9
        got[place[row.vec_id], row.component - 1] = row.whitened
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got * signs - white).max() < 1e-6


def test_sample_equals_a_dense_decomposition(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [r for r in table.collect() if r.embedding is not None]
    rows = [r for r in rows if all(c is not None and math.isfinite(c) for c in r.embedding)]
    compared(Whitening(table.repartition(3)), [r.embedding for r in rows], [r.vec_id for r in rows])


def test_rows_that_are_dropped(spark):
    draws = np.random.default_rng(3)
    good = [[float(c) for c in row] for row in draws.standard_normal((40, 12)).astype("f4")]
    bad = [None, [], [float("nan")] * 12, [None] + [1.0] * 11, [float("inf")] * 12, [1.0] * 5]
    rows = [(i, v, None) for i, v in enumerate(good)]
    rows += [(100 + i, v, 1) for i, v in enumerate(bad)]
    table = spark.createDataFrame(rows, VECTORS).withColumnsRenamed({"label": "key"})
    compared(Whitening(table), good, list(range(40)))


def test_repeated_rows_and_null_keys(spark):
    rows = [(None, [float(i % 3), 1.0, 2.0 * (i % 2)], 1) for i in range(12)]
    rows += [(5, [3.0, 1.0, 1.0], 1)] * 2
    found = Whitening(spark.createDataFrame(rows, VECTORS))
    assert len(found.values) == 2  # the second entry never changes
    assert found.report().count() == 28
    assert found.identity_error < 1e-9


def test_tables_without_variance(spark):
    assert Whitening(spark.createDataFrame([], VECTORS)).report().collect() == []
    one = spark.createDataFrame([(1, [1.0, 2.0], 1)] * 3, VECTORS)
    assert Whitening(one).report().collect() == []
    assert Whitening(one).transformed().count() == 3


def test_many_tasks_are_added_in_groups(spark, monkeypatch):
    monkeypatch.setattr("tokenmill.llm.whitening.FEW_TASKS", 2)
    draws = np.random.default_rng(4)
    vectors = [[float(c) for c in v] for v in (draws.standard_normal((90, 20)) * range(20)).astype("f4")]
    table = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], VECTORS)
    compared(Whitening(table.repartition(7)), vectors, list(range(90)))


@pytest.mark.parametrize("spectrum", ["flat", "steep", "low rank", "clustered"])
def test_iteration_on_known_spectra(spectrum):
    draws = np.random.default_rng(1)
    dims = 120
    values = {
        "flat": np.linspace(2, 1, dims),
        "steep": 0.5 ** np.arange(dims),
        "low rank": np.r_[np.arange(10, 0, -1), np.zeros(dims - 10)],
        "clustered": np.r_[np.linspace(9, 8.9, 8), np.ones(dims - 8)],
    }[spectrum]
    turn = np.linalg.qr(draws.standard_normal((dims, dims)))[0]
    dense = (turn * values) @ turn.T
    passes = []

    def product(block):
        passes.append(block.shape)
        return dense @ block

    found, vectors, residuals = leading(product, dims, WhiteningSettings())
    assert np.allclose(found, values[:8], rtol=1e-10)
    assert np.abs(np.abs((vectors * turn[:, :8]).sum(axis=0)) - 1).max() < 1e-9
    assert len(passes) < 500


def test_squares_beyond_64_bits():
    rows = np.array([[2**40, -(2**41)], [1, 2]], np.int64)
    assert exact_squares(rows) == [2**80 + 2**82, 5]
