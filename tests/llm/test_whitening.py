"""Whitening against plain eigenvectors and exact arithmetic, inertia counts and awkward tables."""

import math

import numpy as np
import pytest

from shelfpair.llm import queries
from shelfpair.llm.whitening import count_above, fit, largest_eigenpairs, products, whiten
from tests.conftest import SMALL


def spectrum(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    matrix = q * np.array(values) @ q.T
    return (matrix + matrix.T) / 2


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1, 0.5], [1] * 12, [1e6, 1, 1 - 1e-9, 1e-3, 1e-6], [3, 0, 0], [0, 0], [7], list(np.linspace(1, 2, 70)), [2.0] * 40 + [1.0] * 5])
def test_largest_eigenpairs(values):
    matrix = spectrum(values)
    got, vectors = largest_eigenpairs(matrix, 8)
    want = np.linalg.eigvalsh(matrix)[::-1][: len(got)]
    assert len(got) == min(8, sum(v > 0 for v in values))
    norm = max(values)
    assert np.allclose(got, want, atol=1e-13 * norm, rtol=0)
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max(initial=0) < 1e-12
    assert np.abs(matrix @ vectors - vectors * got).max(initial=0) <= 1e-12 * norm


def test_inertia():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 10, 40):
        for _ in range(20):
            a = rng.integers(-3, 4, (d, d)).astype(float)
            a += a.T
            shift = rng.uniform(-5, 5)
            assert count_above(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()
    assert count_above(np.array([[0.0, 1], [1, 0]]), 0) == 1  # no usable pivot on the diagonal


def test_products_are_exact():
    rng = np.random.default_rng(2)
    for most in (10, 2**20, 2**30, 2**50):
        rows = rng.integers(-most, most, (50, 3))
        assert (products(rows) == rows.astype(object).T @ rows.astype(object)).all()


def brute(rows, components=8):
    """vec_id to (deviation, whitened rows), by plain numpy; explained shares."""
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(1024 * float(e)) + 100_000 for e in v] for _, v in good], object)
    n, sums = len(x), x.sum(axis=0)
    centred = (x - sums / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviations = [(i, int(sum((n * a - s) ** 2 for a, s in zip(row, sums)))) for (i, _), row in zip(good, x)]
    return n, deviations, centred @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def check(rows, got, components=8):
    n, deviations, whitened, explained = brute(rows, components)
    table = {}
    for r in got:
        assert r.n == n and r.identity_error <= 1e-4 and abs(r.explained - explained[r.component - 1]) < 1e-10
        table.setdefault((r.vec_id, r.deviation), {})[r.component] = r.whitened
    assert sorted((i, d) for i, d in deviations) == sorted({(i, d) for i, d in table}) and len(got) == n * len(explained)
    mine = np.array([[table[key][k + 1] for k in range(len(explained))] for key in deviations])
    signs = np.sign((mine * whitened).sum(axis=0))
    assert np.abs(mine - whitened * signs).max() < 1e-8


def test_whole_table(spark, duck):
    rows = duck.execute("select vec_id, embedding from embeddings").fetchall()
    check(rows, queries.op12_whitening(spark, SMALL).collect())


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(k, list(map(float, rng.standard_normal(5) * [3, 2, 1, 0.5, 0.1]))) for k in range(40)]
    odd = [(50, None), (51, [None, 1.0, 1.0, 1.0, 1.0]), (52, [math.nan] + [0.0] * 4), (53, [math.inf] + [0.0] * 4), (54, []), (None, [0.0] * 5)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "1 as n", "2 as d").repartition(3)
    got = whiten(frame).collect()
    assert {r.vec_id for r in got} == {*range(40), None} and len(got) == 41 * 5 and got[0].identity_error < 1e-9
    check(rows, whiten(frame.where("vec_id < 40")).collect())
    assert whiten(frame.limit(0)).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<double>")
    assert whiten(same).count() == 0  # no variance
    mixed = frame.where("vec_id < 40").unionByName(spark.createDataFrame([(90 + k, [float(k), 1.0]) for k in range(4)], "vec_id long, embedding array<double>"), allowMissingColumns=True)
    assert {(r.vec_id >= 90, r.n) for r in whiten(mixed).collect()} == {(False, 40), (True, 4)}


def test_result_does_not_depend_on_partitions(spark):
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    one, many = fit(frame.coalesce(1))[64], fit(frame.repartition(7))[64]
    assert (one.values == many.values).all() and (one.vectors == many.vectors).all() and one.trace == many.trace


def test_deviation_beyond_64_bits_is_null(spark):
    frame = spark.createDataFrame([(1, [1e12, 1.0]), (2, [-1e12, 2.0]), (3, [0.0, 4.0])], "vec_id long, embedding array<double>")
    got = whiten(frame).collect()
    assert {r.vec_id: r.deviation is None for r in got} == {1: True, 2: True, 3: False}
