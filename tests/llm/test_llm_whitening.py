"""Whitening and its solver against dense linear algebra."""

import math

import brute
import numpy as np
import pytest
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st

from tierloom.llm import bidiagonal, whitening
from tierloom.llm.queries import QUERIES


def turned(values, seed=0):
    random = np.random.default_rng(seed)
    left, right = (np.linalg.qr(random.standard_normal((len(values), len(values))))[0] for _ in range(2))
    return left @ np.diag(values) @ right


MATRICES = {
    "dense": np.random.default_rng(1).standard_normal((64, 64)),
    "graded": np.triu(np.random.default_rng(2).standard_normal((64, 64))) * np.logspace(0, -12, 64),
    "few rows": np.random.default_rng(3).standard_normal((5, 64)),
    "tall": np.random.default_rng(4).standard_normal((200, 12)),
    "all equal": np.eye(40),
    "clusters": turned([10.0] * 3 + [9.0] * 2 + [8 - 1e-9, 8.0] + list(np.linspace(5, 1, 30))),
    "low rank": turned([1.0] * 20 + [0.0] * 20),
    "zeros on the diagonal": np.diag([3.0, 0, 2, 0, 1]),
    "one": np.array([[2.0]]),
}


@pytest.mark.parametrize("name", MATRICES)
def test_directions(name):
    matrix = MATRICES[name]
    values, directions = bidiagonal.leading_directions(matrix, 16)
    exact = np.linalg.svd(matrix, compute_uv=False)
    rank = int((exact > 1e-13 * exact[0]).sum())
    assert len(values) == min(16, rank)
    assert np.allclose(np.sqrt(values), exact[: len(values)], rtol=1e-11, atol=0)
    assert np.abs(directions.T @ directions - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix.T @ (matrix @ directions) - directions * values).max() < 1e-13 * exact[0] ** 2 * len(exact)
    at = np.abs(directions).argmax(axis=0)
    assert (directions[at, range(len(values))] > 0).all()


def test_small_singular_values_keep_their_digits():
    """A bidiagonal matrix with known determinant: dqds finds all values, each with its own digits."""
    a, b = np.logspace(0, -30, 16), np.logspace(0, -30, 16)[:-1] * 0.5
    values = bidiagonal.squared_singular_values(a, b)
    assert math.isclose(sum(map(math.log, values)), 2 * float(np.log(a).sum()), rel_tol=1e-13)
    assert values[-1] > 0 and values == sorted(values, reverse=True)


def test_nothing():
    for empty in (np.zeros((4, 4)), np.zeros((0, 3)), np.zeros((0, 0))):
        assert len(bidiagonal.leading_directions(empty, 16)[0]) == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.floats(0, 4), min_size=2, max_size=9), st.data())
def test_values_of_any_bidiagonal_matrix(a, data):
    b = data.draw(st.lists(st.floats(0, 4), min_size=len(a) - 1, max_size=len(a) - 1))
    exact = np.linalg.svd(np.diag(a) + np.diag(b, 1), compute_uv=False)
    found = np.sqrt(bidiagonal.squared_singular_values(np.array(a), np.array(b)))
    assert np.allclose(found, exact, atol=1e-12)


def compare(report, rows, count=whitening.COMPONENTS):
    x, n, sums, values, directions, trace = brute.whitening([v for _, v in rows], count)
    found = {}
    for r in report.collect():
        found.setdefault((r["vec_id"], r["component"]), r)
    want = (x - sums / n) @ directions / np.sqrt(values)
    assert {k for _, k in found} == set(range(1, len(values) + 1))
    signs = {}
    for (i, _), steps, line in zip(rows, x, want, strict=True):
        for k, value in enumerate(line):
            r = found[i, k + 1]
            assert (r["n"], r["deviation"]) == (n, sum((n * int(c) - int(s)) ** 2 for c, s in zip(steps, sums, strict=True)))
            assert math.isclose(r["explained"], values[k] / trace, rel_tol=1e-9)
            assert math.isclose(abs(r["whitened"]), abs(value), abs_tol=1e-8) and r["identity_error"] < 1e-10
            if abs(value) > 1e-6:
                assert signs.setdefault(k, r["whitened"] * value > 0) == (r["whitened"] * value > 0)


def test_whitening_query(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding").collect()
    compare(QUERIES["op11_whitening"](spark, DATA), [tuple(r) for r in rows])


def test_odd_rows(spark):
    """Null, empty, short and non-finite vectors, repeated rows and clashing names."""
    random = np.random.default_rng(7)
    good = [(i, [float(np.float32(v)) for v in random.standard_normal(20)]) for i in range(40)]
    good += [good[0], (None, good[1][1]), (500, good[2][1])] + [(600, good[3][1])] * 30
    bad = [(900, None), (901, []), (902, [1.0]), (903, [None] * 20), (904, [math.nan] * 20), (905, [math.inf] + [0.0] * 19)]
    table = spark.createDataFrame([(*row, "a", 1) for row in good + bad], "vec_id long, embedding array<float>, x string, component int")
    report = whitening.whiten(table.repartition(5))
    compare(report, good)
    assert report.count() == 16 * len(good)


def test_few_directions(spark):
    def count(rows):
        return whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).count()

    assert count([]) == count([(1, None)]) == count([(1, [])]) == count([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == 0
    assert count([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [3.0, 6.0])]) == 3


def test_entries_that_are_too_large_raise(spark):
    table = spark.createDataFrame([(1, [1e30, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(table).collect()


@pytest.mark.parametrize("n", [3, 1 << 35, 1 << 45])
def test_deviations_are_exact(n):
    rest = np.array([1, n - 1])
    middle = whitening.Centre(n, np.array([0, 5]), rest)
    rows = [[5, 6], [1 << 24, 0], [-(1 << 30), 9]]
    assert middle.deviations(np.array(rows)) == [(n * a - 1) ** 2 + (n * (b - 5) - n + 1) ** 2 for a, b in rows]
    assert middle.deviations(np.array(rows[:2])) == middle.deviations(np.array(rows))[:2]
