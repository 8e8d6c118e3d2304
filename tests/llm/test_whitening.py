"""Whitening against numpy's eigenvectors and exact integers; odd rows."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tenura.llm import whitening as W

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, n long, y int, component string"


def integers(rows):
    return [[math.floor(W.SCALE * float(c)) + W.OFFSET for c in row] for row in rows]


def by_hand(vectors, most=16):
    """(distinct x, n, sums, eigenvalues, vectors) in double precision from an exactly centred covariance."""
    distinct = sorted(set(map(tuple, vectors)))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[float(Fraction(n * x - s, n)) for x, s in zip(row, sums)] for row in distinct])
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    return n, sums, values[::-1][:most], columns.T[::-1][:most], values.sum()


def check(found, rows, most=16):
    x = integers([v for _, v in rows])
    n, sums, values, vectors, trace = by_hand(x, most)
    there = [k for k in range(len(values)) if values[k] > 1e-9 * trace]
    assert len(found) == len(rows) * len(there)
    expected = {}
    for (vec_id, _), row in zip(rows, x):
        deviation = sum((n * c - s) ** 2 for c, s in zip(row, sums))
        centred = np.array([c - s / n for c, s in zip(row, sums)])
        for k in there:
            expected.setdefault((vec_id, k + 1), []).append((deviation, centred @ vectors[k] / math.sqrt(values[k])))
    signs = {}
    for r in found:
        assert r["n"] == n and 0 <= r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / trace, rel=1e-9)
        deviation, whitened = expected[r["vec_id"], r["component"]][0]
        assert r["deviation"] == deviation
        if abs(whitened) > 1e-3:
            sign = signs.setdefault(r["component"], math.copysign(1, whitened * r["whitened"]))
            assert r["whitened"] == pytest.approx(sign * whitened, rel=1e-6, abs=1e-8)


def test_polynomial_by_hand(spark):
    assert W.elementary_sums(spark, [[5]]) == [1, 5]
    assert W.elementary_sums(spark, [[2, 1, 0], [1, 2, 0], [0, 0, 7]]) == [1, 11, 31, 21]
    assert W.elementary_sums(spark, [[4, 2], [2, 1]]) == [1, 5, 0]
    rng = np.random.default_rng(3)
    rows = rng.integers(-50, 50, (9, 6)).astype(object)
    matrix = rows.T.dot(rows)
    sums = W.elementary_sums(spark, matrix.tolist())
    values = np.linalg.eigvalsh(matrix.astype(float))
    assert np.allclose(np.array([float(s) for s in sums]), [(-1) ** k * c for k, c in enumerate(np.poly(values))], rtol=1e-8)

    def determinant(m):
        return m[0][0] if len(m) == 1 else sum((-1) ** j * m[0][j] * determinant([r[:j] + r[j + 1:] for r in m[1:]]) for j in range(len(m)))

    assert sums[-1] == determinant(matrix.tolist())


def test_roots():
    """Roots of (x-1)(x-2)^2(x-1000) times x; thirds; roots that meet bisection points."""
    sums = [1.0]
    for root in (1, 2, 2, 1000, 0):
        sums = [a + root * b for a, b in zip(sums + [0], [0] + sums)]
    roots = W.Roots([int(s) for s in sums])
    assert roots.degree == 4
    for rank, root in enumerate([1000, 2, 2, 1], 1):
        a, scale = roots.largest(rank)
        assert Fraction(a, 1 << scale) < root <= Fraction(a + 1, 1 << scale) and a.bit_length() > W.ROOT_BITS
    a, scale = W.Roots([3, 1]).largest(1)
    assert Fraction(a, 1 << scale) < Fraction(1, 3) <= Fraction(a + 1, 1 << scale)


def test_exact_scatter():
    rng = np.random.default_rng(2)
    for most in (40, 1 << 30, 1 << 61):
        rows = rng.integers(-most, most, (70, 5))
        by_number = rows.astype(object)
        assert W.scatter_of(rows) == by_number.T.dot(by_number).tolist()


def test_equal_eigenvalues():
    """A cluster of roots has an orthonormal basis of its null space, others their own vectors."""
    matrix = [[10, 0, 0, 0], [0, 6, 0, 0], [0, 0, 6, 0], [0, 0, 0, 1]]
    roots = W.Roots([1, 23, 178, 516, 360])
    found = W.null_vectors(matrix, [roots.largest(k) for k in range(1, 5)])
    assert np.allclose(found @ found.T, np.eye(4), atol=1e-14)
    assert np.allclose(found @ np.array(matrix, dtype=float) @ found.T, np.diag([10, 6, 6, 1]), atol=1e-13)


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(W.whiten(spark.read.parquet(f"{SF}/embeddings.parquet")).collect(), [(r["vec_id"], r["embedding"]) for r in rows])


def test_odd_rows(spark):
    """Nulls, non-finite entries, repeated rows and ids, equal vectors, a flat dimension, clashing columns."""
    rng = np.random.default_rng(9)
    usable = [(n, [float(c) for c in rng.standard_normal(3)] + [0.25]) for n in range(30)]
    usable += [(5, usable[5][1]), (5, usable[6][1]), (None, usable[7][1]), (40, [1.0, 1.0, 1.0, 0.25])] + [(100 + n, usable[3][1]) for n in range(60)]
    odd = [(50, None), (51, [1.0, None, 2.0, 3.0]), (52, [1.0, float("nan"), 0.0, 0.0]), (53, [float("inf"), 0.0, 0.0, 0.0]), (54, []), (55, [1e30, 0.0, 0.0, 0.0])]
    table = spark.createDataFrame([(i, v, 0, 1, 2, "c") for i, v in usable + odd], SCHEMA)
    found = W.whiten(table).collect()
    assert {r["component"] for r in found} == {1, 2, 3}  # the flat dimension has eigenvalue zero
    single = [(i, v) for i, v in usable if i != 5 and i is not None]
    check_rows = [r for r in found if r["vec_id"] != 5 and r["vec_id"] is not None]
    assert len(found) == 3 * len(usable) and len(check_rows) == 3 * len(single)
    check(W.whiten(spark.createDataFrame([(i, v, 0, 1, 2, "c") for i, v in single + [usable[5], usable[6]]], SCHEMA).where("vec_id is not null")).collect(),
          single + [usable[5], usable[6]])


def test_lengths_apart_and_large_entries(spark):
    rng = np.random.default_rng(4)
    two, three = [(n, [float(c) for c in rng.standard_normal(2) * 2.0 ** 40]) for n in range(9)], [(20 + n, [float(c) for c in rng.standard_normal(3)]) for n in range(9)]
    found = W.whiten(spark.createDataFrame([(i, v) for i, v in two + three], "vec_id long, embedding array<double>")).collect()
    big = [r for r in found if r["vec_id"] < 20]
    assert len(big) == 18 and {r["deviation"] for r in big} == {None}  # beyond a long
    n, sums, values, vectors, trace = by_hand(integers([v for _, v in two]))
    assert all(r["explained"] == pytest.approx(values[r["component"] - 1] / trace, rel=1e-9) for r in big)
    check([r for r in found if r["vec_id"] >= 20], three)


def test_nothing_to_scale(spark):
    schema = "vec_id long, embedding array<float>"
    assert W.whiten(spark.createDataFrame([], schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).count() == 0
    one = W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 2.0]), (2, [2.0, 2.0])], schema)).collect()
    assert len(one) == 3 and {round(r["whitened"], 9) for r in one} == {-1.0, 1.0} and {r["explained"] for r in one} == {1.0}
