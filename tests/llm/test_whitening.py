"""Whitening against numpy on the same numbers, and the slices against known spectra."""

import math
import random

import numpy as np
import pytest

from kontor.llm import spectrum, whitening
from kontor.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, n string, x int"


def brute(rows, components=4, scale=256):
    """{(key, place among repeated rows, component): (n, deviation, |whitened|, explained)}"""
    ok = [(key, [math.floor(scale * float(np.float32(c))) for c in v]) for key, v in rows
          if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in ok}), dtype=float)
    n, total = len(fit), [int(one) for one in fit.sum(axis=0)]
    centred = fit - fit.mean(axis=0)
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    result = []
    for key, x in ok:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, total))
        for i in range(min(components, len(values))):
            e, v = values[-1 - i], vectors[:, -1 - i]
            if e > 1e-9 * values[-1]:
                result.append((key, i + 1, n, deviation, abs((np.array(x) - fit.mean(axis=0)) @ v / math.sqrt(e)), e / np.trace(covariance)))
    return sorted(result, key=repr)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*row, "s", 1) for row in rows], SCHEMA)
    rows = whitening.whiten(frame, **options).collect()
    assert all(row.identity_error < 1e-10 for row in rows)
    return sorted(((row.key, row.component, row.n, row.deviation, abs(row.whitened), row.explained) for row in rows), key=repr)


def same(ours, theirs):
    assert [one[:4] for one in ours] == [one[:4] for one in theirs]
    for one, other in zip(ours, theirs):
        assert one[4:] == pytest.approx(other[4:], abs=1e-9)


def test_against_numpy(spark):
    chance = random.Random(5)
    rows = [(i, [chance.gauss(0, 1 + j % 3 + j / 10) for j in range(9)]) for i in range(200)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)] + [(None, rows[0][1]), (5, rows[5][1])]
    same(found(spark, rows), brute(rows))


def test_odd_rows(spark):
    rows = [(1, [1.0, 2.0, 0.5]), (2, None), (3, [1.0, None, 2.0]), (4, [float("nan"), 1.0, 1.0]), (5, [float("inf"), 1.0, 1.0]),
            (6, [0.25, -1.0, 3.0]), (7, [-0.0, 0.0, 0.001]), (8, [0.0, 0.0, 0.0]), (None, [4.0, 1.0, 1.0])]
    same(found(spark, rows), brute(rows))
    others = [(20, []), (21, [1.0]), (22, [2.0])]
    same(found(spark, rows + others), brute(rows))


def test_too_few(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    rows = [(1, [1.0, 2.0]), (2, [3.0, 2.0])]
    same(found(spark, rows), brute(rows))  # one direction only


def test_large_deviations():
    whitener = whitening.Whitener(10**9, [5 * 10**9, -(10**9)], 1.0, np.ones(1), np.eye(2)[:1])
    assert whitener.deviations(np.array([[5, -1], [6, -1], [7, 0]])).tolist() == [0, 10**18, 5 * 10**18]
    with pytest.raises(OverflowError):
        whitener.deviations(np.array([[50, -1]]))


def spectra():
    chance = np.random.default_rng(2)
    for n in (1, 2, 3, 6, 40):
        basis, _ = np.linalg.qr(chance.normal(size=(n, n)))
        for values in (
            np.arange(n, 0, -1.0), np.ones(n), np.r_[np.full(min(n, 3), 5.0), np.ones(max(0, n - 3))],
            np.r_[1 + 1e-13, 1.0, np.linspace(0.9, 0.1, n)][:n], np.r_[7.0, np.zeros(n - 1)], np.zeros(n), 1e6 * np.arange(n, 0, -1.0),
        ):
            yield np.diag(values), values
            matrix = basis @ np.diag(values) @ basis.T
            yield (matrix + matrix.T) / 2, values


def test_spectra():
    for matrix, values in spectra():
        found, vectors = spectrum.leading(matrix, 4)
        scale = max(values[0], 1e-300)
        expected = values[:4][values[:4] > 1e-12 * scale]
        assert found == pytest.approx(expected, rel=0, abs=1e-12 * scale)
        assert vectors @ vectors.T == pytest.approx(np.eye(len(found)), abs=1e-12)
        assert matrix @ vectors.T == pytest.approx(vectors.T * found, abs=1e-12 * scale)


def test_inertia():
    for matrix, values in spectra():
        scale = max(values[0], 1.0)
        for shift in (-scale, *(one + side * 1e-3 * scale for one in values[:5] for side in (-1, 1))):
            assert spectrum.above(matrix, shift) == (values > shift).sum()
    flip = np.array([[0.0, 1.0, 0.0], [1.0, 0.0, 0.0], [0.0, 0.0, -2.0]])
    assert [spectrum.above(flip, shift) for shift in (-3, -1.5, 0, 0.5, 2)] == [3, 2, 1, 1, 0]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(row.vec_id, row.embedding) for row in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    result = QUERIES["op12_whitening"](spark, sf).collect()
    assert max(row.identity_error for row in result) < 1e-10
    ours = sorted(((row.vec_id, row.component, row.n, row.deviation, abs(row.whitened), row.explained) for row in result), key=repr)
    same(ours, brute(rows))
