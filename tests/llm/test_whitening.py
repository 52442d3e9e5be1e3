"""Whitening against numpy on the same rows."""

import math

import numpy as np
import pytest

from jobtide.llm import whitening

ROWS = "vec_id long, embedding array<double>, whitened string, index long, n string"


def table(spark, vectors, ids=None, parts=3):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, "x", 0, None) for i, v in zip(ids, vectors)], ROWS).repartition(parts)


def by_numpy(vectors):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, deviation, (x - sums / n) @ vectors / np.sqrt(values), values / values.sum()


def test_matches_numpy_with_repeated_rows_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 64)
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((300, 20)) * np.linspace(3, 0.5, 20)).tolist()
    vectors += [vectors[0]] * 100 + [vectors[7]]
    n, deviation, whitened, explained = by_numpy(vectors)
    found = whitening.whiten(table(spark, vectors, parts=5)).collect()
    assert len(found) == 401 * 16 and n == 300
    signs = {}
    for r in found:
        want = whitened[r.vec_id, r.component - 1]
        sign = signs.setdefault(r.component, np.sign(r.whitened * want))
        assert r.whitened == pytest.approx(sign * want, abs=1e-8)
        assert int(r.deviation) == deviation[r.vec_id]
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-6)
        assert r.n == 300 and r.identity_error < 1e-8


def test_nulls_odd_rows_and_lengths(spark):
    good = [[0.0, 1.0, 5.0], [1.0, 0.0, -3.0], [2.0, 2.5, 0.5], [0.25, -1.0, 1.0], [0.25, -1.0, 1.0]]
    odd = [None, [], [None, 1.0, 2.0], [float("nan"), 0.0, 1.0], [float("inf"), 0.0, 1.0], [-float("inf"), 0.0, 0.0], [1.0, 2.0]]
    found = whitening.whiten(table(spark, good + odd, [None, 1, 2, 3, 3, *range(10, 17)])).collect()
    assert sorted((r.vec_id or 0, r.component) for r in found) == sorted((i, c) for i in (0, 1, 2, 3, 3) for c in (1, 2, 3))
    assert {r.n for r in found} == {4}
    twice = [r.whitened for r in found if r.vec_id == 3 and r.component == 1]
    assert twice[0] == twice[1]


def test_tables_without_variance(spark):
    assert whitening.whiten(table(spark, [[1.0, 2.0]] * 5)).collect() == []
    assert whitening.whiten(table(spark, [[]])).collect() == []
    empty = whitening.whiten(table(spark, []))
    assert empty.collect() == [] and empty.columns[:2] == ["vec_id", "component"]


def test_directions_without_variance_are_left_out(spark):
    vectors = [[float(i), float(2 * i), 7.0] for i in range(50)]
    found = whitening.whiten(table(spark, vectors)).collect()
    assert {r.component for r in found} == {1} and found[0].explained == pytest.approx(1)


def test_one_hot_vector_does_not_gather_rows(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((200, 4)).tolist() + [[1.0, 1.0, 1.0, 1.0]] * 400
    rows = whitening.indexed(whitening.whole_numbers(table(spark, vectors, parts=6), "vec_id", "embedding"), "test")
    numbers = sorted(r["index"] for r in rows.select("index").collect())
    assert numbers == list(range(600))
