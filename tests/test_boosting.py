"""Regularised boosted trees: closed forms, a plain version without histograms per task, odd input."""

from __future__ import annotations

import numpy as np
import pytest

from tidemill.operators.boosting import PenalisedTrees, leaf_weight, worth


def frame(spark, x, y):
    rows = [([None if v is None else float(v) for v in r], None if t is None else float(t)) for r, t in zip(x, y)]
    return spark.createDataFrame(rows, "features array<double>, label double").repartition(3)


def predictions(model, spark, x):
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "i int, features array<double>")
    return [r["prediction"] for r in model.transform(df).orderBy("i").collect()]


def plain_tree(x, g, depth, s):
    """Every cut between values, recursively: gives a function of a row."""
    def grow(rows, level):
        gs, n = g[rows].sum(), len(rows)
        best = (max(s.gain, 1e-9), None)
        for f in range(x.shape[1]) if level < depth else ():
            for cut_at in np.unique(x[rows, f])[:-1]:
                left = rows[x[rows, f] <= cut_at]
                right = rows[x[rows, f] > cut_at]
                if min(len(left), len(right)) < s.weight:
                    continue
                gain = sum(worth(g[r].sum(), len(r), s.l1, s.l2) for r in (left, right)) - worth(gs, n, s.l1, s.l2)
                if gain > best[0] + 1e-9:
                    best = (gain, (f, cut_at, left, right))
        if best[1] is None:
            return lambda row: s.rate * leaf_weight(gs, n, s.l1, s.l2)
        f, cut_at, left, right = best[1]
        low, high = grow(left, level + 1), grow(right, level + 1)
        return lambda row: low(row) if row[f] <= cut_at else high(row)

    return grow(np.arange(len(x)), 0)


@pytest.mark.parametrize("l1,l2,gain,weight", [(0.0, 1.0, 0.0, 1), (2.0, 0.5, 0.0, 3), (0.5, 5.0, 20.0, 1)])
def test_equals_a_plain_version(spark, l1, l2, gain, weight):
    draw = np.random.default_rng(5)
    x = draw.integers(0, 9, size=(60, 3))
    y = 3.0 * x[:, 0] - (x[:, 1] > 4) * 10 + draw.normal(size=60)
    s = PenalisedTrees(rounds=4, rate=0.5, depth=3, subsample=1.0, columns=1.0, l1=l1, l2=l2, gain=gain, weight=weight)
    model = s.fit(frame(spark, x, y))
    want = np.full(60, y.mean())
    for _ in range(4):
        f = plain_tree(x, want - y, 3, s)
        want = want + np.array([f(r) for r in x])
    assert np.allclose(predictions(model, spark, x), want, atol=1e-9)


def test_leaf_weights_are_the_closed_form(spark):
    # one split at 2.5: rows 0, 1, 2 against 3, 4
    x, y = [[0], [1], [2], [3], [4]], [1.0, 1.0, 1.0, 9.0, 9.0]
    s = PenalisedTrees(rounds=1, rate=1.0, depth=1, subsample=1.0, columns=1.0, l1=1.5, l2=2.0)
    got = predictions(s.fit(frame(spark, x, y)), spark, x)
    mean = 4.2
    left, right = mean - (3 * (mean - 1) - 1.5) / (3 + 2), mean + (2 * (9 - mean) - 1.5) / (2 + 2)
    assert np.allclose(got, [left] * 3 + [right] * 2)
    # a gain that no split brings leaves the mean, less nothing: the root's gradient sum is 0
    assert np.allclose(predictions(s.copy(gain=1e9).fit(frame(spark, x, y)), spark, x), mean)
    assert np.allclose(predictions(s.copy(weight=4).fit(frame(spark, x, y)), spark, x), mean)
    assert np.allclose(predictions(s.copy(l1=1e6).fit(frame(spark, x, y)), spark, x), mean)


def test_one_task_many_tasks_and_rows_written_again_give_the_same_trees(spark, monkeypatch):
    from tidemill.operators import boosting

    draw = np.random.default_rng(7)
    x, y = draw.normal(size=(200, 4)), draw.normal(size=200)
    s = PenalisedTrees(rounds=7, depth=3, rate=0.3)
    df = frame(spark, x, y)
    data = s.binned(df)
    assert data.tasks == 1
    one = predictions(s.fit_binned(data), spark, x)  # grown in one task
    spread = boosting.Binned(data.edges, data.base, data.table.repartition(3), 3)
    assert np.allclose(one, predictions(s.fit_binned(spread), spark, x))  # a job per level
    monkeypatch.setattr(boosting, "KEEP", 2)
    assert np.allclose(one, predictions(s.fit_binned(spread), spark, x))
    assert not np.allclose(one, predictions(s.copy(seed=1).fit(df), spark, x))


def test_draws_of_rows_and_columns(spark):
    from tidemill.operators.boosting import _drawn

    place = np.random.default_rng(1).integers(-(2**62), 2**62, 20_000)
    parts = [_drawn(place, n, 0.6, 42) for n in range(4)]
    assert all(abs(p.mean() - 0.6) < 0.02 for p in parts)
    assert all(abs((parts[0] & p).mean() - 0.36) < 0.02 for p in parts[1:])
    x = np.random.default_rng(2).normal(size=(80, 10))
    model = PenalisedTrees(rounds=1, depth=4, columns=0.2, subsample=1.0).fit(frame(spark, x, x.sum(axis=1)))
    assert len(model.gains()) <= 2


def test_odd_rows(spark):
    s = PenalisedTrees(rounds=2, depth=2, rate=1.0, subsample=1.0, columns=1.0, l2=0.0)
    rows = [([1.0, None], 1.0), ([float("nan"), 5.0], 3.0), ([2.0, 5.0], None), (None, 4.0), ([2.0, 5.0], 5.0), ([2.0, 5.0], 5.0)]
    df = spark.createDataFrame(rows, "features array<double>, label double").selectExpr("*", "1 AS b", "2 AS y", "3 AS p", "4 AS place")
    model = s.fit(df)
    got = [r["prediction"] for r in model.transform(df.filter("features IS NOT NULL")).select("label", "prediction").collect()]
    assert np.allclose(sorted(got), [1.0, 3.0, 5.0, 5.0, 5.0])
    assert s.fit(df.limit(0)).base == 0.0
    constant = s.fit(spark.createDataFrame([([1.0], 2.0)] * 5, "features array<double>, label double"))
    assert predictions(constant, spark, [[7.0]]) == [2.0]
