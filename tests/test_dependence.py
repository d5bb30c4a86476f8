"""Mutual information by neighbours against brute force and a closed form."""

from __future__ import annotations

import numpy as np
import pytest

from tidemill.operators import dependence


def psi(n):
    """Digamma of whole numbers: harmonic sums less Euler's constant."""
    n = np.asarray(n, dtype=int)
    sums = np.concatenate(([0.0], np.cumsum(1.0 / np.arange(1, n.max() + 1))))
    return sums[n - 1] - 0.57721566490153286


def brute(x, y, k):
    x, y = (v * 2.0 ** -round(np.log2(v.std())) for v in (x, y))
    dx, dy = np.abs(x[:, None] - x), np.abs(y[:, None] - y)
    d = np.maximum(dx, dy)
    np.fill_diagonal(d, np.inf)
    r = np.sort(d, axis=1)[:, k - 1 : k]
    nx, ny = (np.where(r > 0, a < r, a == 0).sum(axis=1) for a in (dx, dy))
    return max(0.0, float(psi(len(x)) + psi(k) - np.mean(psi(nx) + psi(ny))))


def informed(spark, data, k=3, parts=7):
    names = list(data)
    df = spark.createDataFrame([tuple(float(v) for v in r) for r in zip(*data.values())], ", ".join(f"{c} double" for c in names))
    rows = dependence.neighbour_information(df.repartition(parts), [c for c in names if c != "y"], "y", k).collect()
    return {r["feature"]: r["mi"] for r in rows}


def test_equals_brute_force_with_ties(spark, monkeypatch):
    monkeypatch.setattr(dependence, "BOX", 40)  # many boxes
    rng = np.random.default_rng(5)
    n = 1200
    y = rng.normal(size=n).round(2)
    data = {
        "near": y + rng.normal(size=n) * 0.3,
        "steps": np.floor(3 * y),
        "hot": np.where(np.arange(n) % 3 == 0, 7.0, rng.normal(size=n)),
        "tailed": rng.standard_cauchy(size=n) * 100 + y,
        "y": y,
    }
    got = informed(spark, data)
    want = {c: brute(v, y, 3) for c, v in data.items() if c != "y"}
    assert got == pytest.approx(want, abs=1e-9)


def test_close_to_the_normal_closed_form(spark):
    rng = np.random.default_rng(6)
    y = rng.normal(size=4000)
    got = informed(spark, {"a": 0.9 * y + np.sqrt(1 - 0.81) * rng.normal(size=4000), "b": rng.normal(size=4000), "y": y})
    assert got["a"] == pytest.approx(-0.5 * np.log(1 - 0.81), abs=0.06) and got["b"] < 0.06


def test_nulls_copies_and_small_tables(spark):
    schema = "a double, y double"
    given = [(1.0, 2.0), (None, 1.0), (float("nan"), 1.0), (float("inf"), 1.0), (2.0, None)]
    few = spark.createDataFrame(given, schema)
    assert [tuple(r) for r in dependence.neighbour_information(few, ["a"], "y").collect()] == [("a", None)]
    assert dependence.neighbour_information(few.limit(0), ["a"], "y").count() == 0
    # four heaps of five equal rows: distance 0, five equals of each
    heaps = spark.createDataFrame([(float(i % 4), float(i % 4)) for i in range(20)], schema)
    got = dependence.neighbour_information(heaps, ["a"], "y").first()["mi"]
    assert got == pytest.approx(float(psi(20) + psi(3) - 2 * psi(5)))
    level = spark.createDataFrame([(1.0, float(i)) for i in range(9)], schema)
    assert dependence.neighbour_information(level, ["a"], "y").first()["mi"] is not None


def test_reach_is_the_last_number_below_a_distance():
    rng = np.random.default_rng(7)
    v = np.concatenate((rng.standard_cauchy(500) * 1000, [0.0, -0.0, 5.0]))
    d = np.concatenate((np.abs(v[:500] + rng.normal(size=500) * 1e-9), [1.0, 1e-20, 0.0]))
    for sign in (-1, 1):
        t = dependence._reach(v, d, sign)
        beyond = np.nextafter(t, sign * np.inf)
        assert (np.abs(t - v)[:-1] < d[:-1]).all() and (np.abs(beyond - v) >= d).all() and t[-1] == 5.0


def test_digamma(spark):
    rows = spark.range(1, 200).select("id", dependence.digamma(dependence.F.col("id")).alias("p")).collect()
    assert [r["p"] for r in rows] == pytest.approx(list(psi([r["id"] for r in rows])), abs=1e-9)
