"""Whitening against plain NumPy on all rows, exact integers, and odd input."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import queries, whitening

DATA = "/root/testdata/sf0.01"


def reference(vectors, components=8):
    x = np.floor(np.asarray(vectors, dtype=np.float64) * 1024) + 100000
    whole = [[int(v) for v in row] for row in x]
    n, sums = len(whole), [sum(c) for c in zip(*whole)]
    deviation = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in whole]
    centred = x - x.mean(axis=0)
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    kept = [i for i in range(min(components, len(values))) if values[i] > 1e-12 * values[0]]
    return n, deviation, (centred @ vecs[:, kept]) / np.sqrt(values[kept]), values[kept] / values.sum()


def check(rows, ids, vectors, components=8):
    n, deviation, z, explained = reference(vectors, components)
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == n * z.shape[1]
    for c in range(z.shape[1]):
        mine = np.array([got[i, c + 1]["whitened"] for i in ids])
        assert min(np.abs(mine - z[:, c]).max(), np.abs(mine + z[:, c]).max()) < 1e-6
        assert math.isclose(got[ids[0], c + 1]["explained"], explained[c], rel_tol=1e-8)
    assert all(got[i, 1]["deviation"] == d and got[i, 1]["n"] == n for i, d in zip(ids, deviation))
    assert all(0 <= r["identity_error"] < 1e-9 for r in rows)


def test_whole_table(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").orderBy("vec_id").collect()
    check(queries.QUERIES["op11_whitening"](spark, DATA).collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


@pytest.fixture
def few():
    draw = np.random.default_rng(3)
    base = draw.normal(size=(40, 5)) * [5, 1, 0.3, 2, 1]
    return np.vstack([base, np.repeat(base[:1], 30, axis=0), base[:7]])  # one vector holds much of the table


def test_repeated_vectors_weigh_as_often_as_they_occur(spark, few):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(few)], "vec_id long, embedding array<double>").repartition(5)
    check(whitening.whiten(df).collect(), list(range(len(few))), few)
    check(whitening.whiten(df, 2).collect(), list(range(len(few))), few, 2)
    once = whitening.whiten(df, multiplicity=False).filter("vec_id < 40").collect()
    n, _, z, _ = reference(few[:40])
    assert {r["n"] for r in once} == {n}
    mine = {(r["vec_id"], r["component"]): abs(r["whitened"]) for r in once}
    assert all(abs(mine[i, c + 1] - abs(z[i, c])) < 1e-6 for i in range(40) for c in range(5))


def test_all_ways_of_joining_back_agree(spark, few, monkeypatch):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(few)], "vec_id long, embedding array<double>")
    found = []
    for hot in (1, 2, 10_000):
        monkeypatch.setattr(whitening, "HOT", hot)
        rows = whitening.whiten(df).select("vec_id", "component", "deviation", F.round(F.abs("whitened"), 8)).collect()
        found.append(sorted(tuple(r) for r in rows))
    assert found[0] == found[1] == found[2]


def test_odd_rows(spark):
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.5, -3.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]),
        (5, [float("inf"), 1.0]), (6, [4.0]), (7, []),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'k' AS key", "1 AS x", "2 AS times", "0 AS n")
    got = whitening.whiten(df).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in got if r["component"] == 1) == [
        (False, 1), (False, 1), (False, 6), (False, 7), (True, 0)
    ]
    assert {r["n"] for r in got} == {5}
    n, deviation, _, _ = reference([[1, 2], [1, 2], [0.5, -3], [4, 0], [0, 0]])
    assert {r["deviation"] for r in got if r["vec_id"] == 6} == {deviation[3]}
    assert whitening.whiten(df.filter("vec_id = 1")).count() == 0  # one distinct vector has no variance
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.filter("vec_id = 7")).count() == 0


def test_deviations_beyond_64_bits(spark):
    values = [[3.0e6, -1.0], [0.25, 7.0], [1.0e6, 2.0e6]] * 50
    df = spark.createDataFrame(list(enumerate(values)), "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(df).filter("component = 1").collect()}
    want = reference(values)[1]
    assert all(got[i] == (w if w < 1 << 63 else None) for i, w in enumerate(want)) and max(want) > 1 << 63
    huge = spark.createDataFrame([(1, [1e30, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(huge).filter("deviation IS NULL").count() == 2
