"""Series, models, clusters and matrices against small references."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidemill.functions import arrays as arr
from tidemill.operators import aggregates, arima, cluster, features, linalg, models, ordering, series
from tidemill.session import cut

rng = np.random.default_rng(5)


def months(n, start=dt.date(2015, 1, 1)):
    return [dt.date(start.year + (start.month - 1 + i) // 12, (start.month - 1 + i) % 12 + 1, 1) for i in range(n)]


@pytest.fixture(scope="module")
def seasonal(spark):
    n = 96
    t = np.arange(n)
    y = 500 + 3 * t + 40 * np.sin(2 * np.pi * t / 12) + rng.normal(0, 4, n)
    rows = [("a", d, float(v)) for d, v in zip(months(n), y)]
    rows += [("b", d, float(v)) for d, v in zip(months(n), np.cumsum(rng.normal(0, 5, n)) + 1000)]
    return spark.createDataFrame(rows, "k string, date date, y double")


def test_regular_series_fills_gaps(spark):
    rows = [("a", dt.date(2024, 1, 3), 1.0), ("a", dt.date(2024, 1, 9), 2.0), ("a", dt.date(2024, 4, 1), 5.0)]
    out = series.regular_monthly(spark.createDataFrame(rows, "k string, date date, y double"), ["k"], "date", "y")
    assert [r["y"] for r in out.orderBy("date").collect()] == [3.0, None, None, 5.0]


def test_decomposition_adds_up_and_season_repeats(seasonal):
    rows = series.decompose(seasonal, ["k"], "date", "y").filter("k = 'a'").orderBy("date").toPandas()
    assert np.allclose(rows.trend + rows.seasonal + rows.residual, rows.y)
    assert np.allclose(rows.seasonal[:12].to_numpy(), rows.seasonal[12:24].to_numpy())
    assert abs(rows.seasonal[:12].sum()) < 1e-9 and abs(rows.residual).mean() < 8


def test_unit_root_tells_walk_from_noise(spark):
    walk, noise = np.cumsum(rng.normal(0, 1, 200)), rng.normal(0, 1, 200)
    rows = [(k, d, float(v)) for k, s in (("walk", walk), ("noise", noise)) for d, v in zip(months(200), s)]
    out = series.unit_root(spark.createDataFrame(rows, "k string, date date, y double"), ["k"], "date", "y")
    got = {(r["k"], r["form"]): r["stationary"] for r in out.collect()}
    assert got[("noise", "level")] == 1 and got[("walk", "level")] == 0 and got[("walk", "difference")] == 1


def test_partial_autocorrelation_of_first_order_process(spark):
    y = np.zeros(400)
    for i in range(1, 400):
        y[i] = 0.7 * y[i - 1] + rng.normal()
    rows = [("a", d, float(v)) for d, v in zip(months(400, dt.date(1980, 1, 1)), y)]
    out = series.partial_autocorrelation(spark.createDataFrame(rows, "k string, date date, y double"), ["k"], "date", "y", 4)
    got = {r["lag"]: r["pacf"] for r in out.collect()}
    assert got[0] == 1.0 and abs(got[1] - 0.7) < 0.12 and abs(got[2]) < 0.15


@pytest.mark.parametrize("kind", ["seasonal", "fourier"])
def test_forecasts_follow_the_season(seasonal, kind):
    run = series.seasonal_forecast if kind == "seasonal" else series.trend_fourier_forecast
    rows = run(seasonal, ["k"], "date", "y").filter("k = 'a'").orderBy("date").toPandas()
    assert list(rows.date) == months(12, dt.date(2023, 1, 1))
    assert ((rows.lower <= rows["mean"]) & (rows["mean"] <= rows.upper)).all()
    t = np.arange(96, 108)
    truth = 500 + 3 * t + 40 * np.sin(2 * np.pi * t / 12)
    assert np.abs(rows["mean"] - truth).mean() < 40


def test_every_series_gets_a_forecast(spark):
    rows = [("a", d, float(i)) for i, d in enumerate(months(10))] + [("b", months(1)[0], 4.0)]
    rows += [("c", d, 5.0 + i % 12) for i, d in enumerate(months(20))] + [("d", d, 7.0) for d in months(90)]
    df = spark.createDataFrame(rows, "k string, date date, y double")
    got = series.seasonal_forecast(df, ["k"], "date", "y").orderBy("k", "date").toPandas()
    assert got.groupby("k").size().tolist() == [12] * 4
    assert got.groupby("k").method.first().tolist() == ["drift", "last", "seasonal", "seasonal"]
    assert got[got.k == "a"]["mean"].tolist() == [10.0 + i for i in range(12)]
    assert got[got.k == "c"]["mean"].tolist() == [5.0 + (20 + i) % 12 for i in range(12)]
    assert (got[got.k == "d"]["mean"] == 7.0).all() and (got[got.k != "b"].rmse.abs() < 1e-9).all()
    roots = series.unit_root(df, ["k"], "date", "y").toPandas().set_index(["k", "form"])
    assert roots.loc[("b", "level"), "reason"] == "short" and roots.loc[("d", "level"), "reason"] == "constant"
    assert series.partial_autocorrelation(df, ["k"], "date", "y").groupBy("k").count().collect()[0]["count"] == 37


def undifferenced(w, draw):
    v = list(draw.normal(size=13))
    for x in w:
        v.append(x + v[-1] + v[-12] - v[-13])
    return np.array(v)


def test_order_search_finds_what_was_simulated():
    """Noise is mostly given few terms; a moving average with a season is given those terms, with their weights."""
    draw = np.random.default_rng(3)
    found = []
    for _ in range(12):
        v = undifferenced(draw.normal(size=70), draw)
        fits = {o: arima.fit(v, o, 12) for o in series.ORDERS}
        found.append(min(fits, key=lambda o: (fits[o][0], o)))
    assert sum(sum(o) <= 2 for o in found) >= 9
    e = draw.normal(size=220)
    w = np.array([e[i] - 0.6 * e[i - 1] - 0.5 * e[i - 12] + 0.3 * e[i - 13] for i in range(13, 220)])
    v = undifferenced(w, draw)
    fits = {o: arima.fit(v, o, 12) for o in ((0, 0, 0, 0), (1, 0, 0, 0), (0, 1, 0, 0), (0, 1, 0, 1), (1, 0, 1, 0))}
    assert min(fits, key=lambda o: fits[o][0]) == (0, 1, 0, 1)
    ma = fits[0, 1, 0, 1][2]
    assert abs(ma[0] + 0.6) < 0.15 and abs(ma[11] + 0.5) < 0.15 and abs(fits[0, 1, 0, 1][3] - 1.0) < 0.25


def test_likelihood_is_that_of_the_covariance():
    ar, ma = arima.polynomials(np.array([0.5, -0.3, 0.4, 0.2, 0.6, -0.4]), (2, 2, 1, 1), 4)
    psi = arima.weights(ar, ma, 4000)
    want = [psi[: 4000 - k] @ psi[k:] for k in range(30)]
    assert np.allclose(arima.autocovariances(ar, ma, 30), want, atol=1e-8)
    assert np.allclose(arima.autocovariances(np.array([0.5]), np.zeros(0), 4), [4 / 3, 2 / 3, 1 / 3, 1 / 6])
    assert np.allclose(arima.autocovariances(np.zeros(0), np.array([0.5]), 4), [1.25, 0.5, 0, 0])
    w, raw = np.random.default_rng(2).normal(size=25), np.array([0.5, -0.3])
    gamma = arima.autocovariances(*arima.polynomials(raw, (1, 1, 0, 0), 4), 25)
    cov = gamma[np.abs(np.subtract.outer(np.arange(25), np.arange(25)))]
    var = w @ np.linalg.solve(cov, w) / 25
    direct = 25 * np.log(2 * np.pi) + np.linalg.slogdet(var * cov)[1] + w @ np.linalg.solve(var * cov, w)
    assert arima.deviance(raw, w, (1, 1, 0, 0), 4) == pytest.approx(direct)


def test_forecast_of_a_known_process():
    """The next value of an autoregression is its weight times the last one; far ones approach 0 in the differences."""
    draw = np.random.default_rng(5)
    w = np.zeros(80)
    for i in range(1, 80):
        w[i] = 0.7 * w[i - 1] + draw.normal()
    v = undifferenced(w, draw)
    found = (0.0, np.array([0.7]), np.zeros(0), 1.0)
    mean, spread = arima.project(v, found, 12, 3)
    assert mean[0] == pytest.approx(0.7 * w[-1] + v[-1] + v[-12] - v[-13])
    assert spread[0] == pytest.approx(1.0) and spread[1] == pytest.approx(np.sqrt(1 + 1.7**2))


def test_two_years_and_four_months_get_a_seasonal_order(spark):
    draw = np.random.default_rng(8)
    rows = [("a", d, float(100 + 2 * i + 30 * np.sin(2 * np.pi * i / 12) + draw.normal())) for i, d in enumerate(months(28))]
    got = series.seasonal_forecast(spark.createDataFrame(rows, "k string, date date, y double"), ["k"], "date", "y").collect()
    assert len(got) == 12 and {r["method"] for r in got} == {"seasonal"}
    truth = [100 + 2 * i + 30 * np.sin(2 * np.pi * i / 12) for i in range(28, 40)]
    assert np.abs(np.array([r["mean"] for r in sorted(got, key=lambda r: r["date"])]) - truth).mean() < 10


def test_a_bent_trend_is_found_and_a_straight_one_is_left_alone(spark):
    draw = np.random.default_rng(6)
    season = lambda i: 4 * np.sin(2 * np.pi * i / 12)
    bent = [("bent", d, float(-50 + 0.2 * i + 2.0 * max(i - 48, 0) + season(i) + draw.normal() * 0.5)) for i, d in enumerate(months(96))]
    straight = [("straight", d, float(-50 + 0.5 * i + season(i) + draw.normal() * 0.5)) for i, d in enumerate(months(96))]
    few = [("short", months(1)[0], 4.0)] + [("flat", d, 7.0) for d in months(30)]
    df = spark.createDataFrame(bent + straight + few, "k string, date date, y double")
    found = series.trend_changes(df, ["k"], "date", "y", least=0.05).collect()
    assert {r["k"] for r in found} == {"bent"}
    total = sum(r["change"] for r in found)
    middle = sum(r["change"] * r["date"].toordinal() for r in found) / total
    assert abs(middle - months(96)[48].toordinal()) < 62 and 18 < total < 30
    ahead = series.trend_fourier_forecast(df.filter("k = 'bent'"), ["k"], "date", "y").orderBy("date").toPandas()
    truth = [-50 + 0.2 * i + 2.0 * (i - 48) + season(i) for i in range(96, 108)]
    assert np.abs(ahead["mean"] - truth).mean() < 4


def test_coordinate_descent_meets_its_conditions():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(40, 6))
    y = x[:, 0] * 3 + draw.normal(size=40)
    gram, right = x.T @ x, x.T @ y
    d = series.sparse_changes(gram, right, 20.0)
    slope = right - gram @ d
    assert np.allclose(slope[d != 0], 20.0 * np.sign(d[d != 0]), atol=1e-6) and (np.abs(slope) <= 20.0 + 1e-6).all()
    assert d[0] != 0 and (d == 0).any()


def test_fourier_forecast_of_negative_values(spark):
    rows = [("a", d, float(-50.0 + 10 * np.sin(2 * np.pi * i / 12))) for i, d in enumerate(months(60))]
    got = series.trend_fourier_forecast(spark.createDataFrame(rows, "k string, date date, y double"), ["k"], "date", "y")
    assert all(-75 < r["mean"] < -25 for r in got.collect())


@pytest.fixture(scope="module")
def table(spark):
    x = rng.normal(size=(300, 3)) * [1, 5, 0.2] + [0, 10, 3]
    y = 50 + x @ [2.0, -1.0, 8.0] + rng.normal(0, 0.1, 300)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y double"), x, y


def test_ridge_matches_closed_form(table):
    df, x, y = table
    z = (x - x.mean(0)) / x.std(0)
    want = np.linalg.solve(z.T @ z + 10 * np.eye(3), z.T @ (y - y.mean()))
    got = {r["term"]: r["weight"] for r in features.linear_fit(df, ["a", "b", "c"], "y", ridge=10.0).collect()}
    assert [got[c] for c in "abc"] == pytest.approx(list(want), rel=1e-6)


def test_linear_prediction(table):
    df, _x, _y = table
    fit = features.linear_fit(df, ["a", "b", "c"], "y")
    gap = features.linear_predict(df, fit).agg(F.avg(F.abs(F.col("p") - F.col("y")))).first()[0]
    assert gap < 0.2


def test_inflation_finds_the_copy(spark):
    base = rng.normal(size=200)
    rows = [(float(v), float(2 * v + e), float(u)) for v, e, u in zip(base, rng.normal(0, 1e-3, 200), rng.normal(size=200))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    vif = {r["column"]: r["vif"] for r in features.variance_inflation(df, ["a", "b", "c"]).collect()}
    assert vif["a"] > 1000 and vif["b"] > 1000 and vif["c"] < 2
    assert features.drop_inflated(df, ["a", "b", "c"]).columns == ["c"]


def test_mutual_information_ranks_the_signal_first(spark):
    a, b = rng.normal(size=600), rng.normal(size=600)
    df = spark.createDataFrame([(float(x), float(z), float(x * x)) for x, z in zip(a, b)], "a double, b double, y double")
    assert [r["feature"] for r in features.mutual_information(df, ["a", "b"], "y").collect()] == ["a", "b"]


def test_one_hot_round_trip(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "s string")
    back = features.from_one_hot(features.one_hot(df, "s", ["x", "y"], "F"), ["x", "y"], "F", "t")
    assert [(r["s"], r["t"]) for r in back.collect()] == [("x", "x"), ("y", "y"), (None, None)]


def test_constant_column_standardises_to_zero(spark):
    df = features.standardise(spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "a double, b double"), ["a", "b"])
    assert [tuple(r) for r in df.collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_neighbour_grid_respects_floors():
    grid = models.neighbour_grid({"rounds": 100, "rate": 0.01, "depth": 2, "subsample": 1.0})
    assert {g["rounds"] for g in grid} == {50, 100, 200} and {g["depth"] for g in grid} == {2, 3}
    assert min(g["rate"] for g in grid) == 0.005


def test_search_and_learning_curve(table):
    df, _x, _y = table
    ready = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).withColumn("label", F.col("y"))
    folds = ordering.expanding_folds(ready.select("id", "features", "label"), "id", folds=2)
    space = dict(models.SEARCH_SPACE, rounds=(3,), depth=(2, 3))
    tries = models.search_boosted(folds, space, draws=2, count=2, refine=False)
    assert tries.count() == 2
    curve = models.learning_curve(features.lasso_model(0.01), ready.select("id", "features", "label"), ["id"], sizes=2, folds=2)
    assert {r["role"]: r["mean_r2"] > 0.9 for r in curve.filter("share = 1.0").collect()} == {"train": True, "validation": True}


def brute_density(x, eps, least):
    near = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2) <= eps * eps
    core = near.sum(1) >= least
    label = np.where(core, np.arange(len(x)), -1)
    while True:
        grown = label.copy()
        for i in np.flatnonzero(core):
            grown[i] = label[near[i] & core].min()
        if (grown == label).all():
            break
        label = grown
    for i in np.flatnonzero(~core):
        hits = label[near[i] & core]
        label[i] = hits.min() if len(hits) else -1
    return label, core


@pytest.mark.parametrize("dims", [2, 3])
def test_density_clusters_match_brute_force(spark, dims):
    centres = rng.uniform(-4, 4, size=(4, dims))
    x = np.vstack([c + rng.normal(0, 0.35, size=(40, dims)) for c in centres] + [rng.uniform(-6, 6, size=(40, dims))])
    # a hot spot of equal points in one cell
    x = np.vstack([x, np.repeat(x[:1], 60, axis=0)])
    names = [f"x{i}" for i in range(dims)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"{n} double" for n in names))
    got = {r["id"]: (r["label"], r["core"]) for r in cluster.density_clusters(df, "id", names, eps=0.5, min_points=5).collect()}
    label, core = brute_density(x, 0.5, 5)
    assert got == {i: (int(label[i]), int(core[i])) for i in range(len(x))}


def test_cells_that_are_joined_are_not_split_further(spark, monkeypatch):
    # a full square: before, pairs of its cells around the edge of reach were split to level 6
    x = rng.uniform(0, 3, size=(2500, 2))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, x0 double, x1 double")
    levels, run = [], cluster._boxes
    monkeypatch.setattr(cluster, "_boxes", lambda points, keys, dims: levels.append(list(keys)) or run(points, keys, dims))
    got = {r["id"]: (r["label"], r["core"]) for r in cluster.density_clusters(df, "id", ["x0", "x1"], eps=0.4, min_points=5).collect()}
    assert got == {i: (0, 1) for i in range(len(x))}
    assert sum("sub" in keys for keys in levels) <= 3


def test_labels_of_a_long_chain_take_few_rounds(spark, monkeypatch):
    order = [int(i) for i in rng.permutation(60)]
    edges = spark.createDataFrame([*zip(order, order[1:]), (100, 101)], "src long, dst long")
    nodes = spark.createDataFrame([(i,) for i in [*range(60), 100, 101, 102]], "node long")
    written, run = [], cluster.cut
    monkeypatch.setattr(cluster, "cut", lambda df: written.append(df.columns) or run(df))
    got = {r["node"]: r["label"] for r in cluster.connected_labels(nodes, edges).collect()}
    assert got == {**dict.fromkeys(range(60), 0), 100: 100, 101: 100, 102: 102}
    assert sum("label" in c for c in written) <= 14


def test_salted_join_splits_hot_cells(spark):
    points = spark.range(50).select("id", F.array(F.col("id").cast("double")).alias("x"), F.array(F.lit(0).cast("bigint")).alias("cell"))
    sizes = points.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    few = spark.createDataFrame([(7, [7.0], [0])], "id long, x array<double>, b array<bigint>")
    joined = cluster._salted_join(few, points.withColumn("cell", F.col("cell")), sizes, per_task=8)
    assert joined.count() == 50 and joined.select("salt").distinct().count() > 3


def test_silhouette_over_several_blocks(spark):
    x = rng.normal(size=(30, 2)) + np.repeat([[0, 0], [6, 6]], 15, axis=0)
    df = spark.createDataFrame([(i, [float(a) for a in r], i // 15) for i, r in enumerate(x)], "id int, v array<double>, label int")
    got = {r["id"]: r["silhouette"] for r in cluster.silhouette_rows(df, "id", "v", "label", block=7).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for i in range(30):
        own = np.arange(30) // 15 == i // 15
        a, b = d[i, own].sum() / 14, d[i, ~own].mean()
        assert got[i] == pytest.approx((b - a) / max(a, b))


def test_silhouette_meets_each_pair_of_blocks_once():
    x = rng.normal(size=(300, 3)) + 1e6  # far from the origin, where plain products lose all digits
    x[40:60] = x[40]
    labels = np.array(["a"] * 90 + ["b"] * 5 + ["c"] * 205)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    found, cells = {}, 0
    blocks = [(np.arange(300)[s : s + 110], labels[s : s + 110], x[s : s + 110]) for s in (0, 110, 220)]
    for i, one in enumerate(blocks):
        for two in blocks[i:]:
            for frame in cluster._block_sums(one, two, rows=16, columns=37):
                cells += len(frame)
                for r in frame.itertuples():
                    assert r.own == labels[r.id]
                    found[r.id, r.other] = found.get((r.id, r.other), 0.0) + r.total
    # a row has one sum per block and label there: a, b and c in the first, c in the others
    assert cells == 300 * 5
    for i in range(300):
        for name in "abc":
            assert found[i, name] == pytest.approx(d[i, labels == name].sum(), rel=1e-9)


def test_inertia_falls_with_k(spark):
    x = rng.normal(size=(60, 2)) + np.repeat([[0, 0], [8, 0], [0, 8]], 20, axis=0)
    df = cluster.with_vector(spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double"), ["a", "b"])
    rows = cluster.kmeans_inertia(df, ks=(2, 3), restarts=2).orderBy("k").collect()
    assert rows[0]["inertia"] > rows[1]["inertia"]
    assert cluster.kmeans_labels(df, 3, restarts=2).select("cluster").distinct().count() == 3


def test_all_fits_move_on_in_each_pass(spark, monkeypatch):
    x = np.round(rng.normal(size=(90, 2)) + np.repeat([[0, 0], [9, 0], [0, 9]], 30, axis=0), 3)
    df = cluster.with_vector(spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double"), ["a", "b"]).repartition(5)
    monkeypatch.setattr(cluster, "FIT_ROWS", 7)
    passes, run = [], cluster._means
    monkeypatch.setattr(cluster, "_means", lambda blocks, centres: passes.append(len(centres)) or run(blocks, centres))
    settings = [(k, s) for k in (2, 3, 4) for s in range(4)]
    fits = cluster._fits(df, settings)
    # the passes are those of one fit, and each takes along all that still move
    assert passes[0] == len(settings) and len(passes) <= 20
    for (k, _), centres, cost in fits:
        d2 = ((x[:, None] - centres[None]) ** 2).sum(2)
        own = d2.argmin(1)
        assert len(centres) == k and cost == pytest.approx(d2.min(1).sum())
        # Lloyd's fixed point
        assert all(np.allclose(centres[j], x[own == j].mean(0), atol=1e-3) for j in range(k))
    best = min(cost for (k, _), _c, cost in fits if k == 3)
    assert best == pytest.approx(sum(((x[i : i + 30] - x[i : i + 30].mean(0)) ** 2).sum() for i in (0, 30, 60)))


def test_more_clusters_than_different_rows(spark):
    df = cluster.with_vector(spark.createDataFrame([(1.0,), (1.0,), (4.0,)], "a double"), ["a"])
    assert [r["inertia"] for r in cluster.kmeans_inertia(df, ks=(2, 3), restarts=2).orderBy("k").collect()] == [0.0, 0.0]
    assert cluster.kmeans_labels(df, 3, restarts=2).select("cluster").distinct().count() == 2
    bad = cluster.with_vector(spark.createDataFrame([(1.0,), (float("nan"),)], "a double"), ["a"])
    with pytest.raises(Exception, match="not finite"):
        cluster.kmeans_inertia(bad, ks=(2,), restarts=1)


@pytest.fixture(scope="module")
def vectors(spark):
    x = rng.normal(size=(80, 6)) @ rng.normal(size=(6, 6))
    return spark.createDataFrame([(i, [float(a) for a in r]) for i, r in enumerate(x)], "id int, v array<double>").repartition(5), x


def test_gram_eigen_and_projection(vectors):
    df, x = vectors
    g = linalg.vector_gram(df, "v")
    assert g.n == 80 and np.allclose(g.products, x.T @ x) and np.allclose(g.covariance(), np.cov(x.T))
    assert all(r["residual"] < 1e-8 for r in linalg.eigen_table(df, "v").collect())
    pc = np.array([r["pc"] for r in linalg.principal_components(df, "v", 2).orderBy("id").collect()])
    _, vectors_ = linalg.eigenpairs(np.cov(x.T), 2)
    assert np.allclose(pc, (x - x.mean(0)) @ vectors_)


def test_singular_values_and_rebuild(vectors):
    df, x = vectors
    want = np.linalg.svd(x, compute_uv=False)
    got = [r["singular_value"] for r in linalg.singular_values(df, "v", 6).orderBy("component").collect()]
    assert got == pytest.approx(list(want))
    whole = linalg.low_rank(df, "v", 6).select(arr.mean_square("rebuilt", "v").alias("e")).agg(F.max("e")).first()[0]
    assert whole < 1e-18


def test_small_singular_values_keep_their_digits(spark, monkeypatch):
    turn = np.linalg.qr(rng.normal(size=(4, 4)))[0]
    x = np.linalg.qr(rng.normal(size=(300, 4)))[0] @ np.diag([1.0, 1e-3, 1e-6, 1e-10]) @ turn
    df = spark.createDataFrame([([float(a) for a in r],) for r in x], "v array<double>").repartition(9)
    monkeypatch.setattr(linalg, "FACTOR_BYTES", 0)  # two factors at once: the tree has several levels
    got = [r["singular_value"] for r in linalg.singular_values(df, "v", 4).orderBy("component").collect()]
    assert got == pytest.approx([1.0, 1e-3, 1e-6, 1e-10], rel=1e-4)
    lost = np.sqrt(np.abs(np.linalg.eigvalsh(x.T @ x)[0]))
    assert abs(lost - 1e-10) > 1e-11  # what the products of the columns leave of the last one


def test_singular_values_of_nulls_and_of_nothing(spark):
    df = spark.createDataFrame([(1, [3.0, 0.0]), (2, None), (3, [None, 1.0]), (4, [0.0, 4.0]), (5, [0.0, 0.0])], "id int, v array<double>")
    assert [r["singular_value"] for r in linalg.singular_values(df, "v").orderBy("component").collect()] == pytest.approx([4.0, 3.0])
    rebuilt = {r["id"]: r["rebuilt"] for r in linalg.low_rank(df.filter("id <> 3"), "v", 1).collect()}
    assert rebuilt[2] is None and rebuilt[4] == pytest.approx([0.0, 4.0]) and rebuilt[1] == pytest.approx([0.0, 0.0])
    assert linalg.singular_values(df.limit(0), "v").count() == 0
    assert linalg.low_rank(df.filter("id = 2"), "v", 1).first()["rebuilt"] is None


def test_matrix_tables(spark):
    def cells(m):
        return spark.createDataFrame([(i, j, float(v)) for i, r in enumerate(m) for j, v in enumerate(r)], "i long, j long, v double")

    def dense(df):
        out = np.zeros((2, 2))
        for r in df.collect():
            out[r["i"], r["j"]] = r["v"]
        return out.tolist()

    a, b = cells([[1, 2], [3, 4]]), cells([[5, 6], [7, 8]])
    assert dense(linalg.matrix_product(a, b)) == [[19, 22], [43, 50]]
    assert dense(linalg.matrix_hadamard(a, b)) == [[5, 12], [21, 32]]
    assert dense(linalg.matrix_add(a, linalg.matrix_scale(b, 2))) == [[11, 14], [17, 20]]


def test_denoising_beats_the_noise(spark):
    base = np.clip(rng.uniform(0.2, 0.8, size=(3, 20)), 0, 1)
    rows = [(i, [float(a) for a in base[i % 3]]) for i in range(90)]
    r = models.denoise(spark.createDataFrame(rows, "id int, v array<double>"), "id", "v", rank=3).first()
    assert r["n"] == 90 and r["mse_rebuilt"] < r["mse_noisy"]


def test_gram_keeps_small_spreads_on_large_values(spark):
    x = rng.normal(size=(400, 70)) * 1e-2 + 1e7
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], [f"c{i}" for i in range(70)])
    for columns in (df.columns[:5], df.columns):
        g = linalg.column_gram(df, columns)
        assert np.allclose(g.covariance(), np.cov(x[:, : len(columns)].T), rtol=1e-4, atol=1e-9)


def test_null_features_count_as_zero_in_fit_and_prediction(spark):
    df = spark.createDataFrame([(1.0, 3.0), (None, 1.0), (2.0, 5.0), (4.0, 9.0), (9.0, None)], "x double, y double")
    fit = features.linear_fit(df, ["x"], "y")
    assert [round(r["p"], 6) for r in features.linear_predict(df.filter("y IS NOT NULL"), fit).collect()] == [3.0, 1.0, 5.0, 9.0]


@pytest.mark.parametrize("levels", [1, 2, 30])
def test_linked_cells_at_the_edge_of_reach(spark, levels):
    """Cells whose nearest points lie just inside or just outside of reach, whatever number of levels is left to decide."""
    eps = 1.0
    rows = [("a", i, [0.0, 0.01 * i]) for i in range(5)]
    rows += [("b", 10, [1.0 - 1e-13, 0.0])] + [("c", 20, [0.0, -1.0 - 1e-9]), ("c", 21, [0.3, -1.0])] + [("d", 30, [5.0, 5.0])]
    points = spark.createDataFrame([([{"a": 0, "b": 1, "c": 2, "d": 3}[c]], i, x) for c, i, x in rows], "cell array<int>, id int, x array<double>")
    pairs = spark.createDataFrame([([i], [j]) for i in range(4) for j in range(i + 1, 4)], "a array<int>, b array<int>")
    got = cluster._linked_cells(points, pairs, 2, 0.7, eps * eps, levels).collect()
    assert sorted((r["a"][0], r["b"][0]) for r in got) == [(0, 1)]


def test_saved_model_is_fitted_on_written_months(spark, sf, monkeypatch):
    from tidemill.plans import catalogue, learning

    written = []
    monkeypatch.setattr(learning, "cut", lambda df: written.append(df.columns) or cut(df))
    scored = catalogue.QUERIES["s7_model_round_trip"](spark, sf)
    # the fit and the scoring read the written months, never the lines
    assert written == [["region", "model", "date", "price", "stations", "label"]]
    assert scored.inputFiles() and not any("lineitem" in f for f in scored.inputFiles())


def test_registered_models_use_the_reference_settings(spark, monkeypatch):
    from tidemill.operators import cluster, models
    from tidemill.plans import catalogue, learning

    seen = {}
    monkeypatch.setattr(learning, "_features", lambda *a: None)
    monkeypatch.setattr(learning, "_split", lambda rows: (spark.range(1).withColumns({"row_index": F.lit(0), "role": F.lit("train")}), None))
    monkeypatch.setattr(learning, "_scaled_clients", lambda *a: None)
    monkeypatch.setattr(learning, "cut", lambda x: x)
    for name in ("contiguous_folds", "expanding_folds"):
        monkeypatch.setattr(learning.ordering, name, lambda *a, name=name, **k: seen.setdefault(name, k) and None)
    monkeypatch.setattr(models, "contiguous_roles", lambda x: None)
    monkeypatch.setattr(models, "cross_validate", lambda estimators, folds: seen.setdefault("compared", estimators))
    monkeypatch.setattr(models, "search_boosted", lambda folds, space=None, **k: seen.setdefault("search", (space, k)))
    monkeypatch.setattr(cluster, "kmeans_labels", lambda df, k, **more: seen.setdefault("labels", more))
    monkeypatch.setattr(cluster, "silhouette_squared", lambda df: 0.0)

    for name in ("m9_cross_validation", "m9_search", "c2_silhouette_squared"):
        catalogue.QUERIES[name](spark, "")
    compared = seen.pop("compared")
    assert seen == {"contiguous_folds": {}, "expanding_folds": {}, "search": (None, {}), "labels": {}}
    assert list(compared) == ["linear", "ridge", "lasso", "forest", "gradient_boosting", "penalised_trees"]
    forest, plain, second = compared["forest"], compared["gradient_boosting"], compared["penalised_trees"]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode()) == (200, 12, 3)
    assert (plain.rounds, plain.rate, plain.depth, plain.subsample, plain.l1, plain.l2) == (200, 0.08, 5, 0.85, 0.0, 0.0)
    assert (second.rounds, second.rate, second.depth, second.subsample, second.columns) == (300, 0.07, 6, 0.85, 0.8)
    assert len(models.SEARCH_SPACE) == 9


def test_ridge_penalises_the_sum_of_squares(table):
    df, _x, y = table
    ready = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).withColumn("label", F.col("y"))
    rows = df.orderBy("id").toPandas()
    x = rows[["a", "b", "c"]].to_numpy(float)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    t = rows["y"].to_numpy(float)
    w = np.linalg.solve(z.T @ z + 10.0 * np.eye(3), z.T @ (t - t.mean()))
    got = models.Ridge(10.0).fit(ready).transform(ready).orderBy("id").toPandas()["prediction"].to_numpy()
    assert np.allclose(got, z @ w + t.mean(), atol=1e-6)


def test_leaderboard_of_all_models(table):
    df, _x, _y = table
    ready = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).withColumn("label", F.col("y"))
    parts = ready.select("id", "features", "label")
    small = {k: m.copy(rounds=5) if k in ("gradient_boosting", "penalised_trees") else m for k, m in models.six_models().items()}
    small["forest"] = models.random_forest(trees=5, depth=3)
    board = aggregates.leaderboard(models.all_predictions(small, parts, parts)).collect()
    assert {r["model_name"] for r in board} == set(small) and sum(r["best"] for r in board) == 1
    assert [r["r2"] for r in board] == sorted((r["r2"] for r in board), reverse=True)
