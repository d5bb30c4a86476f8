"""Queries: encoding, screening, models, clustering, matrices."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidemill.functions import arrays as arr
from tidemill.operators import aggregates as agg
from tidemill.operators import cluster, dependence, features, linalg, models, ordering
from tidemill.operators.boosting import PenalisedTrees
from tidemill.plans.registry import query
from tidemill.plans.timeline import rounded
from tidemill.plans.views import CLIENTS_SQL, DELIVERIES_SQL, clients, deliveries, table
from tidemill.session import cut, scratch_path
from tidemill.sources import files

KEYS = ["date", "region", "model"]
# computed from the target or standing for the time axis
LEFT_OUT = ["year", "month"]
STATUSES = ["F", "O", "P"]


@query(
    "m1_label_encode",
    "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS o_orderpriority_enc FROM orders",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return features.label_encode(rows, "o_orderpriority").select("o_orderkey", "o_orderpriority_enc")


@query(
    "m2_one_hot",
    "SELECT o_orderkey, "
    + ", ".join(f"CAST(o_orderstatus = '{s}' AS BIGINT) AS \"S_{s}\"" for s in STATUSES)
    + ", o_orderstatus AS back FROM orders",
)
def _(spark, sf):
    flags = features.one_hot(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", STATUSES, "S")
    back = features.from_one_hot(flags, STATUSES, "S", "back").drop("o_orderstatus")
    return back.withColumns({f"S_{s}": F.col(f"S_{s}").cast("bigint") for s in STATUSES})


SCALED = ["balance", "orders_made", "mean_price"]


@query(
    "m3_standardise",
    f"WITH {CLIENTS_SQL} SELECT id, "
    + ", ".join(f"round(({c} - (SELECT avg({c}) FROM clients)) / (SELECT stddev_pop({c}) FROM clients), 6) AS {c}" for c in SCALED)
    + " FROM clients",
)
def _(spark, sf):
    return rounded(features.standardise(clients(spark, sf), SCALED), 6, *SCALED)


@query(
    "m4_inflation_pair",
    f"""WITH {DELIVERIES_SQL}, s AS (SELECT sum(price * price) AS a, sum(range_km * range_km) AS b, sum(price * range_km) AS c FROM deliveries)
        SELECT unnest(['price', 'range_km']) AS "column", round(1 / (1 - c * c / (a * b)), 6) AS vif, CAST(1 / (1 - c * c / (a * b)) <= 30 AS BIGINT) AS kept FROM s""",
)
def _(spark, sf):
    v = features.variance_inflation(deliveries(spark, sf), ["price", "range_km"])
    return rounded(v.withColumn("kept", F.col("kept").cast("bigint")), 6, "vif")


@query("m4_inflation")
def _(spark, sf):
    return features.variance_inflation(
        deliveries(spark, sf), ["price", "battery_kwh", "range_km", "stations", "co2", "production", "year", "month"]
    )


MI_COLUMNS = ["price", "range_km", "stations", "month"]


@query(
    "m5_mutual_information",
    f"WITH {DELIVERIES_SQL}, q AS (SELECT "
    + ", ".join(
        f"quantile_cont({c}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q_{c}" for c in [*MI_COLUMNS, "deliveries"]
    )
    + " FROM deliveries), b AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, len(list_filter(q_{c}, lambda e: e <= {c})) AS x, "
        "len(list_filter(q_deliveries, lambda e: e <= deliveries)) AS y FROM deliveries, q"
        for c in MI_COLUMNS
    )
    + """), c AS (SELECT feature, x, y, count(*) AS n FROM b GROUP BY ALL),
    t AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS t, sum(n) OVER (PARTITION BY feature, x) AS nx, sum(n) OVER (PARTITION BY feature, y) AS ny FROM c)
    SELECT feature, round(sum(n / t * ln(n * t / (nx * ny))), 6) AS mi FROM t GROUP BY feature""",
)
def _(spark, sf):
    return rounded(features.mutual_information(deliveries(spark, sf), MI_COLUMNS, "deliveries"), 6, "mi")


# every pair of rows by definition; digamma of a whole number is a harmonic sum less Euler's constant
NEIGHBOUR_SQL = f"""WITH {DELIVERIES_SQL},
    c AS (SELECT stddev_pop(deliveries) AS sy, {", ".join(f"stddev_pop({c}) AS s_{c}" for c in MI_COLUMNS)} FROM deliveries),
    p AS ({" UNION ALL ".join(
        f"SELECT '{c}' AS feature, row_number() OVER () AS i, {c} / CAST(2 AS DOUBLE) ** round(log2(s_{c})) AS x, "
        "deliveries / CAST(2 AS DOUBLE) ** round(log2(sy)) AS y FROM deliveries, c"
        for c in MI_COLUMNS
    )}),
    g AS (SELECT feature, x, y, count(*) AS n FROM p GROUP BY ALL),
    d AS (SELECT a.feature, a.x, a.y, a.n, greatest(abs(b.x - a.x), abs(b.y - a.y)) AS d,
            CASE WHEN a.x = b.x AND a.y = b.y THEN b.n - 1 ELSE b.n END AS m FROM g a JOIN g b ON a.feature = b.feature),
    w AS (SELECT *, sum(m) OVER (PARTITION BY feature, x, y ORDER BY d) AS upto FROM d),
    r AS (SELECT feature, x, y, n, min(d) AS d FROM w WHERE upto >= 3 GROUP BY ALL),
    e AS (SELECT r.feature, r.x, r.y, r.n, sum(CASE WHEN (r.d > 0 AND abs(b.x - r.x) < r.d) OR b.x = r.x THEN b.n ELSE 0 END) AS nx,
            sum(CASE WHEN (r.d > 0 AND abs(b.y - r.y) < r.d) OR b.y = r.y THEN b.n ELSE 0 END) AS ny
          FROM r JOIN g b ON r.feature = b.feature GROUP BY ALL),
    h AS (SELECT i, coalesce(sum(1.0 / i) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS h
          FROM (SELECT unnest(range(1, (SELECT count(*) + 2 FROM deliveries))) AS i))
    SELECT e.feature, round(greatest(max(hn.h) + 1.5 - sum(e.n * (hx.h + hy.h)) / sum(e.n), 0), 6) AS mi
    FROM e JOIN h hx ON hx.i = e.nx JOIN h hy ON hy.i = e.ny JOIN h hn ON hn.i = (SELECT count(*) FROM deliveries) GROUP BY e.feature"""


@query("m5_neighbour_information", NEIGHBOUR_SQL)
def _(spark, sf):
    return rounded(dependence.neighbour_information(deliveries(spark, sf), MI_COLUMNS, "deliveries"), 6, "mi")


FIT_SQL = f"""WITH {DELIVERIES_SQL}, s AS (SELECT count(*) AS n, avg(production) AS mx, avg(deliveries) AS my, stddev_pop(production) AS sd,
    covar_pop(production, deliveries) AS c FROM deliveries), w AS (SELECT *, {{w}} AS w FROM s)
    SELECT '(intercept)' AS term, round(my, 5) AS weight, round(my - w / sd * mx, 5) AS coefficient FROM w
    UNION ALL SELECT 'production', round(w, 5), round(w / sd, 5) FROM w"""


@query("m6_linear", FIT_SQL.format(w="c / sd"))
def _(spark, sf):
    return rounded(features.linear_fit(deliveries(spark, sf), ["production"], "deliveries"), 5, "weight", "coefficient")


@query("m6_ridge", FIT_SQL.format(w="c / sd / (1 + 10.0 / n)"))
def _(spark, sf):
    return rounded(features.linear_fit(deliveries(spark, sf), ["production"], "deliveries", ridge=10.0), 5, "weight", "coefficient")


@query(
    "m6_linear_pair",
    f"""WITH {DELIVERIES_SQL}, s AS (SELECT var_pop(production) AS a, var_pop(price) AS b, covar_pop(production, price) AS c,
        covar_pop(production, deliveries) AS u, covar_pop(price, deliveries) AS v, avg(production) AS m1, avg(price) AS m2, avg(deliveries) AS my FROM deliveries),
        w AS (SELECT *, (u * b - v * c) / (a * b - c * c) AS w1, (v * a - u * c) / (a * b - c * c) AS w2 FROM s)
        SELECT '(intercept)' AS term, round(my - w1 * m1 - w2 * m2, 4) AS coefficient FROM w
        UNION ALL SELECT 'production', round(w1, 4) FROM w UNION ALL SELECT 'price', round(w2, 4) FROM w""",
)
def _(spark, sf):
    fit = features.linear_fit(deliveries(spark, sf), ["production", "price"], "deliveries")
    return rounded(fit.select("term", "coefficient"), 4, "coefficient")


@query(
    "m6_lasso",
    f"""WITH {DELIVERIES_SQL}, s AS (SELECT covar_pop(production, deliveries) / stddev_pop(production) AS b FROM deliveries)
        SELECT round(sign(b) * greatest(abs(b) - 50, 0), 3) AS weight FROM s""",
)
def _(spark, sf):
    data = features.standardise(deliveries(spark, sf).select("production", F.col("deliveries").alias("label")), ["production"])
    ready = VectorAssembler(inputCols=["production"], outputCol="features").transform(data)
    model = features.lasso_model().fit(ready)
    return spark.createDataFrame([(round(float(model.coefficients[0]), 3),)], "weight double")


def _matrix(spark, sf):
    """Features without anything computed from the target; production is left out for the same reason."""
    rows = deliveries(spark, sf).drop("range_km", "co2", "production")
    return cut(features.feature_matrix(rows, "deliveries", LEFT_OUT, keep=["date", "region", "model"]))


@query("m7_random_forest")
def _(spark, sf):
    data = ordering.chronological_split(_matrix(spark, sf), *KEYS)
    train, test = data.filter("role = 'train'"), data.filter("role = 'test'")
    p = models.fit_predict(models.random_forest(), train, test, "forest")
    return p.select("region", "model", F.col("date").cast("string").alias("date"), "y", "p")


@query("m7_importances")
def _(spark, sf):
    rows = deliveries(spark, sf).drop("range_km", "co2", "production", "date", "region", "model")
    names = features.numeric_features(rows, ["deliveries", *LEFT_OUT])
    fitted = models.random_forest().fit(features.feature_matrix(rows, "deliveries", LEFT_OUT))
    return models.importances(spark, fitted, names)


@query("m8_boosted_trees")
def _(spark, sf):
    data = ordering.chronological_split(_matrix(spark, sf), *KEYS)
    train, test = data.filter("role = 'train'"), data.filter("role = 'test'")
    p = models.fit_predict(models.boosted_trees(), train, test, "boosted")
    return p.select("region", "model", F.col("date").cast("string").alias("date"), "y", "p")


@query("m8_penalised_trees")
def _(spark, sf):
    train, test = _split(_features(spark, sf))
    p = models.fit_predict(PenalisedTrees(), train, test, "penalised")
    return p.select("region", "model", F.col("date").cast("string").alias("date"), "y", "p")


LAGS = [f"{c}_lag_{k}" for c in ("deliveries", "price") for k in (1, 3, 6)]
ROLLED = [f"deliveries_{s}_{n}" for n in (3, 6) for s in ("mean", "std")]
MADE = ["quarter", "week", "is_q4", "year_progress", "log_price", "price_x_range", "battery_x_range", "range_per_kwh"]


def _modelled(spark, sf):
    return features.modelling_features(deliveries(spark, sf), ["region", "model"], "date", "deliveries", "price")


@query(
    "m12_modelling_features",
    f"""WITH {DELIVERIES_SQL}, wide AS (
        SELECT region, model, CAST(date AS VARCHAR) AS date, deliveries, price, """
    + ", ".join(f"lag({c}, {k}) OVER own AS {c}_lag_{k}" for c in ("deliveries", "price") for k in (1, 3, 6))
    + ", "
    + ", ".join(
        f"avg(deliveries) OVER (own ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS deliveries_mean_{n}, "
        f"coalesce(stddev_samp(deliveries) OVER (own ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 0) AS deliveries_std_{n}"
        for n in (3, 6)
    )
    + """, quarter(date) AS quarter, weekofyear(date) AS week, CAST(quarter(date) = 4 AS BIGINT) AS is_q4,
        (month - 1) / 11.0 AS year_progress, ln(1 + price) AS log_price, price * range_km AS price_x_range,
        battery_kwh * range_km AS battery_x_range, CASE WHEN battery_kwh <> 0 THEN range_km / battery_kwh END AS range_per_kwh
        FROM deliveries WINDOW own AS (PARTITION BY region, model ORDER BY deliveries.date))
        SELECT region, model, date, """
    + ", ".join(f"round(CAST({c} AS DOUBLE), 4) AS {c}" for c in [*LAGS, *ROLLED, *MADE])
    + " FROM wide WHERE deliveries_lag_6 IS NOT NULL AND range_per_kwh IS NOT NULL",
)
def _(spark, sf):
    rows = _modelled(spark, sf)
    numbers = [F.round(F.col(c).cast("double"), 4).alias(c) for c in [*LAGS, *ROLLED, *MADE]]
    return rows.select("region", "model", F.col("date").cast("string").alias("date"), *numbers)


def _features(spark, sf):
    """The matrix of the model stage: all modelling features but what is computed from this month's target."""
    rows = _modelled(spark, sf).drop("co2", "production")
    return cut(features.feature_matrix(rows, "deliveries", LEFT_OUT, keep=["date", "region", "model"]))


def _split(data):
    rows = ordering.chronological_split(data, *KEYS)
    return cut(rows.filter("role = 'train'")), cut(rows.filter("role = 'test'"))


def _compared(spark, sf):
    """Predictions of the six models for the last fifth of the months."""
    return cut(models.all_predictions(models.six_models(), *_split(_features(spark, sf))))


@query("m11_model_leaderboard")
def _(spark, sf):
    return rounded(agg.leaderboard(_compared(spark, sf)), 6, "mae", "rmse", "r2")


@query("a14_model_residuals")
def _(spark, sf):
    return rounded(agg.residual_profile(_compared(spark, sf)), 6, "rmse")


@query("m9_cross_validation")
def _(spark, sf):
    train, _ = _split(_features(spark, sf))
    folds = cut(models.contiguous_roles(ordering.contiguous_folds(train.drop("row_index", "role"), *KEYS)))
    return models.cross_validate(models.six_models(), folds)


@query("m9_search")
def _(spark, sf):
    train, _ = _split(_features(spark, sf))
    return models.search_boosted(cut(ordering.expanding_folds(train.drop("row_index", "role"), *KEYS)))


@query("m10_learning_curve")
def _(spark, sf):
    return models.learning_curve(features.scaled(features.lasso_model()), _matrix(spark, sf), KEYS)


@query("m12_feature_matrix")
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    m = features.feature_matrix(deliveries(spark, sf), "deliveries", ["year", "month", "production"], keep=["date", "region", "model"])
    v = vector_to_array("features")
    return m.select("region", "model", F.col("date").cast("string").alias("date"), "label", F.size(v).alias("width"), F.round(arr.total(v), 3).alias("total"))


@query("s7_model_round_trip")
def _(spark, sf):
    # the fit reads its rows many times: written once, the months are not summed up again from the lines
    data = cut(deliveries(spark, sf).select("region", "model", "date", "price", "stations", F.col("deliveries").cast("double").alias("label")))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["price", "stations"], outputCol="features"), features.scaled(features.lasso_model(alpha=1.0))])
    root = scratch_path(spark, "models")
    files.save_model(pipe.fit(data), root, "lasso")
    scored = files.load_model(root, "lasso").transform(data)
    return scored.select("region", "model", F.col("date").cast("string").alias("date"), "label", "prediction")


# ---- clustering


def _scaled_clients(spark, sf):
    return cluster.with_vector(features.standardise(clients(spark, sf), SCALED), SCALED)


@query("c1_kmeans_inertia")
def _(spark, sf):
    return cluster.kmeans_inertia(cut(_scaled_clients(spark, sf)))


@query("c1_kmeans_labels")
def _(spark, sf):
    return cluster.kmeans_labels(cut(_scaled_clients(spark, sf)), 3).select("id", "cluster")


CENTRES_SQL = """cells AS (SELECT vec_id, label, unnest(CAST(embedding AS DOUBLE[])) AS v, unnest(range(len(embedding))) AS i FROM embeddings),
    means AS (SELECT label AS centroid, i, avg(v) AS m FROM cells GROUP BY ALL),
    dist AS (SELECT vec_id, centroid, sum((v - m) * (v - m)) AS d FROM cells JOIN means USING (i) GROUP BY ALL)"""


@query(
    "c1_assignment",
    f"WITH {CENTRES_SQL} SELECT vec_id, CAST(arg_min(centroid, d) AS BIGINT) AS cluster, round(min(d), 6) AS distance2 FROM dist GROUP BY vec_id",
)
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    out = cluster.nearest_centroid(e, "embedding", cluster.label_centroids(e, "embedding", "label"))
    return out.select("vec_id", F.col("cluster").cast("bigint").alias("cluster"), F.round("distance2", 6).alias("distance2"))


@query(
    "c1_inertia_given",
    f"WITH {CENTRES_SQL}, best AS (SELECT vec_id, arg_min(centroid, d) AS c, min(d) AS d FROM dist GROUP BY vec_id) "
    "SELECT CAST(c AS BIGINT) AS cluster, CAST(count(*) AS BIGINT) AS n, round(sum(d), 5) AS inertia FROM best GROUP BY c",
)
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    out = cluster.nearest_centroid(e, "embedding", cluster.label_centroids(e, "embedding", "label"))
    return out.groupBy(F.col("cluster").cast("bigint").alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("distance2"), 5).alias("inertia")
    )


@query(
    "c2_silhouette",
    """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
       s AS (SELECT label, count(*) AS n FROM e GROUP BY 1),
       d AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.v, b.v)) AS t FROM e a, e b GROUP BY ALL),
       m AS (SELECT vec_id, own, max(CASE WHEN own = other THEN t / (n - 1) END) AS a, min(CASE WHEN own <> other THEN t / n END) AS b
             FROM d JOIN s ON other = s.label GROUP BY ALL)
       SELECT vec_id AS id, round((b - a) / greatest(a, b), 6) AS silhouette FROM m""",
)
def _(spark, sf):
    rows = cluster.silhouette_rows(table(spark, sf, "embeddings"), "vec_id", "embedding", "label")
    return rounded(rows.select("id", "silhouette"), 6, "silhouette")


@query("c2_silhouette_squared")
def _(spark, sf):
    labelled = cluster.kmeans_labels(cut(_scaled_clients(spark, sf)), 3)
    return spark.createDataFrame([(3, cluster.silhouette_squared(labelled))], "k int, silhouette double")


DENSITY_SQL = f"""WITH RECURSIVE {CLIENTS_SQL},
    z AS (SELECT id, (balance - avg(balance) OVER ()) / stddev_pop(balance) OVER () AS x1,
          (orders_made - avg(orders_made) OVER ()) / stddev_pop(orders_made) OVER () AS x2,
          (mean_price - avg(mean_price) OVER ()) / stddev_pop(mean_price) OVER () AS x3 FROM clients),
    near AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM z a, z b
        WHERE pow(a.x1 - b.x1, 2) + pow(a.x2 - b.x2, 2) + pow(a.x3 - b.x3, 2) <= {{eps}} * {{eps}}),
    core AS MATERIALIZED (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 5),
    links AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
    cc(id, label) USING KEY (id) AS (
        SELECT id, id AS label FROM core
        UNION
        SELECT l.a AS id, min(c.label) AS label FROM cc c JOIN links l ON c.id = l.b JOIN recurring.cc old ON old.id = l.a
        GROUP BY l.a HAVING min(c.label) < min(old.label)),
    edge AS (SELECT a AS id, min(label) AS label FROM near JOIN cc ON cc.id = b WHERE a NOT IN (SELECT id FROM core) GROUP BY a)
    SELECT z.id AS id, CAST(coalesce(cc.label, edge.label, -1) AS BIGINT) AS label, CAST(cc.id IS NOT NULL AS BIGINT) AS core
    FROM z LEFT JOIN cc ON z.id = cc.id LEFT JOIN edge ON z.id = edge.id"""


@query("c3_density_clusters", DENSITY_SQL.format(eps=0.35))
def _(spark, sf):
    scaled = features.standardise(clients(spark, sf), SCALED)
    out = cluster.density_clusters(scaled, "id", SCALED, eps=0.35, min_points=5)
    return out.withColumn("core", F.col("core").cast("bigint"))


@query("c4_principal_components")
def _(spark, sf):
    pc = linalg.principal_components(table(spark, sf, "embeddings"), "embedding", 2)
    return pc.select("vec_id", F.col("pc")[0].alias("pc1"), F.col("pc")[1].alias("pc2"))


# ---- linear algebra


@query("v1_singular_values")
def _(spark, sf):
    return linalg.singular_values(table(spark, sf, "embeddings"), "embedding", 5)


@query("v1_rank_one_error")
def _(spark, sf):
    rows = linalg.low_rank(table(spark, sf, "embeddings"), "embedding", 1)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.avg(arr.mean_square("rebuilt", arr.doubles("embedding"))).alias("mse"))


CELLS = "SELECT vec_id AS i, unnest(range(len(embedding))) AS j, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings"


@query(
    "v1_spectral_sums",
    f"""WITH a AS ({CELLS}), g AS (SELECT x.j AS i, y.j AS j, sum(x.v * y.v) AS v FROM a x JOIN a y ON x.i = y.i GROUP BY x.j, y.j)
        SELECT CAST((SELECT count(DISTINCT j) FROM a) AS BIGINT) AS n, round(sum(v) FILTER (i = j), 3) AS squares, round(sqrt(sum(v * v)), 3) AS fourth FROM g""",
)
def _(spark, sf):
    found = linalg.singular_values(table(spark, sf, "embeddings"), "embedding", 10_000)
    s2 = F.col("singular_value") * F.col("singular_value")
    sums = found.agg(F.count(F.lit(1)).alias("n"), F.sum(s2).alias("squares"), F.sqrt(F.sum(s2 * s2)).alias("fourth"))
    return rounded(sums, 3, "squares", "fourth")


@query("v2_matrix_sum", f"WITH a AS ({CELLS}) SELECT i, j, round(v + 2.5 * v, 6) AS v FROM a")
def _(spark, sf):
    a = linalg.matrix_rows(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return rounded(linalg.matrix_add(a, linalg.matrix_scale(a, 2.5)), 6, "v")


@query("v2_elementwise", f"WITH a AS ({CELLS}) SELECT i, j, round(v * v, 8) AS v FROM a")
def _(spark, sf):
    a = linalg.matrix_rows(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return rounded(linalg.matrix_hadamard(a, a), 8, "v")


@query(
    "v2_matrix_product",
    f"""WITH a AS ({CELLS}), w AS (SELECT label AS l, j, avg(v) AS v FROM a JOIN embeddings ON i = vec_id GROUP BY ALL)
        SELECT a.i AS i, CAST(w.l AS BIGINT) AS j, round(sum(a.v * w.v), 6) AS v FROM a JOIN w ON a.j = w.j GROUP BY ALL""",
)
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    centres = cluster.label_centroids(e, "embedding", "label").select(F.col("centroid").cast("bigint").alias("centroid"), "centre")
    weights = linalg.matrix_transpose(linalg.matrix_rows(centres, "centroid", "centre"))
    return rounded(linalg.matrix_product(linalg.matrix_rows(e, "vec_id", "embedding"), weights), 6, "v")


@query(
    "v3_dot_norm",
    """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
       SELECT vec_id, round(list_dot_product(v, list_reverse(v)), 6) AS mirrored, round(sqrt(list_dot_product(v, v)), 6) AS length FROM e""",
)
def _(spark, sf):
    v = arr.doubles("embedding")
    return table(spark, sf, "embeddings").select(
        "vec_id", F.round(arr.dot(v, F.reverse(v)), 6).alias("mirrored"), F.round(arr.norm(v), 6).alias("length")
    )


@query(
    "v4_gram",
    f"WITH a AS ({CELLS}) SELECT x.j AS i, y.j AS j, round(sum(x.v * y.v), 5) AS v FROM a x JOIN a y ON x.i = y.i GROUP BY x.j, y.j",
)
def _(spark, sf):
    return rounded(linalg.gram_cells(table(spark, sf, "embeddings"), "embedding"), 5, "v")


@query("v4_eigenpairs")
def _(spark, sf):
    return linalg.eigen_table(table(spark, sf, "embeddings"), "embedding").select("component", "value", "residual")


# ---- networks, denoising


@query("n1_network_accuracy")
def _(spark, sf):
    return models.network_accuracy(table(spark, sf, "embeddings"), "vec_id", "embedding", "label", [64, 32, 10])


@query("n2_denoise")
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    unit = e.select("vec_id", F.transform(arr.doubles("embedding"), lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x + 0.5))).alias("v"))
    return models.denoise(unit, "vec_id", "v")
