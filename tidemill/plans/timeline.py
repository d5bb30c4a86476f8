"""Queries: windows, time series, folds, forecasts and residuals."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import aggregates as agg
from tidemill.operators import ordering, series
from tidemill.plans.registry import query
from tidemill.plans.views import DELIVERIES_SQL, MONTHLY_SQL, deliveries

BY = ["region", "model"]
DATE = "CAST(date AS VARCHAR) AS date"


def day_text(df):
    return df.withColumn("date", F.col("date").cast("string"))


def rounded(df, places, *columns):
    return df.withColumns({c: F.round(c, places) for c in columns})


@query(
    "t1_lags",
    f"WITH {DELIVERIES_SQL} SELECT region, model, {DATE}, "
    + ", ".join(
        f"lag({c}, {k}) OVER (PARTITION BY region, model ORDER BY deliveries.date) AS {c}_lag_{k}"
        for c in ("deliveries", "production") for k in (1, 3, 6)
    )
    + " FROM deliveries",
)
def _(spark, sf):
    rows = series.lag_features(deliveries(spark, sf), BY, "date", ["deliveries", "production"])
    names = [f"{c}_lag_{k}" for c in ("deliveries", "production") for k in (1, 3, 6)]
    return day_text(rows).select(*BY, "date", *names)


@query(
    "t2_rolling_stats",
    f"WITH {DELIVERIES_SQL} SELECT region, model, {DATE}, "
    + ", ".join(
        f"round(avg(deliveries) OVER w{n}, 4) AS deliveries_mean_{n}, "
        f"round(coalesce(stddev_samp(deliveries) OVER w{n}, 0), 4) AS deliveries_std_{n}"
        for n in (3, 6)
    )
    + " FROM deliveries WINDOW "
    + ", ".join(
        f"w{n} AS (PARTITION BY region, model ORDER BY deliveries.date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)" for n in (3, 6)
    ),
)
def _(spark, sf):
    rows = series.rolling_features(deliveries(spark, sf), BY, "date", "deliveries")
    names = [f"deliveries_{s}_{n}" for n in (3, 6) for s in ("mean", "std")]
    return rounded(day_text(rows).select(*BY, "date", *names), 4, *names)


REGULAR_SQL = f"""{DELIVERIES_SQL}, {MONTHLY_SQL},
span AS (SELECT region, model, min(date) AS a, max(date) AS b FROM monthly GROUP BY ALL),
months AS (SELECT region, model, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS date FROM span),
regular AS (SELECT months.region, months.model, months.date, y FROM months LEFT JOIN monthly USING (region, model, date)),
series AS (SELECT region, model, date, coalesce(y, 0.0) AS y FROM regular)"""


def regular(spark, sf):
    return series.regular_monthly(deliveries(spark, sf), BY, "date", "deliveries")


def filled(spark, sf):
    """Regular series in which a month without deliveries counts as 0."""
    return regular(spark, sf).withColumn("y", F.coalesce("y", F.lit(0.0)))


@query("t3_regular_series", f"WITH {REGULAR_SQL} SELECT region, model, {DATE}, y FROM regular")
def _(spark, sf):
    return day_text(regular(spark, sf))


@query(
    "t4_first_difference",
    f"""WITH {REGULAR_SQL} SELECT region, model, CAST(d AS VARCHAR) AS date, diff FROM
        (SELECT region, model, date AS d, y - lag(y) OVER (PARTITION BY region, model ORDER BY date) AS diff FROM series)
        WHERE diff IS NOT NULL""",
)
def _(spark, sf):
    return day_text(series.first_difference(filled(spark, sf), BY, "date", "y")).select(*BY, "date", "diff")


@query(
    "t5_decompose",
    f"""WITH {REGULAR_SQL},
    base AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY region, model) AS n,
        (lag(y, 6) OVER w / 24 + (lag(y, 5) OVER w + lag(y, 4) OVER w + lag(y, 3) OVER w + lag(y, 2) OVER w + lag(y, 1) OVER w
         + y + lead(y, 1) OVER w + lead(y, 2) OVER w + lead(y, 3) OVER w + lead(y, 4) OVER w + lead(y, 5) OVER w) / 12
         + lead(y, 6) OVER w / 24) AS core
        FROM series WINDOW w AS (PARTITION BY region, model ORDER BY date)),
    lines AS (SELECT region, model,
        regr_slope(core, i) FILTER (i BETWEEN 6 AND 17) AS hs, regr_intercept(core, i) FILTER (i BETWEEN 6 AND 17) AS hi,
        regr_slope(core, i) FILTER (i BETWEEN n - 18 AND n - 7) AS ts, regr_intercept(core, i) FILTER (i BETWEEN n - 18 AND n - 7) AS ti
        FROM base GROUP BY ALL),
    flat AS (SELECT base.*, i % 12 AS phase, CASE WHEN i < 6 THEN hs * i + hi WHEN i >= n - 6 THEN ts * i + ti ELSE core END AS trend
        FROM base JOIN lines USING (region, model)),
    raw AS (SELECT region, model, phase, avg(y - trend) AS r FROM flat GROUP BY ALL),
    seasons AS (SELECT region, model, phase, r - avg(r) OVER (PARTITION BY region, model) AS seasonal FROM raw)
    SELECT region, model, CAST(date AS VARCHAR) AS date, round(trend, 4) AS trend, round(seasonal, 4) AS seasonal,
           round(y - trend - seasonal, 4) AS residual
    FROM flat JOIN seasons USING (region, model, phase)""",
)
def _(spark, sf):
    parts = day_text(series.decompose(filled(spark, sf), BY, "date", "y")).drop("y")
    return rounded(parts, 4, "trend", "seasonal", "residual")


@query(
    "t6_autocorrelation",
    f"""WITH {REGULAR_SQL},
    d AS (SELECT region, model, row_number() OVER (PARTITION BY region, model ORDER BY date) AS i,
          y - avg(y) OVER (PARTITION BY region, model) AS v FROM series),
    c AS (SELECT region, model, sum(v * v) AS c0 FROM d GROUP BY ALL),
    l AS (SELECT unnest(range(37)) AS lag)
    SELECT a.region, a.model, l.lag AS lag, round(sum(a.v * b.v) / max(c0), 6) AS acf
    FROM l, d a JOIN d b ON a.region = b.region AND a.model = b.model JOIN c ON a.region = c.region AND a.model = c.model
    WHERE b.i = a.i + l.lag GROUP BY ALL""",
)
def _(spark, sf):
    acf = series.autocorrelation(filled(spark, sf), BY, "date", "y")
    return rounded(acf.withColumn("lag", F.col("lag").cast("bigint")), 6, "acf")


@query("t6_partial_autocorrelation")
def _(spark, sf):
    return series.partial_autocorrelation(filled(spark, sf), BY, "date", "y")


@query(
    "t7_unit_root_lag0",
    f"""WITH {REGULAR_SQL},
    s AS (SELECT region, model, lag(y) OVER w AS x, y - lag(y) OVER w AS d FROM series WINDOW w AS (PARTITION BY region, model ORDER BY date)),
    f AS (SELECT region, model, regr_slope(d, x) AS b, regr_sxx(d, x) AS sxx, regr_syy(d, x) AS syy, count(x) AS n FROM s WHERE x IS NOT NULL GROUP BY ALL)
    SELECT region, model, CAST(n AS BIGINT) AS n, round(b, 6) AS slope, round(b / sqrt((syy - b * b * sxx) / (n - 2) / sxx), 6) AS t FROM f""",
)
def _(spark, sf):
    return rounded(series.unit_root_lag0(filled(spark, sf), BY, "date", "y"), 6, "slope", "t")


@query("t7_unit_root")
def _(spark, sf):
    return series.unit_root(filled(spark, sf), BY, "date", "y")


@query("t8_seasonal_forecast")
def _(spark, sf):
    return day_text(series.seasonal_forecast(filled(spark, sf), BY, "date", "y"))


@query("t9_trend_changes")
def _(spark, sf):
    return day_text(series.trend_changes(filled(spark, sf), BY, "date", "y"))


@query("t9_fourier_forecast")
def _(spark, sf):
    return day_text(series.trend_fourier_forecast(filled(spark, sf), BY, "date", "y"))


KEYS = ["date", "region", "model"]


@query(
    "t10_chronological_split",
    f"""WITH {DELIVERIES_SQL}, i AS (SELECT region, model, date, row_number() OVER (ORDER BY date, region, model) - 1 AS row_index,
        count(*) OVER () AS n FROM deliveries)
        SELECT region, model, {DATE}, row_index, CASE WHEN row_index < floor(n * 0.8) THEN 'train' ELSE 'test' END AS role FROM i""",
)
def _(spark, sf):
    rows = deliveries(spark, sf).select("region", "model", "date")
    return day_text(ordering.chronological_split(rows, *KEYS))


@query(
    "t11_contiguous_folds",
    f"""WITH {DELIVERIES_SQL}, i AS (SELECT region, model, date, row_number() OVER (ORDER BY date, region, model) - 1 AS row_index,
        count(*) OVER () AS n FROM deliveries)
        SELECT region, model, {DATE}, CAST(CASE WHEN row_index < (n % 5) * (n // 5 + 1) THEN row_index // (n // 5 + 1)
               ELSE n % 5 + (row_index - (n % 5) * (n // 5 + 1)) // (n // 5) END AS BIGINT) AS fold FROM i""",
)
def _(spark, sf):
    rows = deliveries(spark, sf).select("region", "model", "date")
    folds = ordering.contiguous_folds(rows, *KEYS)
    return day_text(folds).drop("row_index").withColumn("fold", F.col("fold").cast("bigint"))


@query(
    "t11_expanding_folds",
    f"""WITH {DELIVERIES_SQL}, i AS (SELECT region, model, date, row_number() OVER (ORDER BY date, region, model) - 1 AS r,
        count(*) OVER () AS n FROM deliveries), f AS (SELECT *, unnest(range(5)) AS fold FROM i)
        SELECT region, model, {DATE}, fold, CASE WHEN r < n - (5 - fold) * (n // 6) THEN 'train' ELSE 'test' END AS role
        FROM f WHERE r < n - (4 - fold) * (n // 6)""",
)
def _(spark, sf):
    rows = deliveries(spark, sf).select("region", "model", "date")
    folds = ordering.expanding_folds(rows, *KEYS)
    return day_text(folds).drop("row_index").withColumn("fold", F.col("fold").cast("bigint"))


@query("j5_forecast_alignment")
def _(spark, sf):
    data = filled(spark, sf)
    a = series.seasonal_forecast(data, BY, "date", "y")
    b = series.trend_fourier_forecast(data, BY, "date", "y")
    return day_text(series.align_forecasts(a, b, [*BY, "date"]))


ALIGN_SQL = f"""WITH {REGULAR_SQL}, w AS (SELECT region, model, date AS d, y, lag(y) OVER o AS a,
    avg(y) OVER (o ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS b FROM series WINDOW o AS (PARTITION BY region, model ORDER BY date)),
    p AS (SELECT region, model, d, 'last_value' AS model_name, y, a AS p FROM w WHERE a IS NOT NULL
          UNION ALL SELECT region, model, d, 'mean_of_three', y, b FROM w WHERE a IS NOT NULL)"""


@query(
    "j5_prediction_alignment",
    ALIGN_SQL + """ SELECT l.region, l.model, CAST(l.d AS VARCHAR) AS date, l.p AS last_p, round(m.p, 6) AS mean_p
        FROM p l JOIN p m ON l.region = m.region AND l.model = m.model AND l.d = m.d
        WHERE l.model_name = 'last_value' AND m.model_name = 'mean_of_three'""",
)
def _(spark, sf):
    p = series.naive_predictions(filled(spark, sf), BY, "date", "y")

    def one(name):
        bounds = {m: F.col("p") for m in ("mean", "lower", "upper")}
        return p.filter(F.col("model_name") == name).withColumns(bounds)

    both = series.align_forecasts(one("last_value"), one("mean_of_three"), [*BY, "date"], ("last", "three"))
    return day_text(both).select(*BY, "date", F.col("last_mean").alias("last_p"), F.round("three_mean", 6).alias("mean_p"))


@query(
    "a14_residual_profile",
    ALIGN_SQL + """, r AS (SELECT model_name, y - p AS e FROM p),
        s AS (SELECT model_name, min(e) AS lo, (max(e) - min(e)) / 35.0 AS w, sqrt(avg(e * e)) AS rmse FROM r GROUP BY 1)
        SELECT model_name, CAST(least(floor((e - lo) / w), 34) AS BIGINT) AS bin, CAST(count(*) AS BIGINT) AS n, round(max(rmse), 6) AS rmse
        FROM r JOIN s USING (model_name) GROUP BY 1, 2""",
)
def _(spark, sf):
    p = series.naive_predictions(filled(spark, sf), BY, "date", "y")
    return rounded(agg.residual_profile(p), 6, "rmse")


@query(
    "m11_leaderboard",
    ALIGN_SQL + """, m AS (SELECT model_name, count(*) AS n, avg(abs(y - p)) AS mae, avg((y - p) * (y - p)) AS mse, var_pop(y) AS v FROM p GROUP BY 1)
        SELECT model_name, CAST(n AS BIGINT) AS n, round(mae, 6) AS mae, round(sqrt(mse), 6) AS rmse, round(1 - mse / v, 6) AS r2,
               CAST(mse / v = (SELECT min(mse / v) FROM m) AS BIGINT) AS best FROM m""",
)
def _(spark, sf):
    board = agg.leaderboard(series.naive_predictions(filled(spark, sf), BY, "date", "y"))
    board = board.select("model_name", "n", "mae", "rmse", "r2", F.col("best").cast("bigint").alias("best"))
    return rounded(board, 6, "mae", "rmse", "r2")


