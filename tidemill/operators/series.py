"""Many monthly series at once: lags, rolling statistics, decomposition, tests and forecasts.

All inputs hold one row per series and month, so a window or a grouped pandas call never sees
more rows than there are months in the calendar, however many source rows a series had: the
monthly sum is combined before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators import arima

# Normal quantile for a two-sided 80 % interval.
Z80 = 1.2815515655446004


def regular_monthly(df: DataFrame, by: Sequence[str], date: str, y: str) -> DataFrame:
    """Sum per series and month; months missing between first and last come in as null."""
    by = list(by)
    sums = df.groupBy(*by, F.trunc(F.col(date), "month").alias("date")).agg(F.sum(y).cast("double").alias("y"))
    spans = sums.groupBy(*by).agg(F.min("date").alias("__a"), F.max("date").alias("__b"))
    months = spans.select(*by, F.explode(F.sequence("__a", "__b", F.expr("interval 1 month"))).alias("date"))
    return months.join(sums, [*by, "date"], "left")


def _window(by, date):
    return Window.partitionBy(*by).orderBy(date)


def lag_features(df: DataFrame, by: Sequence[str], date: str, columns: Sequence[str], lags=(1, 3, 6)) -> DataFrame:
    """Values `k` rows back (rows, not months)."""
    w = _window(by, date)
    return df.withColumns({f"{c}_lag_{k}": F.lag(c, k).over(w) for c in columns for k in lags})


def rolling_features(df: DataFrame, by: Sequence[str], date: str, column: str, sizes=(3, 6)) -> DataFrame:
    """Mean and deviation of the previous rows, the current one left out; a missing deviation is 0."""
    out = {}
    for n in sizes:
        w = _window(by, date).rowsBetween(-n, -1)
        out[f"{column}_mean_{n}"] = F.avg(column).over(w)
        out[f"{column}_std_{n}"] = F.coalesce(F.stddev_samp(column).over(w), F.lit(0.0))
    return df.withColumns(out)


def first_difference(df: DataFrame, by: Sequence[str], date: str, y: str, name: str = "diff") -> DataFrame:
    gap = F.col(y) - F.lag(y).over(_window(by, date))
    return df.withColumn(name, gap).filter(F.col(name).isNotNull())


def decompose(df: DataFrame, by: Sequence[str], date: str, y: str, period: int = 12) -> DataFrame:
    """Additive trend, season and residual for an even period.

    The trend is the centred average with half weights at both ends. Its missing ends follow
    the line through the nearest `period` trend points.
    """
    by, half = list(by), period // 2
    w = _window(by, date)
    around = w.rowsBetween(-half, half)
    ends = F.lag(y, half).over(w) + F.lead(y, half).over(w)
    base = df.select(
        *by, date, F.col(y).cast("double").alias("y"), (F.row_number().over(w) - 1).alias("i"),
        F.count(F.lit(1)).over(Window.partitionBy(*by)).alias("n"),
        ((F.sum(y).over(around) - ends / 2) / period).alias("core"),
    )
    i, n, core = F.col("i"), F.col("n"), F.col("core")
    head, tail = F.when(i < half + period, core), F.when(i >= n - half - period, core)
    lines = base.groupBy(*by).agg(
        F.regr_slope(head, i).alias("hs"), F.regr_intercept(head, i).alias("hi"),
        F.regr_slope(tail, i).alias("ts"), F.regr_intercept(tail, i).alias("ti"),
    )
    trend = (
        F.when(i < half, F.col("hs") * i + F.col("hi"))
        .when(i >= n - half, F.col("ts") * i + F.col("ti"))
        .otherwise(core)
    )
    flat = base.join(lines, by).withColumn("trend", trend).withColumn("phase", i % period)
    phases = flat.groupBy(*by, "phase").agg(F.avg(F.col("y") - F.col("trend")).alias("raw"))
    level = F.avg("raw").over(Window.partitionBy(*by))
    seasons = phases.select(*by, "phase", (F.col("raw") - level).alias("seasonal"))
    return flat.join(seasons, [*by, "phase"]).select(
        *by, date, "y", "trend", "seasonal", (F.col("y") - F.col("trend") - F.col("seasonal")).alias("residual")
    )


def autocorrelation(df: DataFrame, by: Sequence[str], date: str, y: str, lags: int = 36) -> DataFrame:
    """Biased autocorrelations 0..lags per series, all lags in one window pass."""
    by = list(by)
    centred = df.withColumn("__d", F.col(y) - F.avg(y).over(Window.partitionBy(*by)))
    w = _window(by, date)
    shifted = centred.select(
        *by, "__d", *[(F.col("__d") * F.lag("__d", k).over(w)).alias(f"p{k}") for k in range(1, lags + 1)]
    )
    sums = shifted.groupBy(*by).agg(
        F.sum(F.col("__d") * F.col("__d")).alias("c0"), *[F.sum(f"p{k}").alias(f"p{k}") for k in range(1, lags + 1)]
    )
    rows = [F.struct(F.lit(0).alias("lag"), F.lit(1.0).alias("acf"))] + [
        F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"p{k}"), F.col("c0")).alias("acf"))
        for k in range(1, lags + 1)
    ]
    return sums.select(*by, F.inline(F.array(*rows)))


def _schema(df: DataFrame, by: Sequence[str], rest: str) -> str:
    types = dict(df.dtypes)
    return ", ".join([f"`{c}` {types[c]}" for c in by] + [rest])


def _per_series(df: DataFrame, by: Sequence[str], date: str, y: str, rest: str, fn) -> DataFrame:
    """Run `fn(dates, values) -> dict of columns` on each series in date order."""
    by = list(by)

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date)
        out = pd.DataFrame(fn(pd.to_datetime(pdf[date]), pdf[y].to_numpy(dtype=float)))
        for name, value in zip(by, key):
            out[name] = value
        return out

    return df.select(*by, date, y).groupBy(*by).applyInPandas(run, _schema(df, by, rest))


def _ols(x: np.ndarray, y: np.ndarray):
    """Coefficients, residuals and the inverse normal matrix."""
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    return beta, y - x @ beta, np.linalg.pinv(x.T @ x)


def partial_autocorrelation(df: DataFrame, by: Sequence[str], date: str, y: str, lags: int = 36) -> DataFrame:
    """Partial autocorrelations by least squares on the lags, per series."""

    def solve(_dates, v):
        # every lag has a row; beyond half the series there is nothing to regress on
        top = max(min(lags, len(v) // 2 - 1), 0)
        out: list[float | None] = [1.0] + [None] * lags
        for k in range(1, top + 1):
            x = np.column_stack([np.ones(len(v) - k)] + [v[k - j : len(v) - j] for j in range(1, k + 1)])
            out[k] = float(_ols(x, v[k:])[0][-1])
        return {"lag": list(range(len(out))), "pacf": out}

    return _per_series(df, by, date, y, "lag int, pacf double", solve)


def unit_root_lag0(df: DataFrame, by: Sequence[str], date: str, y: str) -> DataFrame:
    """Dickey-Fuller t statistic with constant and no lagged differences, as plain aggregates."""
    before = F.lag(y).over(_window(by, date))
    steps = df.select(*by, before.alias("__x"), (F.col(y) - before).alias("__d")).filter(F.col("__x").isNotNull())
    fit = steps.groupBy(*by).agg(
        F.regr_slope("__d", "__x").alias("slope"), F.regr_sxx("__d", "__x").alias("sxx"),
        F.regr_syy("__d", "__x").alias("syy"), F.count(F.lit(1)).alias("n"),
    )
    noise = (F.col("syy") - F.col("slope") * F.col("slope") * F.col("sxx")) / (F.col("n") - 2)
    return fit.select(*by, "n", "slope", (F.col("slope") / F.sqrt(noise / F.col("sxx"))).alias("t"))


# Response-surface coefficients for the constant-only unit-root test.
_TAU_BOUNDS = (-18.83, -1.61, 2.74)
_TAU_SMALL = (2.1659, 1.4412, 0.038269)
_TAU_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
_TAU_5PCT = (-2.86154, -2.8903, -4.234, -40.040)


def _tau_p(t: float) -> float:
    low, mid, high = _TAU_BOUNDS
    if t <= low:
        return 0.0
    if t >= high:
        return 1.0
    z = sum(c * t**k for k, c in enumerate(_TAU_SMALL if t <= mid else _TAU_LARGE))
    return 0.5 * (1 + math.erf(z / math.sqrt(2)))


def _adf(v: np.ndarray):
    """Augmented test with the lag count of least AIC. Returns t, lag count and row count."""
    d = np.diff(v)
    most = max(min(math.ceil(12 * (len(v) / 100) ** 0.25), len(v) // 2 - 2), 0)

    def design(lags: int, skip: int):
        rows = range(skip, len(d))
        x = [[1.0, v[i]] + [d[i - j] for j in range(1, lags + 1)] for i in rows]
        return np.array(x), d[skip:]

    def aic(lags: int) -> float:
        x, y = design(lags, most)
        _, e, _ = _ols(x, y)
        return len(y) * math.log(max(float(e @ e) / len(y), 1e-300)) + 2 * x.shape[1]

    lags = min(range(most + 1), key=aic)
    x, y = design(lags, lags)
    beta, e, inv = _ols(x, y)
    noise = float(e @ e) / max(len(y) - x.shape[1], 1)
    return float(beta[1] / math.sqrt(max(noise * inv[1, 1], 1e-300))), lags, len(y)


def unit_root(df: DataFrame, by: Sequence[str], date: str, y: str, level: float = 0.05) -> DataFrame:
    """Augmented Dickey-Fuller test of each series and of its first difference.

    A form that cannot be tested has a row with null statistics and the `reason`: `short` or `constant`.
    """

    def solve(_dates, v):
        rows = []
        for form, values in (("level", v), ("difference", np.diff(v))):
            if len(values) < 8 or np.ptp(values) == 0:
                rows.append((form, None, None, len(values), None, None, None, "short" if len(values) < 8 else "constant"))
                continue
            t, lags, n = _adf(values)
            p = _tau_p(t)
            critical = sum(c / n**k for k, c in enumerate(_TAU_5PCT))
            rows.append((form, t, lags, n, p, critical, int(p < level), None))
        names = ("form", "t", "lags", "n", "p", "critical_5pct", "stationary", "reason")
        return {name: pd.Series([r[i] for r in rows], dtype=object) for i, name in enumerate(names)}

    return _per_series(
        df, by, date, y,
        "form string, t double, lags int, n int, p double, critical_5pct double, stationary int, reason string", solve,
    )


# ---- forecasts

DEFAULT_ORDER = (1, 1, 1, 1)
ORDERS = tuple(product(range(3), range(3), range(2), range(2)))


def seasonal_order_search(
    df: DataFrame, by: Sequence[str], date: str, y: str, orders=ORDERS, period: int = 12
) -> DataFrame:
    """AIC of each seasonal order per series by exact likelihood (`arima`); series times orders is the parallel axis.

    Each series is first folded into one row (months are bounded by the calendar), so the
    orders multiply rows of the size of a series, not of the source. A series that is too short for an order has a null AIC.
    """
    by = list(by)
    folded = df.groupBy(*by).agg(
        F.transform(F.sort_array(F.collect_list(F.struct(date, y))), lambda s: s[y]).alias("values")
    )
    grid = F.array(*[F.array(*[F.lit(int(o)) for o in order]) for order in orders])
    # a stated number of tasks, as rows are few and small but each takes long
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    work = folded.withColumn("ord", F.explode(grid)).repartition(tasks, *by, "ord")

    def fit(batches):
        for pdf in batches:
            scores = []
            for values, order in zip(pdf["values"], pdf["ord"]):
                v = np.asarray(values, dtype=float)
                found = arima.fit(v, [int(o) for o in order], period)
                scores.append(None if found is None else found[0])
            yield pdf.drop(columns=["values"]).assign(aic=pd.array(scores, dtype="Float64").astype(object))

    return work.mapInPandas(fit, _schema(df, by, "ord array<int>, aic double"))


def seasonal_forecast(
    df: DataFrame, by: Sequence[str], date: str, y: str, steps: int = 12, orders=ORDERS, period: int = 12
) -> DataFrame:
    """Forecast of every series with its order of least AIC, with 80 % bounds and the error of the fit.

    All orders are compared on all differenced rows, so 16 months are enough for the simplest. `method` says how a row came about:
    `seasonal` by the order search; a series too short for any order gets `seasonal_naive` (last year plus its mean yearly step), `drift` (last value plus the mean step) or `last`.
    `rmse` is the root of the mean squared residual. Bounds are null where one value says nothing of the spread.
    """
    by = list(by)
    scores = seasonal_order_search(df, by, date, y, orders, period).filter(F.col("aic").isNotNull())
    best = scores.groupBy(*by).agg(F.min_by("ord", F.struct("aic", "ord")).alias("ord"))
    joined = df.join(best, by, "left").select(*by, date, y, F.coalesce("ord", F.array(*[F.lit(i) for i in DEFAULT_ORDER])).alias("ord"))

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date)
        v = pdf[y].to_numpy(dtype=float)
        order = [int(o) for o in pdf["ord"].iloc[0]]
        fit = arima.fit(v, order, period)
        if fit is None:
            method, mean, spread, rmse = _simple_forecast(v[~np.isnan(v)], period, steps)
        else:
            method, rmse = "seasonal", math.sqrt(fit[-1])
            mean, spread = arima.project(v, fit, period, steps)
        start = pd.to_datetime(pdf[date].iloc[-1])
        dates = [(start + pd.DateOffset(months=k)).date() for k in range(1, steps + 1)]
        out = pd.DataFrame({
            "date": dates, "mean": mean, "lower": mean - Z80 * spread, "upper": mean + Z80 * spread, "method": method, "rmse": rmse,
        })
        for name, value in zip(by, key):
            out[name] = value
        return out

    return joined.groupBy(*by).applyInPandas(
        run, _schema(df, by, "date date, mean double, lower double, upper double, method string, rmse double")
    )


def _simple_forecast(v: np.ndarray, period: int, steps: int):
    """(method, points, deviations, residual error) for a series that is too short for a seasonal order."""
    ahead = np.arange(1, steps + 1)
    if len(v) > period + 1:
        change = v[period:] - v[:-period]
        years = (ahead - 1) // period + 1
        mean = v[len(v) - period + (ahead - 1) % period] + years * change.mean()
        rmse = float(np.std(change))
        return "seasonal_naive", mean, rmse * np.sqrt(years), rmse
    if len(v) > 1:
        change = np.diff(v)
        rmse = float(np.std(change)) if len(change) > 1 else None
        spread = np.full(steps, np.nan) if rmse is None else rmse * np.sqrt(ahead)
        return "drift", v[-1] + ahead * change.mean(), spread, rmse
    return "last", np.full(steps, v[-1] if len(v) else np.nan), np.full(steps, np.nan), None


def _fourier(days: np.ndarray, yearly: int, monthly: int) -> np.ndarray:
    terms = [np.ones_like(days), days / 365.25]
    for span, order in ((365.25, yearly), (30.5, monthly)):
        for k in range(1, order + 1):
            angle = 2 * np.pi * k * days / span
            terms += [np.sin(angle), np.cos(angle)]
    return np.column_stack(terms)


CHANGES = 25  # dates, evenly spread over the first part of a series, at which its slope may change
CHANGE_PART = 0.8
CHANGE_SCALE = 0.15  # spread of slope changes that the penalty expects, in units of the series' own range over its whole span


def _hinges(days: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How far each day lies behind each change, in years; 0 before it."""
    return np.maximum(days[:, None] - at[None, :], 0.0) / 365.25


def sparse_changes(gram: np.ndarray, right: np.ndarray, penalty, rounds: int = 500) -> np.ndarray:
    """Least squares with an L1 penalty (one, or one for each) by coordinate descent: the minimum of 1/2 d'Gd - r'd + penalty |d|."""
    d, penalty = np.zeros(len(right)), np.broadcast_to(penalty, len(right))
    for _ in range(rounds):
        moved = 0.0
        for j in range(len(d)):
            if gram[j, j] <= 1e-12:
                continue
            rest = right[j] - gram[j] @ d + gram[j, j] * d[j]
            new = np.sign(rest) * max(abs(rest) - penalty[j], 0.0) / gram[j, j]
            moved, d[j] = max(moved, abs(new - d[j]) * np.sqrt(gram[j, j])), new
        if moved < 1e-9:
            break
    return d


def _trend_fit(days: np.ndarray, target: np.ndarray, yearly: int, monthly: int, shrink: float, scale: float):
    """(coefficients, change days, slope changes, deviation of the residuals) of a bent line and Fourier terms.

    The line and the season are solved for every set of changes at once, so the descent runs over the changes alone. The penalty is
    the residual variance over the expected spread of changes, and no less than what keeps noise from looking like a change; the variance
    is taken again from each fit, from the freest on.
    """
    x = _fourier(days, yearly, monthly)
    ridge = np.full(x.shape[1], shrink)
    ridge[:2] = 0.0
    solve = np.linalg.solve(x.T @ x + np.diag(ridge + 1e-9), x.T) if len(days) else np.zeros((x.shape[1], 0))
    last = CHANGE_PART * (days.max() if len(days) else 0.0)
    at = np.linspace(0.0, last, min(CHANGES, max(int(CHANGE_PART * len(days)) - 1, 0)) + 1)[1:]
    h = _hinges(days, at)
    inner = h - x @ (solve @ h)
    gram, right = h.T @ inner, inner.T @ target
    spread = float(np.ptp(target)) if len(target) else 0.0
    d = np.zeros(len(at))
    if len(at) and spread > 0:
        span = max(float(np.ptp(days)) / 365.25, 1e-9)
        tau = scale * spread / span
        d = np.linalg.solve(gram + 1e-3 * np.trace(gram) / len(at) * np.eye(len(at)), right)
        for _ in range(6):
            left = target - h @ d
            noise = float(np.var(left - x @ (solve @ left)))
            by_chance = np.sqrt(2.0 * np.log(len(at) + 1) * noise * np.maximum(np.diag(gram), 0.0))
            d = sparse_changes(gram, right, np.maximum(noise / tau, by_chance))
    left = target - h @ d
    beta = solve @ left
    return beta, at, d, float(np.std(left - x @ beta)) if len(days) else math.nan


def _transformed(v: np.ndarray):
    """(the series to fit, the way back): logarithms where no value is negative."""
    if len(v) > 0 and bool((v >= 0).all()):
        return np.log1p(v), np.expm1
    return v, np.asarray


def trend_fourier_forecast(
    df: DataFrame, by: Sequence[str], date: str, y: str, steps: int = 12, yearly: int = 3, monthly: int = 5,
    penalty: float = 0.1, change_scale: float = CHANGE_SCALE,
) -> DataFrame:
    """Trend and season: a line that may change its slope, and Fourier terms, least squares with a small penalty.

    Slope changes have an L1 penalty, so most are 0; the last slope goes on. The terms multiply where no value of a series is negative
    (they fit `log(1 + y)`), and add up where one is.
    """

    def solve(dates, v):
        base = dates.iloc[0]
        days = (dates - base).dt.days.to_numpy(dtype=float)
        there = ~np.isnan(v)
        target, back = _transformed(v[there])
        beta, at, d, noise = _trend_fit(days[there], target, yearly, monthly, penalty, change_scale)
        ahead = pd.Series([dates.iloc[-1] + pd.DateOffset(months=k) for k in range(1, steps + 1)])
        later = (ahead - base).dt.days.to_numpy(dtype=float)
        mean = _fourier(later, yearly, monthly) @ beta + _hinges(later, at) @ d
        return {
            "date": ahead.dt.date, "mean": back(mean), "lower": back(mean - Z80 * noise), "upper": back(mean + Z80 * noise),
        }

    return _per_series(df, by, date, y, "date date, mean double, lower double, upper double", solve)


def trend_changes(
    df: DataFrame, by: Sequence[str], date: str, y: str, yearly: int = 3, monthly: int = 5, penalty: float = 0.1,
    change_scale: float = CHANGE_SCALE, least: float = 0.01,
) -> DataFrame:
    """`(by…, date, change)`: where the trend of `trend_fourier_forecast` changes its slope, and by how much a year.

    Changes of less than `least` of the series' range over its span are left out. A series without any has no rows.
    """

    def solve(dates, v):
        base = dates.iloc[0]
        days = (dates - base).dt.days.to_numpy(dtype=float)
        there = ~np.isnan(v)
        target, _ = _transformed(v[there])
        _, at, d, _ = _trend_fit(days[there], target, yearly, monthly, penalty, change_scale)
        span = max(float(np.ptp(days)) / 365.25, 1e-9)
        large = np.abs(d) > least * (float(np.ptp(target)) if len(target) else 0.0) / span
        dates_of = [(base + pd.Timedelta(days=float(k))).date() for k in at[large]]
        return {"date": pd.Series(dates_of, dtype=object), "change": d[large]}

    return _per_series(df, by, date, y, "date date, change double", solve)


def align_forecasts(a: DataFrame, b: DataFrame, on: Sequence[str], names=("seasonal", "fourier")) -> DataFrame:
    """One row per key and date of either model with both models' mean, lower and upper."""
    measures = ("mean", "lower", "upper")
    left = a.select(*on, *[F.col(m).alias(f"{names[0]}_{m}") for m in measures])
    right = b.select(*on, *[F.col(m).alias(f"{names[1]}_{m}") for m in measures])
    return left.join(right, list(on), "full")


def naive_predictions(df: DataFrame, by: Sequence[str], date: str, y: str) -> DataFrame:
    """Long predictions `(by…, date, model_name, y, p)` of two simple models: last value and 3-row mean."""
    w = _window(by, date)
    wide = df.select(
        *by, date, F.col(y).cast("double").alias("y"), F.lag(y).over(w).alias("last_value"),
        F.avg(y).over(w.rowsBetween(-3, -1)).alias("mean_of_three"),
    ).filter(F.col("last_value").isNotNull())
    pairs = F.array(
        *[F.struct(F.lit(m).alias("model_name"), F.col(m).cast("double").alias("p")) for m in ("last_value", "mean_of_three")]
    )
    return wide.select(*by, date, "y", F.inline(pairs))
