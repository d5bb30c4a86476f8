"""Group, pivot, histogram, density, correlation and error-metric aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from numpy.polynomial import hermite_e
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalars import correlation
from tidemill.operators.ordering import quantiles


def group_means(df: DataFrame, by: str, **named: str) -> DataFrame:
    """Named means per group, nulls skipped, highest first mean on top."""
    first = next(iter(named))
    out = df.groupBy(by).agg(*[F.avg(c).alias(name) for name, c in named.items()])
    return out.orderBy(F.desc(first), by)


def yearly_sums(df: DataFrame, measures: dict[str, Column], year: str = "year") -> DataFrame:
    return df.groupBy(year).agg(*[F.sum(c).alias(name) for name, c in measures.items()])


def pivot_sum(df: DataFrame, row: str, column: str, measure: str, values: Sequence) -> DataFrame:
    """Sum per row key and one column per listed value; absent cells are 0."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.sum(measure)).na.fill(0)


def pivot_mean(df: DataFrame, row: str, column: str, measure: str, values: Sequence) -> DataFrame:
    """Mean per row key and one column per listed value; absent cells are null."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.avg(measure))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes, median and quartile range per column."""
    q = quantiles(df, columns, [0.25, 0.5, 0.75])
    shape = q.groupBy("column").agg(
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("median"),
        (
            F.max(F.when(F.col("p") == 0.75, F.col("value"))) - F.max(F.when(F.col("p") == 0.25, F.col("value")))
        ).alias("iqr"),
    )
    one = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"), F.count(c).alias("n"), F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    moments = one.select(F.inline(F.array(*[F.col(c) for c in columns])))
    # one row per listed column on both sides
    return moments.join(F.broadcast(shape), "column")


def value_counts(df: DataFrame, column) -> DataFrame:
    c = F.col(column) if isinstance(column, str) else column
    return df.groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def word_counts(df: DataFrame, text: str, pattern: str = r"\s+") -> DataFrame:
    words = df.select(F.explode(F.split(F.lower(F.col(text)), pattern)).alias("value"))
    return value_counts(words.filter(F.col("value") != ""), "value")


def long_words(df: DataFrame, text: str, longer_than: int = 5, pattern: str = r"\s+") -> DataFrame:
    """Distinct words with more than `longer_than` letters."""
    words = df.select(F.explode(F.array_distinct(F.split(F.lower(F.col(text)), pattern))).alias("word"))
    return words.filter(F.length("word") > longer_than).distinct()


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r for each pair of columns once, all pairs in a single aggregate."""
    pairs = list(combinations(columns, 2))
    row = df.agg(*[correlation(a, b).alias(f"{a}|{b}") for a, b in pairs])
    items = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs
    ]
    return row.select(F.inline(F.array(*items)))


def histogram(df: DataFrame, column: str, bins: int, density: bool = False) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; empty bins are kept."""
    c = F.col(column).cast("double")
    stats = df.agg(
        F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"), F.count(c).alias("n")).alias("s")
    )
    s = stats.scalar()
    width = (s["hi"] - s["lo"]) / F.lit(float(bins))
    place = F.when(width > 0, F.least(F.floor((c - s["lo"]) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = df.filter(c.isNotNull()).groupBy(place.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = stats.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))).alias("bin"), "s"
    )
    w = (F.col("s.hi") - F.col("s.lo")) / F.lit(float(bins))
    # `bins` rows, a parameter of the call
    out = frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("s.lo") + w * F.col("bin")).alias("low"),
        (F.col("s.lo") + w * (F.col("bin") + 1)).alias("high"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        F.col("s.n").alias("total"),
    )
    if density:
        out = out.withColumn("density", F.try_divide(F.col("n"), F.col("total") * (F.col("high") - F.col("low"))))
    return out.drop("total")


CELL = 1 / 8  # width of a cell of values in bandwidths
ORDER = 8  # moments kept of a cell


def kernel_density(df: DataFrame, column: str, points: int = 200, margin: float = 5000.0) -> DataFrame:
    """Gaussian density on a grid, bandwidth n^(-1/5) times the sample deviation.

    Values are summed up by cells of CELL bandwidths as moments about the middle of the cell, and the cells add to every grid
    point by the series of the bell curve around that middle. What the series leaves out is at most
    1.09 (CELL / 2)^(ORDER + 1) / sqrt((ORDER + 1)!) = 3e-14 of the curve's peak. The work is one pass over the rows and
    cells times points; only moments move. Without a deviation the density is null, without values there are no rows.
    """
    c = F.col(column).cast("double")
    s = df.agg(
        F.struct(
            F.min(c).alias("lo"), F.max(c).alias("hi"), F.count(c).cast("double").alias("n"),
            F.stddev_samp(c).alias("sd"),
        )
    ).scalar()
    step = (s["hi"] - s["lo"] + F.lit(2 * margin)) / F.lit(float(points - 1))
    width = s["sd"] * F.pow(s["n"], F.lit(-0.2))
    values = df.filter(c.isNotNull()).select(c.alias("v"), s["lo"].alias("lo"), width.alias("h"))
    values = values.withColumn("cell", F.floor(F.try_divide(F.col("v") - F.col("lo"), F.col("h") * F.lit(CELL))))
    middle = F.col("lo") + (F.col("cell") + F.lit(0.5)) * F.col("h") * F.lit(CELL)
    powers = [F.lit(1.0)]
    for _ in range(ORDER):
        powers.append(powers[-1] * F.col("t"))
    cells = values.withColumn("t", F.try_divide(F.col("v") - middle, F.col("h"))).groupBy("cell").agg(
        *[F.sum(p).alias(f"m{j}") for j, p in enumerate(powers)]
    )
    # sum over j of moment j / j! times the Hermite polynomial j, by powers of the distance
    of_power = [F.lit(0.0)] * (ORDER + 1)
    for j in range(ORDER + 1):
        for k, a in enumerate(hermite_e.herme2poly([0.0] * j + [1.0])):
            if a:
                of_power[k] = of_power[k] + F.col(f"m{j}") * F.lit(float(a) / math.factorial(j))
    placed = cells.select(
        "cell", *[b.alias(f"b{k}") for k, b in enumerate(of_power)], F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"),
        s["lo"].alias("lo"), (s["lo"] - F.lit(margin)).alias("start"), step.alias("step"), width.alias("h"), s["n"].alias("n"),
    ).withColumn("x", F.col("start") + F.col("point") * F.col("step"))
    placed = placed.withColumn("u", F.try_divide(F.col("x") - middle, F.col("h")))
    sums = F.col(f"b{ORDER}")
    for k in range(ORDER - 1, -1, -1):
        sums = sums * F.col("u") + F.col(f"b{k}")
    bump = F.try_divide(sums * F.exp(F.col("u") * F.col("u") * F.lit(-0.5)), F.col("n") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))
    return placed.groupBy("point").agg(F.max("x").alias("x"), F.sum(bump).alias("density"))


def error_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = (), features: int | None = None) -> DataFrame:
    """MAE, MSE, RMSE, R², MAPE in percent and, given a feature count, adjusted R²."""
    a, b = F.col(y).cast("double"), F.col(p).cast("double")
    gap = a - b
    sums = df.filter(a.isNotNull() & b.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(gap)).alias("mae"), F.avg(gap * gap).alias("mse"),
        F.var_pop(a).alias("__var"), (F.avg(F.abs(F.try_divide(gap, a))) * 100).alias("mape"),
    )
    out = sums.withColumn("rmse", F.sqrt("mse")).withColumn("r2", 1 - F.try_divide(F.col("mse"), F.col("__var")))
    if features is not None:
        out = out.withColumn(
            "adj_r2", 1 - F.try_divide((1 - F.col("r2")) * (F.col("n") - 1), F.col("n") - features - 1)
        )
    return out.drop("__var")


def leaderboard(predictions: DataFrame, y: str = "y", p: str = "p", by: str = "model_name") -> DataFrame:
    """One metric row per model, best R² first, the best one flagged."""
    metrics = error_metrics(predictions, y, p, by=[by])
    best = metrics.agg(F.max_by(by, F.struct("r2", by))).scalar()
    return metrics.withColumn("best", (F.col(by) == best).cast("int")).orderBy(F.desc("r2"), by)


def residuals(predictions: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return predictions.withColumn("residual", F.col(y) - F.col(p))


def residual_profile(predictions: DataFrame, by: str = "model_name", bins: int = 35) -> DataFrame:
    """Residual histogram per model with its RMSE; bins span each model's own residuals."""
    r = residuals(predictions).filter(F.col("residual").isNotNull())
    spans = r.groupBy(by).agg(
        F.min("residual").alias("lo"), F.max("residual").alias("hi"),
        F.sqrt(F.avg(F.col("residual") * F.col("residual"))).alias("rmse"),
    )
    joined = r.join(spans, by)
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    place = F.when(width > 0, F.least(F.floor((F.col("residual") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0)
    return joined.groupBy(by, place.cast("bigint").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.max("rmse").alias("rmse")
    )
