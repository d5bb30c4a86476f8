"""Tests, probability tables, sampling distributions and drift."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.scalars import correlation
from tidemill.operators.ordering import global_index, null_safe_join, quantile_values, ranked_values
from tidemill.session import cut

EPSILON = 1e-10



def _beta_tail(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by its continued fraction."""
    if x <= 0.0 or x >= 1.0:
        return min(max(x, 0.0), 1.0)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_tail(b, a, 1.0 - x)
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1), tiny)
    h = d
    for m in range(1, 400):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / (1.0 + step * d or tiny)
            c = (1.0 + step / c) or tiny
            h *= c * d
        if abs(c * d - 1.0) < 1e-14:
            break
    front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return math.exp(front) * h / a


@F.pandas_udf(T.DoubleType())
def two_sided_p(t: pd.Series, freedom: pd.Series) -> pd.Series:
    """Two-sided p value of Student's t; meant for small result tables."""
    pairs = zip(t.astype(float), freedom.astype(float))
    return pd.Series([_beta_tail(n / 2, 0.5, n / (n + x * x)) if n > 0 and x == x else None for x, n in pairs], dtype="float64")


def group_t_tests(df: DataFrame, by: str, y: str) -> DataFrame:
    """Each group's mean against the mean of all rows: t, degrees of freedom and two-sided p."""
    overall = df.agg(F.avg(y)).scalar()
    groups = df.groupBy(by).agg(
        F.count(y).alias("n"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("sd")
    )
    t = F.try_divide(F.col("mean") - overall, F.col("sd") / F.sqrt("n"))
    out = groups.withColumn("t", t).withColumn("df", F.col("n") - 1)
    return out.withColumn("p", two_sided_p(F.col("t"), F.col("df").cast("double")))


def pearson_test(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation of two columns with its t and two-sided p."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    row = both.agg(F.count(F.lit(1)).alias("n"), correlation(x, y).alias("r"))
    t = F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") * F.col("r")))
    return row.withColumn("t", t).withColumn("p", two_sided_p(F.col("t"), (F.col("n") - 2).cast("double")))


def ks_statistic(df: DataFrame, column: str, cdf: Callable[[Column], Column]) -> DataFrame:
    """Largest gap between the empirical distribution and a given one."""
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    ranked = ranked_values(values, "v")
    total = ranked.agg(F.sum("n")).scalar()
    expected = cdf(F.col("v"))
    gaps = ranked.select(
        F.greatest(
            F.abs(expected - F.col("before") / total), F.abs((F.col("before") + F.col("n")) / total - expected)
        ).alias("gap"),
        "n",
    )
    return gaps.agg(F.max("gap").alias("statistic"), F.sum("n").alias("n"))


def decile_edges(df: DataFrame, column: str, bins: int = 10) -> list[float]:
    """Inner bin edges at the quantiles of the expected sample: `bins - 1` numbers."""
    return quantile_values(df, column, [i / bins for i in range(1, bins)])


def bin_of(column, edges: Sequence[float]) -> Column:
    """Half-open bin number: how many edges lie at or below the value."""
    c = F.col(column) if isinstance(column, str) else column
    marks = F.array(*[F.lit(float(e)) for e in edges])
    return F.size(F.filter(marks, lambda e: e <= c))


def _shares(df: DataFrame, by: Sequence[str], column: str, edges: Sequence[float], name: str) -> DataFrame:
    """Share of each bin per group, with a row for empty bins."""
    by, bins = list(by), len(edges) + 1
    counts = df.filter(F.col(column).isNotNull()).groupBy(*by, bin_of(column, edges).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    wide = counts.groupBy(*by).agg(
        F.sum("n").alias("total"), *[F.sum(F.when(F.col("bin") == i, F.col("n"))).alias(f"b{i}") for i in range(bins)]
    )
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("bin"), (F.coalesce(f"b{i}", F.lit(0)) / F.col("total") + EPSILON).alias(name))
            for i in range(bins)
        ]
    )
    return wide.select(*by, F.inline(rows))


def psi_by_period(
    expected: DataFrame, actual: DataFrame, column: str, by: Sequence[str] = (), bins: int = 10,
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """Population stability index of each group of `actual` against `expected`.

    Bins lie at the deciles of the expected sample, the outer ones are open, and the small
    constant is added after the division.
    """
    edges = decile_edges(expected, column, bins) if edges is None else list(edges)
    base = _shares(expected, (), column, edges, "e")
    seen = _shares(actual, by, column, edges, "a")
    # `bins` rows on the baseline side
    joined = seen.join(F.broadcast(base), "bin")
    term = (F.col("a") - F.col("e")) * F.ln(F.col("a") / F.col("e"))
    psi = joined.groupBy(*by).agg(F.sum(term).alias("psi"))
    return psi.withColumn("status", drift_status("psi"))


def drift_status(column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c > 0.2, "Major").when(c > 0.1, "Minor").otherwise("Stable")


def consecutive_alerts(weekly: DataFrame, period: str, psi: str = "psi", limit: float = 0.2, days: int = 7) -> DataFrame:
    """Retrain flag: above the limit in two periods running. One row per period comes in.

    Where `period` is a date, a row only follows on one that lies `days` days before it: a gap ends the run.
    """
    w = Window.orderBy(period)
    high = (F.col(psi) > limit).cast("int")
    before = F.coalesce(F.lag(high).over(w), F.lit(0))
    if dict(weekly.dtypes)[period] in ("date", "timestamp"):
        gap = F.datediff(F.col(period), F.lag(period).over(w))
        before = F.when(gap == days, before).otherwise(0)
    return weekly.withColumn("retrain", (high * before).cast("int"))


# Multipliers of the integer mixers, and a prime below 2^31.
MIX = (1103515245, 69069)
ROUND_MIX = (48271, 69621, 16807)
PRIME = 2147483647
KEY_STEP = 1000003
WALKS = 128


def mixed(column, seed: int) -> Column:
    """Integer hash below 2^31 that other SQL engines can repeat."""
    c = F.col(column) if isinstance(column, str) else column
    h = ((c.cast("bigint") + F.lit(seed)) * F.lit(MIX[0]) + 12345) % (1 << 31)
    h = h.bitwiseXOR(F.shiftright(h, 13))
    h = (h * F.lit(MIX[1]) + 1) % (1 << 31)
    return h.bitwiseXOR(F.shiftright(h, 15))


def _let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """`fn` of a value that it reads more than once, computed once."""
    return F.get(F.transform(F.array(value), fn), 0)


def _round(x: Column, key: Column) -> Column:
    """A number below `PRIME` from another and a key; no product overflows for `x` below 2^32."""
    h = ((x % PRIME) * ROUND_MIX[0] + F.floor(x / PRIME) * ROUND_MIX[1] + key) % PRIME
    return _let(h, lambda v: (v.bitwiseXOR(F.shiftright(v, 15)) * ROUND_MIX[2]) % PRIME)


def halves(n: int) -> tuple[int, int]:
    """The least powers of two, the second as large as the first or twice that, whose product is `n` or more."""
    bits = max((max(n, 1) - 1).bit_length(), 2)
    return 1 << (bits // 2), 1 << (bits - bits // 2)


def permuted(x: Column, keys: Sequence[Column], n: int) -> Column:
    """Where a permutation of 0..n-1, picked by four keys, sends `x` (below `n`): four rounds that swap and mix the two halves of its
    bits. A number that lands beyond `n` is sent on until it comes back, which more than half of all numbers do at each step."""
    left, right = halves(n)

    def once(v: Column) -> Column:
        def mix(a: Column, b: Column, part: int) -> Column:
            first = a.bitwiseXOR(_round(b, keys[part]) % left)
            return _let(first, lambda c: _let(b.bitwiseXOR(_round(c, keys[part + 1]) % right), lambda d: last(c, d) if part else mix(c, d, 2)))

        def last(c: Column, d: Column) -> Column:
            return c * right + d

        return _let(F.floor(v / right), lambda a: _let(v % right, lambda b: mix(a, b, 0)))

    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), once(x), lambda v, _: F.when(v < n, v).otherwise(once(v)))
    return _let(walk, lambda v: F.when(v < n, v).otherwise(F.raise_error(F.lit("a draw has not come back"))))


def sampling_means(
    df: DataFrame, value: str, key: str, replicates: int = 5000, size: int = 30, seed: int = 7
) -> DataFrame:
    """Means of `replicates` subsamples of `size` distinct rows each; all rows where there are fewer.

    A replicate takes the first numbers of a permutation of the row numbers that its own keys pick, so its draws are
    distinct and any row may be drawn, whatever the number of rows. The draws, not the rows, are multiplied.
    """
    rows = df.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
    indexed = cut(global_index(rows, "__k", name="__i"))
    n = indexed.count()
    rep = df.sparkSession.range(replicates if n else 0).select(F.col("id").alias("rep"))
    keys = [mixed("rep", seed + KEY_STEP * i).alias(f"k{i}") for i in range(4)]
    draws = rep.select("rep", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(min(size, max(n, 1)) - 1).cast("long"))).alias("j"), *keys)
    draws = draws.select("rep", permuted(F.col("j"), [F.col(f"k{i}") for i in range(4)], max(n, 1)).alias("__i"))
    if replicates * size <= 1_000_000:
        # the number of draws is set by the call, not by the data
        draws = F.broadcast(draws)
    return indexed.join(draws, "__i").groupBy("rep").agg(F.avg("__v").alias("mean"))


def sampling_summary(means: DataFrame, df: DataFrame, value: str, size: int = 30) -> DataFrame:
    """Mean and deviation of the subsample means next to the theory."""
    theory = df.agg(F.struct(F.avg(value).alias("mu"), F.stddev_pop(value).alias("sigma")).alias("s")).scalar()
    return means.agg(
        F.count(F.lit(1)).alias("replicates"), F.avg("mean").alias("mean_of_means"), F.stddev_pop("mean").alias("std_of_means")
    ).select("*", theory["mu"].alias("mu"), (theory["sigma"] / math.sqrt(size)).alias("theory"))


def joint_table(df: DataFrame, a: str, b: str) -> DataFrame:
    """Marginal, joint and conditional probabilities of two categories with lift and independence gap."""
    cells = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    pa = cells.groupBy("a").agg((F.sum("n") / total).alias("p_a"))
    pb = cells.groupBy("b").agg((F.sum("n") / total).alias("p_b"))
    out = cells.withColumn("p_ab", F.col("n") / total).join(pa, "a").join(pb, "b")
    return out.withColumns(
        {
            "p_b_given_a": F.col("p_ab") / F.col("p_a"),
            "lift": F.col("p_ab") / (F.col("p_a") * F.col("p_b")),
            "gap": F.col("p_ab") - F.col("p_a") * F.col("p_b"),
        }
    )


def next_value(
    df: DataFrame, by: Sequence[str], time: str, tie: str, value: str, name: str, unit: str = "day"
) -> DataFrame:
    """The value of the next row per group, split by time so that no task holds a whole group.

    Rows are chained inside (group, time unit); the last row of a unit takes the first row of
    the group's next unit that has one.
    """
    by = list(by)
    rows = df.withColumn("__u", F.date_trunc(unit, F.col(time)))
    inner = Window.partitionBy(*by, "__u").orderBy(time, tie)
    marked = rows.withColumn("__next", F.lead(F.struct(F.col(value).alias("v"))).over(inner))
    firsts = rows.groupBy(*by, "__u").agg(F.min_by(F.struct(F.col(value).alias("v")), F.struct(time, tie)).alias("__f"))
    # one row per group and time unit
    chain = Window.partitionBy(*by).orderBy("__u")
    after = firsts.select(*by, "__u", F.lead("__f").over(chain).alias("__after"))
    joined = null_safe_join(marked, after, [*by, "__u"])
    return joined.withColumn(name, F.coalesce(F.col("__next"), F.col("__after"))["v"]).drop("__u", "__next", "__after")


def ordered_pairs(df: DataFrame, by: Sequence[str], time: str, tie: str, value: str) -> DataFrame:
    """Transition probabilities between successive values per group."""
    pairs = next_value(df, by, time, tie, value, "__to").filter(F.col("__to").isNotNull())
    return joint_table(pairs, value, "__to")


def word_posteriors(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, pattern: str) -> DataFrame:
    """P(label = 1 | word occurs) from the prior and the likelihoods of the labelled documents."""
    joined = docs.select(key, text).join(labels.select(key, F.col(label).cast("bigint").alias("__y")), key)
    sizes = joined.agg(
        F.struct(F.sum("__y").alias("pos"), F.count(F.lit(1)).alias("all")).alias("s")
    ).scalar()
    words = joined.select("__y", F.explode(F.array_distinct(F.split(F.lower(text), pattern))).alias("word"))
    counts = words.filter(F.col("word") != "").groupBy("word").agg(
        F.sum("__y").alias("pos"), F.count(F.lit(1)).alias("docs")
    )
    negatives = sizes["all"] - sizes["pos"]
    prior = sizes["pos"] / sizes["all"]
    given_pos = F.col("pos") / sizes["pos"]
    given_neg = (F.col("docs") - F.col("pos")) / negatives
    evidence = given_pos * prior + given_neg * (1 - prior)
    return counts.select("word", "docs", (given_pos * prior / evidence).alias("posterior"))


def bayes(prior: Column, likelihood: Column, other: Column) -> Column:
    """Posterior from a prior and the likelihoods under both hypotheses."""
    return prior * likelihood / (prior * likelihood + (1 - prior) * other)
