"""Encoding, scaling, feature screening and linear models from one Gram pass."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.scalars import ratio_features
from tidemill.operators.linalg import Gram, column_gram
from tidemill.operators.ordering import global_index, quantiles
from tidemill.operators.series import lag_features, rolling_features
from tidemill.operators.stats import bin_of
from tidemill.session import cut


def label_encode(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Code = rank of the value among the sorted distinct values, from 0."""
    codes = global_index(df.select(F.col(column).alias("__v")).filter(F.col("__v").isNotNull()).distinct(), "__v", name="__code")
    return df.join(codes, F.col(column) == F.col("__v"), "left").withColumnRenamed("__code", name or f"{column}_enc").drop("__v")


def one_hot(df: DataFrame, column: str, values: Sequence[str], prefix: str) -> DataFrame:
    """One 0/1 column per listed value."""
    return df.withColumns({f"{prefix}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in values})


def from_one_hot(df: DataFrame, values: Sequence[str], prefix: str, name: str) -> DataFrame:
    """Back to the category; null where no flag is set."""
    return df.withColumn(name, F.coalesce(*[F.when(F.col(f"{prefix}_{v}") == 1, F.lit(v)) for v in values]))


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean 0 and population deviation 1; constant columns become 0."""
    s = df.agg(
        F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).alias("s")
    ).scalar()
    return df.withColumns(
        {
            c: (F.col(c) - s[c]["m"]) / F.when(s[c]["s"] == 0, F.lit(1.0)).otherwise(s[c]["s"])
            for c in columns
        }
    )


def numeric_features(df: DataFrame, leave_out: Sequence[str]) -> list[str]:
    """Numeric columns except the listed ones. List whatever is computed from the target, too."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in set(leave_out)]


def modelling_features(df: DataFrame, by: Sequence[str], date: str, target: str, price: str) -> DataFrame:
    """The columns a model of a monthly measure learns from, besides those given: calendar parts, earlier values of target and price
    (1, 3 and 6 rows back), mean and deviation of the 3 and 6 rows before, products and ratios, the logarithm of the price.

    Rows without all of the earlier values are left out, as is any other row with a null. Ratios that use the target are not among them.
    """
    rows = rolling_features(lag_features(df, by, date, [target, price]), by, date, target)
    rows = ratio_features(rows, price=price, sold=target).drop("made_minus_sold", "stations_per_sale")
    month = F.month(date)
    rows = rows.withColumns(
        {
            "quarter": F.quarter(date), "week": F.weekofyear(date), "is_q4": (F.quarter(date) == 4).cast("int"),
            "year_progress": (month - 1) / F.lit(11.0), f"log_{price}": F.log1p(price),
        }
    )
    return rows.na.drop()


def feature_matrix(df: DataFrame, target: str, leave_out: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Assembled `features` and `label` with nulls as 0."""
    features = numeric_features(df, [target, *leave_out, *keep])
    filled = df.na.fill(0, subset=features)
    return (
        VectorAssembler(inputCols=features, outputCol="features")
        .transform(filled)
        .select(*keep, "features", F.col(target).cast("double").alias("label"))
    )


def variance_inflation(df: DataFrame, columns: Sequence[str], limit: float = 30.0) -> DataFrame:
    """Inflation factor per column, without intercept and uncentred, and whether it stays."""
    g = column_gram(df, columns)
    inverse = np.linalg.pinv(g.products)
    rows = [(c, float(g.products[i, i] * inverse[i, i])) for i, c in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "column string, vif double").withColumn("kept", (F.col("vif") <= limit).cast("int"))


def drop_inflated(df: DataFrame, columns: Sequence[str], limit: float = 30.0) -> DataFrame:
    """Drop all columns above the limit at once."""
    g = column_gram(df, columns)
    inverse = np.linalg.pinv(g.products)
    return df.drop(*[c for i, c in enumerate(columns) if g.products[i, i] * inverse[i, i] > limit])


def mutual_information(df: DataFrame, columns: Sequence[str], target: str, bins: int = 10, top: int = 20) -> DataFrame:
    """Features ranked by mutual information with the target, both cut at their quantiles."""
    df = cut(df.select(*columns, target))  # read for the quantiles and again for the bins
    probs = [i / bins for i in range(1, bins)]
    found = quantiles(df, [*columns, target], probs).select("column", "p", "value").collect()
    edges: dict[str, list[float]] = {}
    for r in sorted(found, key=lambda r: (r["column"], r["p"])):
        edges.setdefault(r["column"], []).append(r["value"])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), bin_of(c, edges[c]).alias("x")) for c in columns]
    )
    rows = df.na.drop(subset=[*columns, target]).select(bin_of(target, edges[target]).alias("y"), F.inline(pairs))
    cells = rows.groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("n"))
    total = cells.groupBy("feature").agg(F.sum("n").alias("t"))
    px = cells.groupBy("feature", "x").agg(F.sum("n").alias("nx"))
    py = cells.groupBy("feature", "y").agg(F.sum("n").alias("ny"))
    joined = cells.join(total, "feature").join(px, ["feature", "x"]).join(py, ["feature", "y"])
    p = F.col("n") / F.col("t")
    term = p * F.ln(F.col("n") * F.col("t") / (F.col("nx") * F.col("ny")))
    return joined.groupBy("feature").agg(F.sum(term).alias("mi")).orderBy(F.desc("mi"), "feature").limit(top)


def _standard_system(g: Gram, features: Sequence[str], target: str):
    g = g.pick([*features, target])
    cov, d = g.covariance(ddof=0), len(features)
    scale = np.sqrt(np.maximum(np.diag(cov)[:d], 0))
    scale[scale == 0] = 1.0
    return g, cov[:d, :d] / np.outer(scale, scale), cov[:d, d] / scale, scale


def linear_fit(df: DataFrame, features: Sequence[str], target: str, ridge: float = 0.0) -> DataFrame:
    """Least squares, or ridge with penalty `ridge` on the sum of squares, on standardised features.

    Coefficients are given for standardised features (`weight`) and in the units of the data. A null
    feature counts as 0, as it does in `linear_predict`; rows without a target are left out.
    """
    features = list(features)
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features], target)
    g, a, b, scale = _standard_system(column_gram(filled, [*features, target]), features, target)
    weights = np.linalg.lstsq(a + np.eye(len(features)) * ridge / g.n, b, rcond=None)[0]
    raw = weights / scale
    intercept = g.means[-1] - float(raw @ g.means[:-1])
    rows = [("(intercept)", float(g.means[-1]), float(intercept))]
    rows += [(f, float(w), float(r)) for f, w, r in zip(features, weights, raw)]
    return df.sparkSession.createDataFrame(rows, "term string, weight double, coefficient double")


def linear_predict(df: DataFrame, fit: DataFrame, name: str = "p") -> DataFrame:
    """Predictions bounded below by 0. The fit has one row per feature."""
    terms = {r["term"]: r["coefficient"] for r in fit.collect()}
    out = F.lit(terms.pop("(intercept)"))
    for column, weight in terms.items():
        out = out + F.coalesce(F.col(column), F.lit(0)) * F.lit(weight)
    return df.withColumn(name, F.greatest(out, F.lit(0.0)))


def scaled(model, name: str = "scaled") -> Pipeline:
    """`model` behind a scaler that centres the features and gives them unit deviation."""
    scaler = StandardScaler(inputCol=model.getFeaturesCol(), outputCol=name, withMean=True)
    return Pipeline(stages=[scaler, model.copy().setFeaturesCol(name)])


def lasso_model(alpha: float = 50.0, max_iter: int = 5000) -> LinearRegression:
    """Estimator for 1/(2n) |y - Xw|² + alpha |w|₁; give it standardised features."""
    return LinearRegression(elasticNetParam=1.0, regParam=alpha, maxIter=max_iter, standardization=False, solver="auto")
