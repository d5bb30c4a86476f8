"""Tree and network models, cross-validation, search and learning curves on Spark ML."""

from __future__ import annotations

import json
import random
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Estimator
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.arrays import mean_square, total
from tidemill.operators.aggregates import error_metrics
from tidemill.operators.boosting import PenalisedTrees
from tidemill.operators.features import lasso_model, scaled
from tidemill.operators.linalg import low_rank, vector_gram
from tidemill.operators.ordering import chronological_split, expanding_folds
from tidemill.session import cut


FITS = 4  # fits that run at the same time


def side_by_side(fn, items: Sequence, at_once: int = FITS) -> list:
    """`fn` of each item, in order, a few at a time: small fits leave most of a cluster idle on their own."""
    with ThreadPool(at_once) as pool:
        return pool.map(fn, items, 1)


def random_forest(trees: int = 200, depth: int = 12, leaf: int = 3, seed: int = 42) -> RandomForestRegressor:
    return RandomForestRegressor(numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=seed)


def boosted_trees(
    rounds: int = 200, rate: float = 0.08, depth: int = 5, subsample: float = 0.85, seed: int = 42,
    columns: float = 1.0, leaf: int = 1, gain: float = 0.0,
) -> GBTRegressor:
    """Gradient boosting; `columns` is the share of features tried per node, `leaf` and `gain` stop splits."""
    return GBTRegressor(
        maxIter=rounds, stepSize=rate, maxDepth=depth, subsamplingRate=subsample, seed=seed,
        featureSubsetStrategy="all" if columns >= 1 else str(columns), minInstancesPerNode=leaf, minInfoGain=gain,
    )


def fit_predict(estimator: Estimator, train: DataFrame, test: DataFrame, name: str) -> DataFrame:
    """Predictions on the test rows in long form, bounded below by 0."""
    scored = estimator.fit(train).transform(test)
    return scored.withColumns(
        {"model_name": F.lit(name), "y": F.col("label"), "p": F.greatest(F.col("prediction"), F.lit(0.0))}
    )


def importances(spark: SparkSession, model, names: Sequence[str], top: int = 20) -> DataFrame:
    """The `top` features of a fitted tree model."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    frame = spark.createDataFrame(rows, "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature").limit(top)


def fold_scores(estimator: Estimator, folds: DataFrame, count: int = 5) -> list[float]:
    """R² of each fold of a frame with `fold` and `role` columns."""

    def score(i: int) -> float:
        one = folds.filter(F.col("fold") == i)
        scored = estimator.copy().fit(one.filter("role = 'train'")).transform(one.filter("role = 'test'"))
        return error_metrics(scored, "label", "prediction").first()["r2"]

    return side_by_side(score, range(count))


def cross_validate(estimators: dict[str, Estimator], folds: DataFrame, count: int = 5) -> DataFrame:
    """Mean and deviation of R² over the folds, best model first."""
    rows = []
    for name, estimator in estimators.items():
        rows += [(name, i, float(s)) for i, s in enumerate(fold_scores(estimator, folds, count))]
    scores = folds.sparkSession.createDataFrame(rows, "model_name string, fold int, r2 double")
    return (
        scores.groupBy("model_name")
        .agg(F.avg("r2").alias("mean_r2"), F.stddev_pop("r2").alias("std_r2"))
        .orderBy(F.desc("mean_r2"), "model_name")
    )


def contiguous_roles(folds: DataFrame, count: int = 5) -> DataFrame:
    """Turn a fold number per row into (fold, role) rows for each fold."""
    each = folds.withColumnRenamed("fold", "__own").withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(count)])))
    return each.withColumn("role", F.when(F.col("__own") == F.col("fold"), "test").otherwise("train")).drop("__own")


@dataclass(frozen=True)
class Ridge:
    """Least squares on standardised features with penalty `alpha` on the sum of squared weights, in closed form from one Gram pass.

    It takes the place of an estimator: Spark's own divides the penalty by the deviation of the label.
    """

    alpha: float = 10.0
    intercept: float = 0.0
    weights: tuple[float, ...] = ()

    def copy(self) -> Ridge:
        return self

    def fit(self, df: DataFrame) -> Ridge:
        g = vector_gram(df.select(F.concat(vector_to_array("features"), F.array(F.col("label").cast("double"))).alias("v")), "v")
        cov, d = g.covariance(ddof=0), len(g.deltas) - 1
        scale = np.sqrt(np.maximum(np.diag(cov)[:d], 0.0))
        scale[scale == 0] = 1.0
        system = cov[:d, :d] / np.outer(scale, scale) + np.eye(d) * self.alpha / g.n
        raw = np.linalg.solve(system, cov[:d, d] / scale) / scale
        return replace(self, intercept=float(g.means[d] - raw @ g.means[:d]), weights=tuple(map(float, raw)))

    def transform(self, df: DataFrame) -> DataFrame:
        terms = F.zip_with(vector_to_array("features"), F.array(*[F.lit(w) for w in self.weights]), lambda x, w: x * w)
        return df.withColumn("prediction", F.lit(self.intercept) + total(terms))


def six_models() -> dict[str, Estimator]:
    """The models of the comparison with the settings they are compared with.

    Gradient boosting for squared loss is the penalised kind without penalties: leaves are mean residuals either way.
    """
    plain = PenalisedTrees(rounds=200, rate=0.08, depth=5, subsample=0.85, columns=1.0, l2=0.0)
    return {
        "linear": scaled(LinearRegression(regParam=0.0)), "ridge": Ridge(10.0), "lasso": scaled(lasso_model(50.0)),
        "forest": random_forest(), "gradient_boosting": plain, "penalised_trees": PenalisedTrees(),
    }


def all_predictions(estimators: dict[str, Estimator], train: DataFrame, test: DataFrame) -> DataFrame:
    """Predictions of every model on the test rows in long form (`model_name`, `y`, `p`), bounded below by 0."""
    found = side_by_side(lambda item: fit_predict(item[1], train, test, item[0]), list(estimators.items()))
    names = [*(c for c in test.columns if c not in ("features", "label")), "model_name", "y", "p"]
    return reduce(DataFrame.unionByName, [df.select(*names) for df in found])


# The lists a random draw picks from.
SEARCH_SPACE = {
    "rounds": (100, 200, 300, 400, 500),
    "rate": (0.01, 0.03, 0.05, 0.07, 0.10, 0.15),
    "depth": (3, 4, 5, 6, 7, 8),
    "subsample": (0.6, 0.7, 0.8, 0.85, 0.9, 1.0),
    "columns": (0.5, 0.6, 0.7, 0.8, 0.9, 1.0),
    "weight": (1, 3, 5, 7),
    "gain": (0, 0.1, 0.2, 0.5, 1.0),
    "l1": (0, 0.01, 0.1, 1.0),
    "l2": (1.0, 1.5, 2.0, 5.0),
}


def neighbour_grid(best: dict) -> list[dict]:
    """One step around the winner: rounds by 100 (at least 50), rate by 0.02 (at least 0.005), depth by 1 (at least 2)."""
    rounds = sorted({max(50, best["rounds"] + s) for s in (-100, 0, 100)})
    rates = sorted({round(max(0.005, best["rate"] + s), 6) for s in (-0.02, 0.0, 0.02)})
    depths = sorted({max(2, best["depth"] + s) for s in (-1, 0, 1)})
    return [dict(best, rounds=n, rate=r, depth=d) for n in rounds for r in rates for d in depths]


def search_boosted(
    folds: DataFrame, space: dict | None = None, draws: int = 50, count: int = 5, seed: int = 42, refine: bool = True
) -> DataFrame:
    """Random search over the penalised trees, then the grid around the winner: `(stage, params, mean_r2)`, a row per try.

    `folds` has `fold` and `role` besides `features` and `label`. The bins of a fold are found and written once for all
    tries; several fits run at the same time.
    """
    space, rng = space or SEARCH_SPACE, random.Random(seed)
    tests = [cut(folds.filter((F.col("fold") == i) & (F.col("role") == "test")).select("features", "label")) for i in range(count)]
    trains = side_by_side(lambda i: PenalisedTrees().binned(folds.filter((F.col("fold") == i) & (F.col("role") == "train"))), range(count))

    def score(job: tuple[dict, int]) -> float:
        params, i = job
        model = PenalisedTrees(**params, seed=seed).fit_binned(trains[i])
        return error_metrics(model.transform(tests[i]), "label", "prediction").first()["r2"]

    def scored(stage: str, tries: list[dict]) -> list[tuple[str, dict, float]]:
        r2 = iter(side_by_side(score, [(params, i) for params in tries for i in range(count)], 2 * FITS))
        return [(stage, params, sum(next(r2) for _ in range(count)) / count) for params in tries]

    found = scored("random", [{k: rng.choice(v) for k, v in space.items()} for _ in range(draws)])
    if refine:
        found += scored("grid", neighbour_grid(max(found, key=lambda t: t[-1])[1]))
    rows = [(stage, json.dumps(params, sort_keys=True), float(r2)) for stage, params, r2 in found]
    frame = folds.sparkSession.createDataFrame(rows, "stage string, params string, mean_r2 double")
    return frame.orderBy(F.desc("mean_r2"), "stage", "params")


def learning_curve(
    estimator: Estimator, rows: DataFrame, keys: Sequence[str], sizes: int = 10, folds: int = 5
) -> DataFrame:
    """R² on training and validation rows for growing parts of each time fold's training rows."""
    tagged = cut(expanding_folds(rows, *keys, folds=folds))
    counts = {r["fold"]: r["n"] for r in tagged.filter("role = 'train'").groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}

    def score(step_and_fold: tuple[int, int]) -> list[tuple]:
        step, fold = step_and_fold
        one = tagged.filter(F.col("fold") == fold)
        limit = max(int(counts[fold] * step / sizes), 1)
        train = one.filter((F.col("role") == "train") & (F.col("row_index") < limit))
        model = estimator.copy().fit(train)
        parts = (("train", train), ("validation", one.filter("role = 'test'")))
        r2 = lambda part: error_metrics(model.transform(part), "label", "prediction").first()["r2"]
        return [(step / sizes, fold, role, r2(part)) for role, part in parts]

    each = side_by_side(score, [(step, fold) for step in range(1, sizes + 1) for fold in range(folds)])
    out = [row for rows_ in each for row in rows_]
    scores = rows.sparkSession.createDataFrame(out, "share double, fold int, role string, r2 double")
    return scores.groupBy("share", "role").agg(F.avg("r2").alias("mean_r2"), F.stddev_pop("r2").alias("std_r2"))


def network_accuracy(
    df: DataFrame, key: str, vector: str, label: str, layers: Sequence[int], train_share: float = 0.9,
    max_iter: int = 50, seed: int = 42,
) -> DataFrame:
    """Feed-forward classifier trained on the first rows by key; accuracy on both parts."""
    ready = df.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("features"), F.col(label).cast("double").alias("label"))
    parts = chronological_split(ready, key, train_share=train_share)
    net = MultilayerPerceptronClassifier(layers=list(layers), maxIter=max_iter, seed=seed)
    scored = net.fit(parts.filter("role = 'train'")).transform(parts)
    hit = (F.col("prediction") == F.col("label")).cast("double")
    return scored.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def denoise(df: DataFrame, key: str, vector: str, rank: int = 8, noise: float = 0.4, seed: int = 1) -> DataFrame:
    """Add normal noise, clip to [0, 1], rebuild at low rank; mean squared error of each against the clean rows.

    The noise of a row depends on the seed and the row key alone, so a retried task repeats it.
    """

    def uniform(i, part: int):
        # the upper 53 bits of a hash, never 0
        bits = F.shiftrightunsigned(F.xxhash64(F.col(key), i, F.lit(seed), F.lit(part)), 11)
        return (bits + 1) / F.lit(float((1 << 53) + 1))

    def disturbed(x, i):
        draw = F.sqrt(-2 * F.ln(uniform(i, 0))) * F.cos(2 * F.pi() * uniform(i, 1))
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x + noise * draw))

    clean = F.col(vector).cast("array<double>")
    rows = df.select(key, clean.alias("clean")).withColumn("noisy", F.transform("clean", disturbed))
    rebuilt = low_rank(rows, "noisy", rank, "rebuilt")
    return rebuilt.agg(
        F.count(F.lit(1)).alias("n"), F.avg(mean_square("noisy", "clean")).alias("mse_noisy"),
        F.avg(mean_square("rebuilt", "clean")).alias("mse_rebuilt"),
    )
