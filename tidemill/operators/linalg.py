"""Gram matrices, eigenpairs, decompositions and matrix tables.

The distributed part is always one pass over the rows; the matrices that reach the driver have
the size of the columns squared and are refused beyond `MAX_DIMS`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.session import cut

MAX_DIMS = 2048
FACTOR_BYTES = 64 << 20  # triangular factors that one task stacks


@dataclass
class Gram:
    """Row count, column sums and products of pairs of columns, each column less an offset of its own.

    The offset lies among the column's values, so nothing cancels in the covariance of columns far from 0.
    """

    names: list[str]
    n: int
    offset: np.ndarray
    deltas: np.ndarray
    cross: np.ndarray

    @property
    def sums(self) -> np.ndarray:
        return self.deltas + self.n * self.offset

    @property
    def products(self) -> np.ndarray:
        mixed = np.outer(self.offset, self.deltas)
        return self.cross + mixed + mixed.T + self.n * np.outer(self.offset, self.offset)

    @property
    def means(self) -> np.ndarray:
        return self.offset + self.deltas / self.n

    def covariance(self, ddof: int = 1) -> np.ndarray:
        return (self.cross - np.outer(self.deltas, self.deltas) / self.n) / (self.n - ddof)

    def pick(self, names: Sequence[str]) -> Gram:
        at = [self.names.index(c) for c in names]
        return Gram(list(names), self.n, self.offset[at], self.deltas[at], self.cross[np.ix_(at, at)])


def column_gram(df: DataFrame, columns: Sequence[str]) -> Gram:
    """Gram matrix of numeric columns; rows with a null are left out.

    Up to 64 columns take a single aggregate, more go through `vector_gram`.
    """
    columns = list(columns)
    d = len(columns)
    cols = [F.col(c).cast("double") for c in columns]
    rows = df.select(*[c.alias(f"x{i}") for i, c in enumerate(cols)]).na.drop()
    if d > 64:
        wide = vector_gram(rows.select(F.array(*rows.columns).alias("v")), "v")
        return Gram(columns, wide.n, wide.offset, wide.deltas, wide.cross)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    offset = _first_values(rows.first(), d)
    rows = rows.select(*[(F.col(f"x{i}") - F.lit(float(offset[i]))).alias(f"x{i}") for i in range(d)])
    row = rows.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(d)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i, j in pairs],
    ).first()
    products = np.zeros((d, d))
    for i, j in pairs:
        products[i, j] = products[j, i] = row[f"p{i}_{j}"] or 0.0
    return Gram(columns, row["n"], offset, np.array([row[f"s{i}"] or 0.0 for i in range(d)]), products)


def _first_values(row, d: int) -> np.ndarray:
    found = np.zeros(d) if row is None else np.array(list(row), dtype=float)
    return np.where(np.isfinite(found), found, 0.0)


def gram_cells(df: DataFrame, vector: str) -> DataFrame:
    """Gram matrix of a vector column as `(i, j, v)` rows.

    Each task adds up its rows in matrix form and emits one partial matrix, so the shuffle
    carries columns squared per task whatever the number of rows.
    """

    def partial(batches):
        total = None
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["v"].to_numpy()).astype(float)
                part = x.T @ x
                total = part if total is None else total + part
        if total is not None:
            d = len(total)
            i, j = np.divmod(np.arange(d * d), d)
            yield pd.DataFrame({"i": i, "j": j, "v": total.ravel()})

    parts = df.select(F.col(vector).cast("array<double>").alias("v")).mapInPandas(partial, "i long, j long, v double")
    return parts.groupBy("i", "j").agg(F.sum("v").alias("v"))


def vector_gram(df: DataFrame, vector: str) -> Gram:
    """Gram matrix and sums of a vector column, on the driver. A leading 1 carries the sums."""
    first = df.select(F.col(vector).cast("array<double>")).filter(F.col(vector).isNotNull()).first()
    if first is None:
        return Gram([], 0, np.zeros(0), np.zeros(0), np.zeros((0, 0)))
    d = len(first[0])
    if d > MAX_DIMS:
        raise ValueError(f"{d} dimensions; the driver holds at most {MAX_DIMS}")
    offset = _first_values(first[0], d)
    # as many literals as the vector has dimensions
    shifted = F.zip_with(F.col(vector).cast("array<double>"), F.array(*[F.lit(float(x)) for x in offset]), lambda x, o: x - o)
    one = F.concat(F.array(F.lit(1.0)), shifted).alias("v")
    full = np.zeros((d + 1, d + 1))
    for r in gram_cells(df.select(one), "v").collect():
        full[r["i"], r["j"]] = r["v"]
    return Gram([str(i) for i in range(d)], int(round(full[0, 0])), offset, full[0, 1:], full[1:, 1:])


def eigenpairs(matrix: np.ndarray, k: int):
    """Leading eigenvalues and column vectors; the largest entry of each vector is positive."""
    values, vectors = np.linalg.eigh(matrix)
    at = np.argsort(values)[::-1][:k]
    values, vectors = values[at], vectors[:, at]
    peak = np.abs(vectors).argmax(axis=0)
    signs = np.sign(vectors[peak, np.arange(vectors.shape[1])])
    return values, vectors * np.where(signs == 0, 1.0, signs)


def eigen_table(df: DataFrame, vector: str, k: int = 3) -> DataFrame:
    """Leading eigenpairs of the covariance with the size of A v - lambda v."""
    cov = vector_gram(df, vector).covariance()
    values, vectors = eigenpairs(cov, k)
    rows = [
        (i, float(values[i]), [float(x) for x in vectors[:, i]], float(np.linalg.norm(cov @ vectors[:, i] - values[i] * vectors[:, i])))
        for i in range(len(values))
    ]
    return df.sparkSession.createDataFrame(rows, "component int, value double, vector array<double>, residual double")


def projector(matrix: np.ndarray, centre: np.ndarray | None = None):
    """A column function that multiplies vectors by `matrix`, batch by batch."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def project(v: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(v), dtype=object)
        given = np.flatnonzero(v.notna().to_numpy())
        if len(given):
            x = np.stack(v.to_numpy()[given]).astype(float)
            for at, row in zip(given, (x if centre is None else x - centre) @ matrix):
                out.iat[at] = row
        return out

    return project


def principal_components(df: DataFrame, vector: str, k: int = 2, name: str = "pc") -> DataFrame:
    """Centred projection on the leading components, with fixed signs."""
    g = vector_gram(df, vector)
    _, vectors = eigenpairs(g.covariance(), k)
    return df.withColumn(name, projector(vectors, g.means)(F.col(vector).cast("array<double>")))


def _whole(v: Column) -> Column:
    return v.isNotNull() & ~F.exists(v, F.isnull)


def triangular_factor(df: DataFrame, vector: str) -> np.ndarray:
    """R of the QR decomposition of the row matrix, without its products, so small singular values keep their digits.

    Each task turns its rows into one triangular factor, batch by batch. Factors are stacked and reduced in a tree, as many at
    once as FACTOR_BYTES holds; the driver sees the last ones only. Null vectors and vectors with a null are left out; a
    table without others has an empty factor.
    """
    rows = df.select(F.col(vector).cast("array<double>").alias("v")).filter(_whole(F.col("v")))
    first = rows.first()
    if first is None:
        return np.zeros((0, 0))
    d = len(first[0])
    if d > MAX_DIMS:
        raise ValueError(f"{d} dimensions; the driver holds at most {MAX_DIMS}")
    fan = int(max(2, FACTOR_BYTES // (8 * max(d, 1) ** 2)))

    def reduced(batches):
        part, held = None, np.zeros((0, d))
        for pdf in batches:
            if len(pdf):
                part = int(pdf["part"].iloc[0])
                held = np.linalg.qr(np.vstack([held, np.stack(pdf["v"].to_numpy())]), mode="r")
        if part is not None:
            yield pd.DataFrame({"part": part, "v": list(held)})

    def stacked(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": pdf["part"].iloc[0], "v": list(np.linalg.qr(np.stack(pdf["v"].to_numpy()), mode="r"))})

    schema = "part long, v array<double>"
    blocks = cut(rows.select(F.spark_partition_id().cast("long").alias("part"), "v").mapInPandas(reduced, schema))
    while blocks.agg(F.max("part")).first()[0] >= fan:
        blocks = cut(blocks.withColumn("part", F.floor(F.col("part") / fan)).groupBy("part").applyInPandas(stacked, schema))
    return np.linalg.qr(np.array([r["v"] for r in blocks.collect()]).reshape(-1, d), mode="r")


def singular_values(df: DataFrame, vector: str, k: int = 5) -> DataFrame:
    """Leading singular values of the row matrix, with the share of the squared norm they keep."""
    factor = triangular_factor(df, vector)
    values = np.linalg.svd(factor, compute_uv=False) if factor.size else np.zeros(0)
    whole = float(values @ values) or 1.0
    rows = [(i, float(v), float(v * v / whole)) for i, v in enumerate(values[:k])]
    return df.sparkSession.createDataFrame(rows, "component int, singular_value double, share double")


def low_rank(df: DataFrame, vector: str, k: int = 1, name: str = "rebuilt") -> DataFrame:
    """Rank-k reconstruction of each row, without centring. A null vector stays null."""
    factor = triangular_factor(df, vector)
    if not factor.size:
        return df.withColumn(name, F.lit(None).cast("array<double>"))
    v = np.linalg.svd(factor)[2][:k]
    return df.withColumn(name, projector(v.T @ v)(F.col(vector).cast("array<double>")))


# ---- matrices as (i, j, v) rows


def matrix_rows(df: DataFrame, row: str, vector: str) -> DataFrame:
    """Vector rows as cells of a matrix."""
    return df.select(F.col(row).alias("i"), F.posexplode(F.col(vector).cast("array<double>")).alias("j", "v")).withColumn(
        "j", F.col("j").cast("bigint")
    )


def matrix_transpose(a: DataFrame) -> DataFrame:
    return a.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def matrix_add(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("i", "j").agg(F.sum("v").alias("v"))


def matrix_scale(a: DataFrame, factor: float) -> DataFrame:
    return a.withColumn("v", F.col("v") * F.lit(factor))


def matrix_hadamard(a: DataFrame, b: DataFrame) -> DataFrame:
    """Element-wise product; a cell absent on one side is 0 and stays absent."""
    return a.join(b.withColumnRenamed("v", "__w"), ["i", "j"]).select("i", "j", (F.col("v") * F.col("__w")).alias("v"))


def matrix_product(a: DataFrame, b: DataFrame) -> DataFrame:
    """A B for a B with few cells per row (a weight matrix); products are summed before the shuffle."""
    left = a.select(F.col("i"), F.col("j").alias("__k"), F.col("v").alias("__a"))
    right = b.select(F.col("i").alias("__k"), F.col("j"), F.col("v").alias("__b"))
    return left.join(right, "__k").groupBy("i", "j").agg(F.sum(F.col("__a") * F.col("__b")).alias("v"))
