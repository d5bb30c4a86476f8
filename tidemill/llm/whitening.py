"""Embedding whitening on distinct vectors with their multiplicities as weights."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import cut

SCALE, SHIFT = 1024.0, 100_000.0
COMPONENTS = 8
MAX_DIMS = 4096  # a matrix of dimensions squared reaches the driver
RANK_LIMIT = 1e-12  # components whose eigenvalue is a smaller part of the largest one carry no variance
HOT = 10_000  # vectors held by more than one in so many rows are sent to every task; there are at most this many
EXACT = 1 << 62


@dataclass
class Fit:
    """The fit list's row count, exact sums per dimension, and the leading eigenpairs of its covariance."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray  # one column per component
    explained: np.ndarray


def _usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, finite)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Whole numbers x of a batch of vectors, as doubles; what a shorter vector lacks counts as 0."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lengths) and (lengths == dims).all():
        out = flat.reshape(len(lengths), dims)
    else:
        out = np.zeros((len(lengths), dims))
        out[np.arange(dims) < lengths[:, None]] = flat
    return np.floor(out * SCALE) + SHIFT


def _keys(x: np.ndarray) -> pa.Array:
    return pa.array([hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in x], pa.binary())


def keyed(rows: DataFrame, dims: int, with_x: bool) -> DataFrame:
    """`(key, x)` or `(vec_id, key)` of every usable row: equal x have equal keys, 128-bit digests of their bytes."""

    def run(batches):
        for b in batches:
            x = _matrix(b.column("v"), dims)
            if with_x:
                yield pa.RecordBatch.from_arrays([_keys(x), pa.array([r.tobytes() for r in x], pa.binary())], names=["key", "x"])
            else:
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), _keys(x)], names=["vec_id", "key"])

    return rows.mapInArrow(run, "key binary, x binary" if with_x else "vec_id long, key binary")


def _stack(b: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(b.column("x").to_pylist()), dtype=np.float64).reshape(b.num_rows, dims)
    return x, b.column("times").to_numpy(zero_copy_only=False)


def _exact(x: np.ndarray, times: int) -> np.ndarray:
    """x as integers whose products with `times` cannot overflow."""
    small = (not x.size) or np.abs(x).max() * max(times, 1) < EXACT
    return x.astype(np.int64) if small else np.vectorize(int, otypes=[object])(x)


def _sums(classes: DataFrame, dims: int) -> tuple[int, list[int]]:
    """The weighted row count and exact sums per dimension; one row per dimension reaches the driver."""

    def run(batches):
        total, seen = [0] * dims, 0
        for b in batches:
            x, times = _stack(b, dims)
            whole = int(times.sum())
            part = times @ _exact(x, whole)
            total = [a + int(p) for a, p in zip(total, part)]
            seen += whole
        parts = [(-1, seen), *enumerate(total)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in parts], pa.int32()), pa.array([str(v) for _, v in parts])], names=["dim", "v"]
        )

    found = classes.select("x", "times").mapInArrow(run, "dim int, v string").groupBy("dim").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v")
    )
    rows = {r["dim"]: int(r["v"]) for r in found.collect()}
    return rows.get(-1, 0), [rows.get(d, 0) for d in range(dims)]


def _covariance(classes: DataFrame, n: int, mean: np.ndarray) -> np.ndarray:
    """Centred weighted products, one matrix per task, added up over the tasks; divisor n."""
    dims = len(mean)
    upper = np.triu_indices(dims)

    def run(batches):
        total = np.zeros((dims, dims))
        for b in batches:
            x, times = _stack(b, dims)
            x = x - mean
            total += (x * times[:, None]).T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(total[upper])], names=["i", "j", "v"]
        )

    out = np.zeros((dims, dims))
    cells = classes.select("x", "times").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    for r in cells.collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out / n


def fit(classes: DataFrame, dims: int, components: int = COMPONENTS) -> Fit | None:
    """Eigenpairs of the covariance of `classes (x, times)`, the largest first; None without rows."""
    n, sums = _sums(classes, dims)
    if not n or not dims:
        return None
    mean = np.array([float(Fraction(s, n)) for s in sums])
    v = _covariance(classes, n, mean)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = min(components, int(np.sum(values > max(values[0], 0.0) * RANK_LIMIT)))
    return Fit(n, sums, mean, values[:kept], vectors[:, :kept], values[:kept] / np.trace(v))


def _whitened(f: Fit, dims: int):
    def run(batches):
        for b in batches:
            x, times = _stack(b, dims)
            wide = float(f.n) * (np.abs(x).max() if x.size else 0.0) + max(abs(s) for s in f.sums)
            whole = x.astype(np.int64) if wide < EXACT else np.vectorize(int, otypes=[object])(x)
            gap = f.n * whole - np.array(f.sums, dtype=whole.dtype)
            if dims * float(np.abs(gap).max() if gap.size else 0) ** 2 < EXACT:
                away = [int(v) for v in (gap * gap).sum(axis=1)]
            else:
                away = [sum(int(v) ** 2 for v in row) for row in gap]
            z = (x - f.mean) @ (f.vectors / np.sqrt(f.values))
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), pa.array(times, pa.int64()), pa.array([v if v < 1 << 63 else None for v in away], pa.int64()),
                 pa.array(list(z), pa.list_(pa.float64()))],
                names=["key", "times", "deviation", "z"],
            )

    return run


def _identity_error(done: DataFrame, n: int, kept: int) -> float:
    """The largest entry by which the whitened fit list's covariance differs from the identity."""
    z = lambda i: F.col("z")[i]
    row = done.agg(*[F.sum(z(i) * F.col("times")) for i in range(kept)]).first()
    mean = [v / n for v in row]
    pairs = [(i, j) for i in range(kept) for j in range(i, kept)]
    row = done.agg(*[F.sum((z(i) - mean[i]) * (z(j) - mean[j]) * F.col("times")) for i, j in pairs]).first()
    return max(abs(v / n - (i == j)) for (i, j), v in zip(pairs, row))


def whiten(vectors: DataFrame, components: int = COMPONENTS, multiplicity: bool = True) -> DataFrame:
    """`(vec_id, component, n, deviation, whitened, explained, identity_error)`: a row per usable row of
    `vectors (vec_id, embedding)` and component, numbered from 1.

    Rows whose vector is null or holds a null or non-finite entry are dropped. Entries c become x = floor(1024 c) + 100000. Equal x vectors
    are counted before they meet; each distinct one weighs as many rows as hold it, or 1 without `multiplicity`. The sums
    are exact, the mean is their correctly rounded quotient, and the weighted covariance (divisor `n`, the sum of the weights) is centred before it
    is multiplied. Every distinct vector is whitened once and joined back by a 128-bit digest of x: vectors
    held by more than one in 10,000 rows go to every task, all others meet by a shuffle.

    Components without variance (eigenvalue 1e-12 of the largest or less) are left out, so a single distinct vector gives no rows. Missing
    trailing entries count as 0 when lengths differ. `deviation` is null where it does not fit a long. Null and
    repeated `vec_id`s are kept as they are. More than 4,096 dimensions raise an error: the driver holds dimensions squared.
    """
    spark = vectors.sparkSession
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(_usable(F.col("v")))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    if dims > MAX_DIMS:
        raise ValueError(f"{dims} dimensions; the driver holds at most {MAX_DIMS}")
    times = F.count(F.lit(1)) if multiplicity else F.lit(1).cast("long")
    classes = cut(keyed(rows.select("v"), dims, True).groupBy("key", "x").agg(F.count(F.lit(1)).alias("held"), times.alias("times")))
    f = fit(classes, dims, components)
    if f is None or not len(f.values):
        return spark.createDataFrame([], schema)
    done = cut(classes.select("key", "x", "times").mapInArrow(
        _whitened(f, dims), "key binary, times long, deviation long, z array<double>"
    ))
    error = _identity_error(done, f.n, len(f.values))
    owners = keyed(rows, dims, False)
    total = classes.agg(F.sum("held")).first()[0]
    often = cut(classes.filter(F.col("held") * HOT > total).select("key"))  # at most HOT rows
    hot = F.broadcast(done.join(F.broadcast(often), "key", "left_semi"))
    common = owners.join(hot, "key")
    rare = owners.join(F.broadcast(often), "key", "left_anti").join(done, "key")
    joined = common.unionByName(rare)
    share = F.array(*[F.lit(float(e)) for e in f.explained])
    return joined.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(f.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
