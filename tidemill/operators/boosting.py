"""Regularised boosted trees: second-order boosting on gradient histograms, one aggregate per level.

The rows are written once, each feature as the number of its bin in one byte. A level of a tree is one pass over that table:
every task sums gradients by (node, feature, bin), the sums are added up by key, and what reaches the
driver is bounded by nodes x features x bins, whatever the number of rows. Trees travel back to the tasks as a few arrays.
A table that is counted to fit one task (`TASK_ROWS`) is not worth a job per level: the same levels are then summed inside that task,
so many small fits, as in a search, run side by side.
"""

from __future__ import annotations

import random
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.session import cut

BINS = 64  # bins per feature, 255 at most
TASK_ROWS = 100_000  # rows of a task at least: a level of a tree is a short job
KEEP = 16  # trees after which the rows are written again with their predictions


@dataclass(frozen=True)
class Tree:
    """A binary tree in heap order: node i has the children 2i + 1 and 2i + 2. Leaves have `feature` -1."""

    feature: np.ndarray
    bin: np.ndarray  # rows of this bin or a lower one go left
    weight: np.ndarray


def shrunk(g, l1: float):
    """The gradient sum that the first penalty leaves."""
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def leaf_weight(g, h, l1: float, l2: float):
    """The closed form of the best leaf: the shrunk gradient sum over the penalised sum of second derivatives."""
    return -shrunk(g, l1) / np.maximum(h + l2, 1e-12)


def worth(g, h, l1: float, l2: float):
    """What a leaf lowers the loss by, doubled."""
    return shrunk(g, l1) ** 2 / np.maximum(h + l2, 1e-12)


def route(bins: np.ndarray, tree: Tree, levels: int) -> np.ndarray:
    """The node that every row (features x rows of bin numbers) reaches after so many levels."""
    node = np.zeros(bins.shape[1], dtype=np.int64)
    at = np.arange(bins.shape[1])
    for _ in range(levels):
        feature = tree.feature[node]
        inner = feature >= 0
        right = bins[np.maximum(feature, 0), at] > tree.bin[node]
        node = np.where(inner, 2 * node + 1 + right, node)
    return node


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """(features x rows) bin numbers of a batch."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), width).T


def _drawn(place: np.ndarray, number: int, part: float, seed: int) -> np.ndarray:
    """Which rows take part in a tree: depends on the row's own number, the tree's and the seed alone, so a retried task draws alike."""
    if part >= 1.0:
        return np.ones(len(place), dtype=bool)
    salt = (number + (seed << 20)) * 0x9E3779B97F4A7C15 % (1 << 64)
    h = (place.view(np.uint64) ^ np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(11)).astype(np.float64) / float(1 << 53) < part


@dataclass(frozen=True)
class BoostedModel:
    edges: list[np.ndarray]  # per feature, the values above which the next bin begins
    base: float
    trees: list[Tree]
    depth: int
    features: str

    def binned(self, values: list) -> bytes:
        """Bin numbers of one row; null and NaN have the lowest bin for themselves."""
        x = np.array([-np.inf if v is None or v != v else v for v in values], dtype=np.float64)
        return bytes(int(np.searchsorted(e, v, side="left")) for e, v in zip(self.edges, x))

    def scores(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(bins.shape[1], self.base)
        for t in self.trees:
            out += t.weight[route(bins, t, self.depth)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """`df` with `prediction`. A null or NaN feature lies below all values, apart from them."""

        @F.arrow_udf("double")
        def predict(x: pa.Array) -> pa.Array:
            rows = x.to_pylist()
            bins = np.array([list(self.binned(r)) for r in rows], dtype=np.uint8).reshape(len(rows), len(self.edges)).T
            return pa.array(self.scores(bins))

        return df.withColumn("prediction", predict(_array(df, self.features)))

    def gains(self) -> dict[int, int]:
        """How often each feature splits a node."""
        seen = np.concatenate([t.feature[t.feature >= 0] for t in self.trees] or [np.zeros(0, np.int64)])
        return {int(f): int(n) for f, n in zip(*np.unique(seen, return_counts=True))}


def _array(df: DataFrame, features: str):
    column = F.col(features)
    if not isinstance(df.schema[features].dataType, T.ArrayType):
        column = vector_to_array(column)
    return column.cast("array<double>")


@dataclass(frozen=True)
class Binned:
    """Rows to learn from, `table (b, y, p, place)`: bin numbers, label, mean label, row number. `tasks` is what they fill."""

    edges: list[np.ndarray]
    base: float
    table: DataFrame | None
    tasks: int


@dataclass(frozen=True)
class PenalisedTrees:
    """Settings of the second kind of boosted trees, for squared loss.

    `columns` is the share of features drawn per tree, `subsample` that of rows, `weight` the least sum of second derivatives (here, of
    rows) of a child, `gain` the least drop of the doubled loss that a split must bring, `l1` and `l2` the penalties of leaf weights.
    """

    rounds: int = 300
    rate: float = 0.07
    depth: int = 6
    subsample: float = 0.85
    columns: float = 0.8
    weight: float = 1.0
    gain: float = 0.0
    l1: float = 0.0
    l2: float = 1.0
    seed: int = 42
    features: str = "features"
    label: str = "label"
    bins: int = field(default=BINS)

    def copy(self, **changes) -> PenalisedTrees:
        return replace(self, **changes)

    def fit(self, df: DataFrame) -> BoostedModel:
        """A model learnt from `features` (a vector, or an array of doubles of one length) and `label`.

        Rows without a label are left out. Features are cut at approximate quantiles. Nothing to learn from gives a model that predicts 0.
        """
        return self.fit_binned(self.binned(df))

    def binned(self, df: DataFrame) -> Binned:
        """The rows to learn from as bin numbers, written once; fits with other settings (but `bins`) may share them."""
        rows = df.select(_array(df, self.features).alias("x"), F.col(self.label).cast("double").alias("y")).filter(
            "y IS NOT NULL AND x IS NOT NULL"
        )
        first = rows.agg(F.avg("y").alias("base"), F.max(F.size("x")).alias("width"), F.count(F.lit(1)).alias("n")).first()
        if not first["width"]:
            return Binned([], first["base"] or 0.0, None, 0)
        blank = BoostedModel(self._edges(rows, first["width"]), first["base"], [], self.depth, self.features)

        @F.arrow_udf("binary")
        def to_bins(x: pa.Array) -> pa.Array:
            return pa.array([blank.binned(r) for r in x.to_pylist()], pa.binary())

        table = rows.select(to_bins("x").alias("b"), "y", F.lit(first["base"]).alias("p"))
        # a number of its own for every row, written with it
        table = table.withColumn("place", F.xxhash64(F.monotonically_increasing_id()))
        tasks = -(-first["n"] // TASK_ROWS)
        return Binned(blank.edges, first["base"], cut(table.coalesce(tasks)), tasks)

    def fit_binned(self, data: Binned) -> BoostedModel:
        width = len(data.edges)
        model = BoostedModel(data.edges, data.base, [], self.depth, self.features)
        if not width or not self.rounds:
            return model
        if data.tasks == 1:
            return replace(model, trees=self._fit_in_task(data, width))
        table, fresh = data.table, []
        for number in range(self.rounds):
            histograms = lambda tree, level: self._histograms(table, fresh, width, tree, level, number)  # noqa: E731, B023
            tree = self._grow(histograms, width, self._columns(width, number))
            model.trees.append(tree)
            fresh.append(tree)
            if len(fresh) == KEEP and number + 1 < self.rounds:
                table, fresh = cut(self._advanced(table, fresh, width)), []
        return model

    def _columns(self, width: int, number: int) -> list[int]:
        draw = random.Random(self.seed * 1_000_003 + number)
        return sorted(draw.sample(range(width), max(1, round(width * self.columns))))

    def _fit_in_task(self, data: Binned, width: int) -> list[Tree]:
        """All trees, grown where the rows are; as many rows come back as there are trees."""

        def run(batches):
            held = [(_matrix(b.column("b"), width), b.column("y").to_numpy(), b.column("p").to_numpy(), b.column("place").to_numpy()) for b in batches]
            if not held:
                return
            bins, y, p, place = (np.concatenate(part, axis=-1) for part in zip(*held))
            for number in range(self.rounds):
                drawn = _drawn(place, number, self.subsample, self.seed)
                own, g = bins[:, drawn], (p - y)[drawn]
                tree = self._grow(lambda tree, level: self._sums(own, g, tree, level), width, self._columns(width, number))  # noqa: B023
                p = p + tree.weight[route(bins, tree, self.depth)]
                columns = [number, tree.feature.tolist(), tree.bin.tolist(), tree.weight.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], k) for v, k in zip(columns, (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64())))],
                    names=["number", "feature", "bin", "weight"],
                )

        rows = data.table.coalesce(1).mapInArrow(run, "number int, feature array<long>, bin array<long>, weight array<double>").collect()
        return [Tree(*(np.array(r[k]) for k in ("feature", "bin", "weight"))) for r in sorted(rows, key=lambda r: r["number"])]

    def _sums(self, bins: np.ndarray, g: np.ndarray, tree: Tree, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Gradient sums and row counts of the given rows as arrays (nodes of the level x features x bins)."""
        width, first, nodes = len(bins), (1 << level) - 1, 1 << level
        node = route(bins, tree, level)
        open_rows = node >= first
        at = ((node[open_rows] - first) * (width * self.bins) + (np.arange(width) * self.bins)[:, None] + bins[:, open_rows]).ravel()
        shape = (nodes, width, self.bins)
        g_sum = np.bincount(at, weights=np.tile(g[open_rows], width), minlength=nodes * width * self.bins)
        return g_sum.reshape(shape), np.bincount(at, minlength=nodes * width * self.bins).astype(np.float64).reshape(shape)

    def _edges(self, rows: DataFrame, width: int) -> list[np.ndarray]:
        probs = [i / (self.bins - 1) for i in range(1, self.bins - 1)]
        value = lambda i: F.when(~F.isnan(F.col("x")[i]), F.col("x")[i])
        found = rows.agg(*[F.percentile_approx(value(i), probs, 100 * self.bins).alias(f"q{i}") for i in range(width)]).first()
        return [np.unique(np.array([-np.inf, *(q or [])], dtype=np.float64)) for q in found]

    def _advanced(self, table: DataFrame, fresh: list[Tree], width: int) -> DataFrame:
        """The rows with the predictions that the fresh trees add up to."""
        depth = self.depth

        def run(batches):
            for b in batches:
                bins, p = _matrix(b.column("b"), width), b.column("p").to_numpy().copy()
                for t in fresh:
                    p += t.weight[route(bins, t, depth)]
                yield pa.RecordBatch.from_arrays([b.column("b"), b.column("y"), pa.array(p), b.column("place")], names=["b", "y", "p", "place"])

        return table.mapInArrow(run, table.schema)

    def _histograms(self, table: DataFrame, fresh: list[Tree], width: int, tree: Tree, level: int, number: int):
        """`_sums` over all tasks."""
        shape = (1 << level, width, self.bins)

        def run(batches):
            g_sum, h_sum = np.zeros(shape), np.zeros(shape)
            for b in batches:
                bins, p = _matrix(b.column("b"), width), b.column("p").to_numpy().copy()
                for t in fresh:
                    p += t.weight[route(bins, t, self.depth)]
                drawn = _drawn(b.column("place").to_numpy(), number, self.subsample, self.seed)
                g, h = self._sums(bins[:, drawn], (p - b.column("y").to_numpy())[drawn], tree, level)
                g_sum += g
                h_sum += h
            at = np.flatnonzero(h_sum)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(g_sum.ravel()[at]), pa.array(h_sum.ravel()[at])], names=["cell", "g", "h"])

        parts = table.mapInArrow(run, "cell long, g double, h double").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        found = parts.toPandas()
        g, h = np.zeros(shape), np.zeros(shape)
        g.ravel()[found["cell"].to_numpy()], h.ravel()[found["cell"].to_numpy()] = found["g"].to_numpy(), found["h"].to_numpy()
        return g, h

    def _grow(self, histograms, width: int, chosen: list[int]) -> Tree:
        """One tree, level by level from its `histograms (tree, level)`; at each node the split with the largest gain, the first feature and lowest bin on a tie."""
        count = (1 << (self.depth + 1)) - 1
        tree = Tree(np.full(count, -1), np.zeros(count, dtype=np.int64), np.zeros(count))
        g_node, h_node = np.zeros(count), np.zeros(count)
        alive = {0}
        for level in range(self.depth):
            first = (1 << level) - 1
            if not any(first <= i < 2 * first + 1 for i in alive):
                break
            g, h = histograms(tree, level)
            if level == 0:
                g_node[0], h_node[0] = g[0, 0].sum(), h[0, 0].sum()
            gl, hl = np.cumsum(g, axis=2), np.cumsum(h, axis=2)
            gr, hr = gl[:, :, -1:] - gl, hl[:, :, -1:] - hl
            gain = worth(gl, hl, self.l1, self.l2) + worth(gr, hr, self.l1, self.l2)
            own = np.arange(first, 2 * first + 1)
            gain -= worth(g_node[own], h_node[own], self.l1, self.l2)[:, None, None]
            allowed = np.zeros(width, dtype=bool)
            allowed[chosen] = True
            gain[(hl < self.weight) | (hr < self.weight) | ~allowed[None, :, None]] = -np.inf
            best = gain.reshape(len(own), -1).argmax(axis=1)
            for i, cell in zip(own.tolist(), best.tolist()):
                f, b = divmod(cell, self.bins)
                if i not in alive or not gain[i - first, f, b] > max(self.gain, 1e-9):
                    continue
                tree.feature[i], tree.bin[i] = f, b
                for child, (gs, hs) in ((2 * i + 1, (gl, hl)), (2 * i + 2, (gr, hr))):
                    g_node[child], h_node[child] = gs[i - first, f, b], hs[i - first, f, b]
                    alive.add(child)
                alive.discard(i)
        for i in alive:
            tree.weight[i] = self.rate * leaf_weight(g_node[i], h_node[i], self.l1, self.l2)
        return tree
