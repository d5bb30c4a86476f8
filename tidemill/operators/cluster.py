"""k-means, silhouettes and density clusters."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import product

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.ordering import global_index
from tidemill.session import cut, spread

BLOCK_BYTES = 8 << 20  # components of a block of rows, eight bytes each
NEAR = 1e-4  # squared distances below this share of the squared lengths are taken from differences
PAIR_CELLS = 1 << 20  # components of such differences held at a time
JOINED_AT = (1, 4, 10)  # levels of smaller boxes after which pairs of cells that links join anyway are dropped
FIT_ROWS = 32_768  # rows that a pass over k-means fits works on at a time


def with_vector(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(F.array(*[F.col(c).cast("double") for c in columns])))


def kmeans_inertia(df: DataFrame, ks: Sequence[int] = range(2, 11), restarts: int = 10, seed: int = 42) -> DataFrame:
    """Least within-cluster sum of squares over `restarts` seeds for each k."""
    fits = _fits(df, [(k, seed + r) for k in ks for r in range(restarts)])
    rows = [(int(k), min(cost for (own, _), _c, cost in fits if own == k)) for k in ks]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def kmeans_labels(df: DataFrame, k: int = 3, restarts: int = 10, seed: int = 42) -> DataFrame:
    """Labels of the best of `restarts` fits."""
    _, best, _ = min(_fits(df, [(k, seed + r) for r in range(restarts)]), key=lambda fit: fit[2])
    centres = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(best.tolist())], "centroid int, centre array<double>")
    near = nearest_centroid(df.withColumn("__v", vector_to_array("features")), "__v", centres)
    return near.drop("__v", "distance2")


def _fits(df: DataFrame, settings: Sequence[tuple[int, int]], steps: int = 20, tolerance: float = 1e-4) -> list[tuple]:
    """Fits by `(k, seed)`: `(setting, centres, cost)`, all of them moved on in each pass over the rows.

    Centres are drawn as in k-means++, then moved to the means of their rows until none goes farther than `tolerance`, `steps`
    times at most. The cost is that of the centres returned. A pass gives one row of sums per task and centre.
    """
    blocks = _blocks(df).persist()
    try:
        fits = list(range(len(settings)))
        centres = [None] * len(settings)
        for step in range(max(k for k, _ in settings)):
            asked = {f: (centres[f], settings[f]) for f in fits if settings[f][0] > step}
            for f, row in _drawn(blocks, asked, step).items():
                centres[f] = np.vstack([row] if centres[f] is None else [centres[f], row])
        if any(c is None for c in centres):
            raise ValueError("no rows to cluster")
        open_fits = fits
        for _ in range(steps):
            means = _means(blocks, {f: centres[f] for f in open_fits})
            moved = {f: max(((m - centres[f]) ** 2).sum(axis=1)) > tolerance**2 for f, m in means.items()}
            for f, m in means.items():
                centres[f] = m
            open_fits = [f for f in open_fits if moved[f]]
            if not open_fits:
                break
        costs = _costs(blocks, dict(enumerate(centres)))
        return [(settings[f], centres[f], costs[f]) for f in fits]
    finally:
        blocks.unpersist()


def _blocks(df: DataFrame) -> DataFrame:
    """The vectors, many to a row: `(block, width, v)`, their components one after the other."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, count, held = TaskContext.get().partitionId(), 0, []

        def packed() -> pd.DataFrame:
            x = np.concatenate(held)
            if not np.isfinite(x).all():
                raise ValueError("vectors hold components that are not finite")
            return pd.DataFrame({"block": [(part << 32) + count], "width": [x.shape[1]], "v": [x.ravel()]})

        for pdf in batches:
            if len(pdf):
                held.append(np.stack(pdf["v"].to_numpy()).astype(float))
            if sum(len(x) for x in held) >= FIT_ROWS or sum(x.nbytes for x in held) >= BLOCK_BYTES:
                yield packed()
                count, held = count + 1, []
        if held:
            yield packed()

    return spread(df.select(vector_to_array("features").alias("v"))).mapInPandas(pack, "block long, width int, v array<double>")


def _unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, np.ndarray]]:
    """Each block's number and its vectors side by side, a component to a row."""
    for pdf in batches:
        for block, width, v in zip(pdf["block"], pdf["width"], pdf["v"]):
            yield block, np.ascontiguousarray(np.asarray(v, dtype=float).reshape(-1, width).T)


def _closest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The closest centre of each column of `x`."""
    middle = x.mean(axis=1, keepdims=True)
    near = centres - middle.T  # products lose few digits next to the rows' own middle
    score = (-2 * near) @ (x - middle)
    score += (near * near).sum(axis=1)[:, None]
    label, least = np.zeros(x.shape[1], dtype=np.int32), score[0]
    for j in range(1, len(centres)):
        np.copyto(label, j, where=score[j] < least)
        np.minimum(least, score[j], out=least)
    return label


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of each column of `x` to the closest centre, from differences: 0 where they are equal."""
    gap = x - centres.T[:, _closest(x, centres)]
    return np.einsum("ij,ij->j", gap, gap)


def _drawn(blocks: DataFrame, asked: dict, step: int) -> dict[int, np.ndarray]:
    """One more centre for each fit: a row drawn by its squared distance to the centres so far, any row at first.

    Each block draws one of its rows and a number that is the larger the farther its rows are; the largest number wins. That is
    a draw from all rows by the same shares. Fits whose centres are all the different rows get none.
    """

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, x in _unpacked(batches):
            found = []
            for f, (centres, (k, seed)) in asked.items():
                upto = np.cumsum(np.ones(x.shape[1]) if centres is None else _squared(x, centres))
                if upto[-1] > 0:
                    place, luck = np.random.default_rng([seed, k, step, block]).random(2)
                    at = min(int(np.searchsorted(upto, place * upto[-1], side="right")), len(upto) - 1)
                    found.append((f, np.log1p(-luck) / upto[-1], block, x[:, at]))
            yield pd.DataFrame(found, columns=["fit", "luck", "block", "row"])

    drawn = blocks.mapInPandas(draw, "fit int, luck double, block long, row array<double>")
    best = drawn.groupBy("fit").agg(F.max_by("row", F.struct("luck", "block")).alias("row"))
    return {r["fit"]: np.array(r["row"]) for r in best.collect()}


def _means(blocks: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The mean of the rows closest to each centre; a centre without rows stays."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = {f: np.zeros((len(c), c.shape[1] + 1)) for f, c in centres.items()}
        for _, x in _unpacked(batches):
            for f, c in centres.items():
                label = _closest(x, c)
                totals[f] += np.stack([np.bincount(label, weights=w, minlength=len(c)) for w in [*x, None]], axis=1)
        rows = [(f, j, t) for f, ts in totals.items() for j, t in enumerate(ts) if t[-1]]
        yield pd.DataFrame(rows, columns=["fit", "centre", "t"])

    width = next(iter(centres.values())).shape[1]
    sums = blocks.mapInPandas(add, "fit int, centre int, t array<double>").groupBy("fit", "centre").agg(
        F.array(*[F.sum(F.get("t", i)) for i in range(width + 1)]).alias("t")
    )
    means = {f: c.copy() for f, c in centres.items()}
    for r in sums.collect():
        means[r["fit"]][r["centre"]] = np.array(r["t"][:-1]) / r["t"][-1]
    return means


def _costs(blocks: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, float]:
    """Sum of the squared distances of all rows to the closest centre."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, x in _unpacked(batches):
            yield pd.DataFrame({"fit": list(centres), "cost": [_squared(x, c).sum() for c in centres.values()]})

    sums = blocks.mapInPandas(add, "fit int, cost double").groupBy("fit").agg(F.sum("cost").alias("cost"))
    return {r["fit"]: r["cost"] for r in sums.collect()}


def nearest_centroid(df: DataFrame, vector: str, centroids: DataFrame) -> DataFrame:
    """Assign each row to the nearest of a few given centres `(centroid, centre array<double>)`.

    The centres travel as one scalar value (k times d numbers), so rows are neither shuffled
    nor multiplied.
    """
    all_centres = centroids.agg(
        F.sort_array(F.collect_list(F.struct(F.col("centroid").alias("id"), F.col("centre").alias("c")))).alias("cs")
    ).scalar()
    v = F.col(vector).cast("array<double>")

    def squared(c: Column) -> Column:
        return F.aggregate(F.zip_with(v, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)

    best = F.array_min(F.transform("__all", lambda s: F.struct(squared(s["c"]).alias("d"), s["id"].alias("id"))))
    return df.withColumn("__all", all_centres).withColumn("__best", best).drop("__all").withColumns(
        {"cluster": F.col("__best.id"), "distance2": F.col("__best.d")}
    ).drop("__best")


def label_centroids(df: DataFrame, vector: str, label: str) -> DataFrame:
    """Mean vector per label, summed element by element before the shuffle."""
    cells = df.select(F.col(label).alias("centroid"), F.posexplode(F.col(vector).cast("array<double>")).alias("i", "v"))
    means = cells.groupBy("centroid", "i").agg(F.avg("v").alias("m"))
    # one entry per dimension
    return means.groupBy("centroid").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centre")
    )


def silhouette_squared(df: DataFrame, features: str = "features", label: str = "cluster") -> float:
    """Silhouette on squared distances: linear in the rows, another number than the Euclidean one."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=label, distanceMeasure="squaredEuclidean").evaluate(df)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of the rows of `a` and `b`, from one matrix product.

    Squares that are small against the rows' own lengths lose digits in the product, as do non-finite ones; those are
    taken again from differences.
    """
    na, nb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    d2 = np.column_stack([-2 * a, na, np.ones(len(a))]) @ np.column_stack([b, np.ones(len(b)), nb]).T
    sure = d2 > (NEAR * (na + nb.max()))[:, None]
    if not sure.all():
        rows, cols = np.nonzero(~sure)
        step = max(1, PAIR_CELLS // max(1, a.shape[1]))
        for s in range(0, len(rows), step):
            r, c = rows[s : s + step], cols[s : s + step]
            gap = a[r] - b[c]
            d2[r, c] = np.einsum("ij,ij->i", gap, gap)
    return np.sqrt(d2, out=d2)


def _runs(labels: np.ndarray) -> np.ndarray:
    """Where each run of equal labels begins."""
    return np.array([i for i in range(len(labels)) if i == 0 or labels[i] != labels[i - 1]])


def _block_sums(one: tuple, two: tuple, rows: int = 128, columns: int = 2048):
    """Sums of distances `(id, own, other, total)` of each row of a block to each label of the other, in both directions.

    A block is `(ids, labels, vectors)` with equal labels side by side; a block with itself is asked once. No more is held
    than the distances of one tile and the sums of a few rows.
    """
    (ids, labels, a), (other_ids, other_labels, b) = one, two
    mirrored = one is not two
    with np.errstate(invalid="ignore", over="ignore"):
        # squares stay small next to the block's own middle
        middle = np.where(np.isfinite(a), a, 0.0).mean(axis=0)
        a, b = a - middle, b - middle
        runs_b = _runs(other_labels)
        ends = np.append(_runs(labels)[1:], len(a))
        start = 0
        for end in ends:
            back = np.zeros(len(b))
            for s in range(start, end, rows):
                part = a[s : min(s + rows, end)]
                there = np.zeros((len(part), len(runs_b)))
                for t in range(0, len(b), columns):
                    gap = _distances(part, b[t : t + columns])
                    first = np.searchsorted(runs_b, t, side="right") - 1
                    inside = runs_b[first + 1 : np.searchsorted(runs_b, t + gap.shape[1])] - t
                    sums = np.add.reduceat(gap, np.concatenate([[0], inside]).astype(int), axis=1)
                    there[:, first : first + sums.shape[1]] += sums
                    if mirrored:
                        back[t : t + gap.shape[1]] += gap.sum(axis=0)
                yield pd.DataFrame(
                    {
                        "id": np.repeat(ids[s : s + len(part)], len(runs_b)), "own": labels[start],
                        "other": np.tile(other_labels[runs_b], len(part)), "total": there.ravel(),
                    }
                )
            if mirrored:
                yield pd.DataFrame({"id": other_ids, "own": other_labels, "other": labels[start], "total": back})
            start = end


def silhouette_rows(df: DataFrame, key: str, vector: str, label: str, block: int | None = None) -> DataFrame:
    """Euclidean silhouette value of each row.

    Quadratic by definition. Rows are packed into blocks in the order of their labels; a task multiplies two
    blocks, each pair of blocks once, and emits one sum per row and label, never the pairs themselves. The number of
    those sums is the number of rows times that of blocks, or of labels if that is more. `block` is the rows of
    a block; it follows from the rows and their width.
    """
    rows = cut(
        global_index(
            df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"), F.col(label).alias("label")),
            "label", "id", name="pos",
        )
    )
    n, width, least = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.min(F.size("v"))).first()
    if width != least:
        raise ValueError(f"vectors of {least} to {width} components")
    if block is None:
        block = min(max(256, -(-n // 16)), max(1, BLOCK_BYTES // (8 * max(1, width or 0))))
    last = max(0, n - 1) // block
    items = F.sort_array(F.collect_list(F.struct("pos", "id", "label", "v")))
    packed = cut(
        rows.groupBy(F.floor(F.col("pos") / block).alias("blk")).agg(items.alias("items")).select(
            "blk", F.col("items.id").alias("ids"), F.col("items.label").alias("labels"), F.flatten("items.v").alias("v")
        )
    )
    met = packed.withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint")))).select(
        F.least("blk", "with").alias("i"), F.greatest("blk", "with").alias("j"), "blk", "ids", "labels", "v"
    )

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = [
            (np.asarray(ids), np.asarray(labels), np.asarray(v, dtype=float).reshape(len(ids), -1))
            for pdf in batches for ids, labels, v in zip(pdf["ids"], pdf["labels"], pdf["v"])
        ]
        held, size = [], 0
        for frame in _block_sums(both[0], both[-1]):
            held.append(frame)
            size += len(frame)
            if size >= 65_536:
                yield pd.concat(held)
                held, size = [], 0
        if held:
            yield pd.concat(held)

    kinds = dict(rows.dtypes)
    spread = met.groupBy("i", "j").applyInPandas(
        sums, f"id {kinds['id']}, own {kinds['label']}, other {kinds['label']}, total double"
    )
    totals = spread.groupBy("id", "own", "other").agg(F.sum("total").alias("total"))
    sizes = rows.groupBy(F.col("label").alias("other")).agg(F.count(F.lit(1)).alias("n"))
    means = totals.join(sizes, "other")
    mine, away = F.col("own") == F.col("other"), F.col("own") != F.col("other")
    per_row = means.groupBy("id", "own").agg(
        F.max(F.when(mine, F.col("n"))).alias("n_own"),
        F.max(F.when(mine, F.try_divide(F.col("total"), F.col("n") - 1))).alias("a"),
        F.min(F.when(away, F.col("total") / F.col("n"))).alias("b"),
    )
    value = F.when(F.col("n_own") == 1, 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return per_row.select("id", F.col("own").alias("label"), value.alias("silhouette"))


# ---- density clusters


def _gap2(lo_a, hi_a, lo_b, hi_b) -> Column:
    """Squared distance between two boxes."""
    low = F.zip_with(lo_b, hi_a, lambda x, y: x - y)
    high = F.zip_with(lo_a, hi_b, lambda x, y: x - y)
    gaps = F.zip_with(low, high, lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g * g)


def _span2(lo_a, hi_a, lo_b, hi_b) -> Column:
    """Squared largest distance between points of two boxes."""
    up = F.zip_with(hi_b, lo_a, lambda x, y: x - y)
    down = F.zip_with(hi_a, lo_b, lambda x, y: x - y)
    spans = F.zip_with(up, down, lambda x, y: F.greatest(x, y))
    return F.aggregate(spans, F.lit(0.0), lambda acc, g: acc + g * g)


def _dist2(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x)


def _boxes(points: DataFrame, keys: Sequence[str], dims: int) -> DataFrame:
    """Tight bounding box per key."""
    return points.groupBy(*keys).agg(
        F.array(*[F.min(F.col("x")[i]) for i in range(dims)]).alias("lo"),
        F.array(*[F.max(F.col("x")[i]) for i in range(dims)]).alias("hi"),
    )


def _neighbour_cells(cells: DataFrame, dims: int, eps2: float) -> DataFrame:
    """Ordered pairs of different occupied cells that could hold points within reach.

    Cells meet on the shifted coordinates of as many leading dimensions as keep the number of
    shifts below 700; the boxes decide the rest.
    """
    reach = math.isqrt(dims) + 1
    lead = dims
    while lead > 1 and (2 * reach + 1) ** lead > 700:
        lead -= 1
    shifts = F.array(*[F.array(*[F.lit(s) for s in shift]) for shift in product(range(-reach, reach + 1), repeat=lead)])
    head = F.slice("cell", 1, lead)
    a = cells.select(
        F.col("cell").alias("a"), F.col("n").alias("na"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"),
        F.explode(shifts).alias("s"), head.alias("head"),
    ).withColumn("key", F.zip_with("head", "s", lambda x, y: x + y))
    b = cells.select(
        F.col("cell").alias("b"), F.col("n").alias("nb"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"), head.alias("key")
    )
    met = a.join(b, "key").filter(F.col("a") != F.col("b"))
    return met.filter(_gap2(F.col("lo_a"), F.col("hi_a"), F.col("lo_b"), F.col("hi_b")) <= eps2).select("a", "b", "na", "nb")


def _salted_join(few: DataFrame, points: DataFrame, sizes: DataFrame, per_task: int = 100_000) -> DataFrame:
    """Join query points `few(b, …)` with all points of cell `b`; big cells are split over several keys."""
    parts = sizes.select("cell", F.ceil(F.col("n") / per_task).alias("parts"))
    big = points.join(parts, "cell").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("parts")))
    asked = (
        few.join(parts.withColumnRenamed("cell", "b"), "b")
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        .drop("parts")
    )
    return asked.join(
        big.select(F.col("cell").alias("b"), "salt", F.col("id").alias("other"), F.col("x").alias("y")), ["b", "salt"]
    )


def _linked_cells(core: DataFrame, pairs: DataFrame, dims: int, side: float, eps2: float, levels: int = 30) -> DataFrame:
    """Cell pairs (a < b) with core points of both within reach, as many as join all cells that belong together, decided by
    ever smaller boxes.

    A pair is linked once two sub-boxes lie wholly within reach of each other, and dropped once
    no sub-boxes can touch, or once linked pairs join its cells over others: it would change no cluster. Only the undecided
    sub-box pairs go to the next level, so hot cells are never compared point by point. What is undecided after the last level are boxes of hardly any size, around the edge of
    reach: the different points of those are compared.
    """
    linked, known = [], 0
    nodes = cut(core.groupBy("cell").agg(F.min("id").alias("node")))
    halves = core
    open_pairs = None
    for level in range(levels):
        size = side / 2**level
        keyed = halves.withColumn("sub", F.transform("x", lambda v: F.floor(v / size)))
        boxes = _boxes(keyed, ["cell", "sub"], dims).withColumn("parent", F.transform("sub", lambda k: F.floor(k / 2)))
        a = boxes.select(F.col("cell").alias("a"), F.col("sub").alias("sa"), F.col("parent").alias("pa"), F.col("lo").alias("la"), F.col("hi").alias("ha"))
        b = boxes.select(F.col("cell").alias("b"), F.col("sub").alias("sb"), F.col("parent").alias("pb"), F.col("lo").alias("lb"), F.col("hi").alias("hb"))
        if open_pairs is None:
            met = pairs.join(a, "a").join(b, "b")
        else:
            met = open_pairs.join(a, ["a", "pa"]).join(b, ["b", "pb"])
        judged = cut(
            met.select(
                "a", "b", "sa", "sb",
                _gap2(F.col("la"), F.col("ha"), F.col("lb"), F.col("hb")).alias("near"),
                _span2(F.col("la"), F.col("ha"), F.col("lb"), F.col("hb")).alias("far"),
            ).filter(F.col("near") <= eps2)
        )
        sure = judged.filter(F.col("far") <= eps2).select("a", "b").distinct()
        left = judged.join(sure, ["a", "b"], "left_anti")
        linked.append(sure)
        if level in JOINED_AT:
            # cells joined before count as one node
            nodes = cut(_joined_cells(nodes, reduce(DataFrame.unionByName, linked[known:])).withColumnRenamed("label", "node"))
            known = len(linked)
            left = left.join(nodes.select(F.col("cell").alias("a"), F.col("node").alias("na")), "a").join(
                nodes.select(F.col("cell").alias("b"), F.col("node").alias("nb")), "b"
            ).filter(F.col("na") != F.col("nb"))
        open_pairs = cut(left.select("a", "b", F.col("sa").alias("pa"), F.col("sb").alias("pb")))
        if open_pairs.isEmpty():
            break
        alive = open_pairs.select(F.col("a").alias("cell")).union(open_pairs.select("b")).distinct()
        halves = core.join(alive, "cell", "left_semi")
    else:
        spots = cut(keyed.select("cell", "sub", "x").distinct())
        a = spots.select(F.col("cell").alias("a"), F.col("sub").alias("pa"), F.col("x").alias("xa"))
        b = spots.select(F.col("cell").alias("b"), F.col("sub").alias("pb"), F.col("x").alias("xb"))
        met = open_pairs.join(a, ["a", "pa"]).join(b, ["b", "pb"])
        linked.append(met.filter(_dist2(F.col("xa"), F.col("xb")) <= eps2).select("a", "b").distinct())
    return reduce(DataFrame.unionByName, linked).distinct()


def _joined_cells(names: DataFrame, links: DataFrame) -> DataFrame:
    """The cells of `names (cell, node)` with the smallest node that links `(a, b)` join them to, as `(cell, label)`."""
    edges = links.join(names.select(F.col("cell").alias("a"), F.col("node").alias("src")), "a").join(
        names.select(F.col("cell").alias("b"), F.col("node").alias("dst")), "b"
    )
    return names.join(connected_labels(names.select("node").distinct(), edges), "node").select("cell", "label")


def connected_labels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest node id of each component: all nodes of a label hook to the least label beside any of them, then jump to that label's own."""
    both = cut(edges.select("src", "dst").union(edges.select(F.col("dst"), F.col("src"))).distinct())
    labels = cut(nodes.select("node", F.col("node").alias("label")))
    while True:
        beside = both.join(labels.withColumnRenamed("node", "dst"), "dst").select(F.col("src").alias("node"), F.col("label").alias("near"))
        least = beside.groupBy("node").agg(F.min("near").alias("near")).join(labels, "node")
        moves = cut(least.groupBy("label").agg(F.min("near").alias("to")).filter(F.col("to") < F.col("label")))
        if moves.isEmpty():
            return labels
        jump = moves.select(F.col("label").alias("to"), F.col("to").alias("root"))
        moves = moves.join(jump, "to", "left").select("label", F.coalesce("root", "to").alias("root"))
        labels = cut(labels.join(moves, "label", "left").select("node", F.coalesce("root", "label").alias("label")))


def density_clusters(df: DataFrame, key: str, columns: Sequence[str], eps: float = 1.5, min_points: int = 5) -> DataFrame:
    """Density clusters: `(id, label, core)`, label -1 for noise.

    A point is core when at least `min_points` points, itself included, lie within `eps`. A
    cluster is named by its smallest core id, and a border point joins the smallest cluster in
    reach. Cells are so small that two points of one cell are always neighbours: full cells
    need no distances at all.
    """
    dims, eps2 = len(columns), eps * eps
    side = eps / math.sqrt(dims) * (1 - 1e-12)
    x = F.array(*[F.col(c).cast("double") for c in columns])
    points = cut(
        df.select(F.col(key).alias("id"), x.alias("x")).withColumn("cell", F.transform("x", lambda v: F.floor(v / side)))
    )
    boxes = _boxes(points, ["cell"], dims)
    cells = cut(points.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).join(boxes, "cell"))
    pairs = cut(_neighbour_cells(cells, dims, eps2))

    thin = cells.filter(F.col("n") < min_points).select("cell", "n")
    sparse = points.join(thin, "cell")
    asked = sparse.join(pairs.select(F.col("a").alias("cell"), "b"), "cell").select("id", "x", "b")
    near = (
        _salted_join(asked, points, cells)
        .filter(_dist2(F.col("x"), F.col("y")) <= eps2)
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("near"))
    )
    thin_core = sparse.join(near, "id", "left").select(
        "id", "x", "cell", (F.col("n") + F.coalesce("near", F.lit(0)) >= min_points).alias("core")
    )
    full_core = points.join(thin, "cell", "left_anti").select("id", "x", "cell", F.lit(True).alias("core"))
    flagged = cut(full_core.unionByName(thin_core))

    core = cut(flagged.filter("core").select("id", "x", "cell"))
    names = cut(core.groupBy("cell").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("n")))
    core_pairs = (
        pairs.filter(F.col("a") < F.col("b")).select("a", "b")
        .join(names.select(F.col("cell").alias("a")), "a", "left_semi")
        .join(names.select(F.col("cell").alias("b")), "b", "left_semi")
    )
    links = _linked_cells(core, core_pairs, dims, side, eps2)
    labels = cut(_joined_cells(names, links).join(names.select("cell", "n"), "cell"))

    core_rows = core.join(labels, "cell").select("id", "label", F.lit(1).alias("core"))
    rest = flagged.filter(~F.col("core"))
    around = pairs.select(F.col("a").alias("cell"), "b").union(cells.select("cell", F.col("cell").alias("b")))
    seekers = rest.join(around, "cell").select("id", "x", "b")
    border = (
        _salted_join(seekers, core, names)
        .filter(_dist2(F.col("x"), F.col("y")) <= eps2)
        .select("id", "b")
        .distinct()
        .join(labels.select(F.col("cell").alias("b"), "label"), "b")
        .groupBy("id")
        .agg(F.min("label").alias("label"))
    )
    rest_rows = rest.join(border, "id", "left").select("id", F.coalesce("label", F.lit(-1)).alias("label"), F.lit(0).alias("core"))
    return core_rows.unionByName(rest_rows)
