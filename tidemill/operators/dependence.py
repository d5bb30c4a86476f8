"""Mutual information by nearest neighbours, on boxes of points."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.ordering import global_index, ranked_values
from tidemill.session import cut

BOX = 512  # different points of a box, and points compared with a box at once


def digamma(n: Column) -> Column:
    """The digamma function of positive numbers: six steps up, then its series."""
    m = n + F.lit(6.0)
    steps = sum((F.lit(1.0) / (n + F.lit(float(i))) for i in range(6)), F.lit(0.0))
    q = F.lit(1.0) / (m * m)
    series = q * (F.lit(1 / 12) - q * (F.lit(1 / 120) - q * (F.lit(1 / 252) - q * F.lit(1 / 240))))
    return F.ln(m) - F.lit(0.5) / m - series - steps


def _nearest(qx, qy, px, py, pn, k: int, own: bool) -> np.ndarray:
    """The `k` smallest distances (the larger of both differences) from each query to the points, which count `pn` times.

    With `own`, the queries are among the points, and one copy of each is no neighbour of itself.
    """
    out = np.full((len(qx), k), np.inf)
    m = min(k + 1, len(px))
    for a in range(0, len(qx), BOX):
        d = np.maximum(np.abs(qx[a : a + BOX, None] - px), np.abs(qy[a : a + BOX, None] - py))
        near = np.argpartition(d, m - 1, axis=1)[:, :m]
        near = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1), 1)
        d, copies = np.take_along_axis(d, near, 1), pn[near]
        if own:  # points differ, so the only one at distance 0 is the query
            copies[:, 0] -= 1
        upto = np.cumsum(copies, axis=1)
        for t in range(k):
            at = (upto <= t).sum(axis=1)
            found = np.flatnonzero(at < m)
            out[a + found, t] = d[found, at[found]]
    return out


def _in_order(v: np.ndarray) -> np.ndarray:
    """Numbers as integers in the same order without gaps, and such integers as numbers again."""
    bits = v.view(np.int64)
    return np.where(bits < 0, np.int64(-(2**63)) - bits, bits)


def _reach(v: np.ndarray, d: np.ndarray, sign: int) -> np.ndarray:
    """The last number on one side of `v` whose computed difference from it is below `d` (`v` itself if `d` is 0), by bisection."""
    v = v + 0.0
    near, far = _in_order(v), _in_order(np.nextafter(v + sign * 2 * d, sign * np.inf))
    for _ in range(64):
        middle = (near >> 1) + (far >> 1) + (near & far & 1)
        inside = np.abs(_in_order(middle).view(np.float64) - v) < d
        near, far = np.where(inside, middle, near), np.where(inside, far, middle)
    return np.where(d > 0, _in_order(near).view(np.float64), v) + 0.0


def _boxes(points: DataFrame) -> DataFrame:
    """Points with `strip` and `box`: strips of equal size by (x, y), each cut into boxes of BOX points by y.

    Both are positions in a global order, so a frequent value of x or y fills several strips or boxes.
    """
    indexed = global_index(points, "feature", "x", "y", name="at")
    sizes = cut(indexed.groupBy("feature").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("m")))
    width = F.ceil(F.sqrt(F.col("m") * F.lit(float(BOX)))).cast("long")
    # one row per feature
    strips = indexed.join(F.broadcast(sizes.select("feature", "first", width.alias("width"))), "feature")
    strips = strips.withColumn("strip", F.floor((F.col("at") - F.col("first")) / F.col("width"))).drop("at")
    ordered = global_index(strips, "feature", "strip", "y", "x", name="at")
    inside = F.col("at") - F.col("first") - F.col("strip") * F.col("width")
    return ordered.withColumn("box", F.floor(inside / BOX)).select("feature", "at", "x", "y", "n", "strip", "box")


def _crossed(low: str, high: str, start: Column, end: Column) -> Column:
    """Numbers of the parts that meet [start, end]; `low` and `high` are arrays of the parts' ends, both rising."""
    first = F.size(F.filter(low, lambda e: e < start))
    last = F.size(F.filter(high, lambda e: e <= end)) - 1
    return F.when(first <= last, F.sequence(first.cast("long"), last.cast("long")))


def _neighbour_distance(points: DataFrame, k: int) -> DataFrame:
    """`(feature, at, x, y, n, d)`: the distance of the `k`-th neighbour of each point.

    Each box answers its own points first. That bounds the distance, and only the other boxes that a square of this size meets
    are asked again; most squares stay inside their box.
    """
    placed = cut(_boxes(points))
    schema = "feature string, at long, near array<double>"

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y, n = (pdf[c].to_numpy() for c in ("x", "y", "n"))
        near = _nearest(x, y, x, y, n, k, True)
        return pd.DataFrame({"feature": pdf["feature"], "at": pdf["at"], "near": list(near)})

    def across(mine: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if mine.empty or asked.empty:
            return pd.DataFrame({"feature": [], "at": [], "near": []}, dtype=object)
        near = _nearest(asked["x"].to_numpy(), asked["y"].to_numpy(), *(mine[c].to_numpy() for c in ("x", "y", "n")), k, False)
        return pd.DataFrame({"feature": asked["feature"], "at": asked["at"], "near": list(near)})

    key = ["feature", "strip", "box"]
    first = cut(placed.groupBy(*key).applyInPandas(inside, schema))
    boxes = cut(placed.groupBy(*key).agg(*[f(c).alias(f"{c}{e}") for c in ("x", "y") for f, e in ((F.min, 0), (F.max, 1))]))
    # both lists have about the square root of as many entries as there are boxes
    by_box = F.array_sort(F.collect_list(F.struct("box", "y0", "y1")))
    columns = boxes.groupBy("feature", "strip").agg(by_box.alias("l"), F.min("x0").alias("x0"), F.max("x1").alias("x1"))
    columns = cut(columns.select("feature", "strip", "x0", "x1", F.col("l.y0").alias("y0"), F.col("l.y1").alias("y1")))
    by_strip = F.array_sort(F.collect_list(F.struct("strip", "x0", "x1")))
    rows = columns.groupBy("feature").agg(by_strip.alias("l"))
    rows = cut(rows.select("feature", F.col("l.x0").alias("sx0"), F.col("l.x1").alias("sx1")))

    bound = F.col("near")[k - 1]
    own = boxes.select(*key, *[F.col(c).alias(f"b{c}") for c in ("x0", "x1", "y0", "y1")])
    known = placed.join(first, ["feature", "at"]).withColumn("r", bound).join(own, key)
    leaves = (
        (F.col("x") - F.col("r") <= F.col("bx0")) | (F.col("x") + F.col("r") >= F.col("bx1"))
        | (F.col("y") - F.col("r") <= F.col("by0")) | (F.col("y") + F.col("r") >= F.col("by1"))
    )
    asking = known.filter(leaves).select("feature", "at", "x", "y", "r", F.col("strip").alias("s0"), F.col("box").alias("b0"))
    met = asking.join(rows, "feature").withColumn(
        "strip", F.explode(_crossed("sx1", "sx0", F.col("x") - F.col("r"), F.col("x") + F.col("r")))
    ).drop("sx0", "sx1")
    met = met.join(columns.select("feature", "strip", "y0", "y1"), ["feature", "strip"]).withColumn(
        "box", F.explode(_crossed("y1", "y0", F.col("y") - F.col("r"), F.col("y") + F.col("r")))
    )
    met = met.filter((F.col("strip") != F.col("s0")) | (F.col("box") != F.col("b0"))).select(*key, "at", "x", "y")
    met = cut(met)  # both sides of the cogroup come from one table
    more = placed.groupBy(*key).cogroup(met.groupBy(*key)).applyInPandas(across, schema)
    whole = F.array_sort(F.flatten(F.collect_list("near")))[k - 1]
    found = first.unionByName(more).groupBy("feature", "at").agg(whole.alias("d"))
    return placed.drop("strip", "box").join(found, ["feature", "at"])


def neighbour_information(df: DataFrame, columns: Sequence[str], target: str, k: int = 3, top: int = 20) -> DataFrame:
    """Features ranked by mutual information with the target, estimated from the distances of `k`-th neighbours.

    psi(rows) + psi(k) less the mean of psi(points nearer in x) + psi(points nearer in y), both with the point itself, and 0 at
    least. Columns are scaled by the power of two next to their deviation, which changes no digit, so ties stay ties; a point with `k`
    copies has distance 0 and counts its equals. Rows with a null or a number that is not finite in any of the columns are left out.
    With `k` rows or fewer the information is null; an empty table has no rows.
    """
    names = [*columns, target]
    values = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(names)]).na.drop()
    for i in range(len(names)):
        values = values.filter(F.abs(f"v{i}") < F.lit(float("inf")))
    values = cut(values)
    spread = values.agg(*[F.stddev_pop(f"v{i}").alias(f"v{i}") for i in range(len(names))]).first()
    scale = [2.0 ** -round(np.log2(s)) if s else 1.0 for s in spread]
    scaled = [F.col(f"v{i}") * F.lit(s) + F.lit(0.0) for i, s in enumerate(scale)]
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), scaled[i].alias("x"), scaled[-1].alias("y")) for i, c in enumerate(columns)])
    points = values.select(F.inline(pairs)).groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("n"))

    @F.pandas_udf("struct<x0: double, x1: double, y0: double, y1: double>")
    def reach(x: pd.Series, y: pd.Series, d: pd.Series) -> pd.DataFrame:
        x, y, d = x.to_numpy(), y.to_numpy(), d.to_numpy()
        return pd.DataFrame({"x0": _reach(x, d, -1), "x1": _reach(x, d, 1), "y0": _reach(y, d, -1), "y1": _reach(y, d, 1)})

    near = _neighbour_distance(cut(points), k)
    near = cut(near.withColumn("to", reach("x", "y", "d")).select("feature", "at", "x", "y", "n", "d", "to.*"))
    none = F.lit(0).cast("long")
    ends = [("x", "x", F.col("n")), ("y", "y", F.col("n"))] + [(a, f"{a}{e}", none) for a in ("x", "y") for e in (0, 1)]
    marks = F.array(*[F.struct(F.lit(a).alias("axis"), F.col(c).alias("v"), w.alias("w")) for a, c, w in ends])
    ranks = cut(ranked_values(near.select("feature", F.inline(marks)), "v", ["feature", "axis"], "w"))
    for axis in ("x", "y"):
        for end, rank in ((0, F.col("before")), (1, F.col("before") + F.col("n"))):
            of = ranks.filter(F.col("axis") == axis).select("feature", F.col("v").alias(f"{axis}{end}"), rank.alias(f"{axis}r{end}"))
            near = near.join(of, ["feature", f"{axis}{end}"])
    counted = digamma(F.col("xr1") - F.col("xr0")) + digamma(F.col("yr1") - F.col("yr0"))
    sums = near.groupBy("feature").agg(F.sum("n").alias("rows"), F.sum(F.col("n") * counted).alias("s"))
    rows = F.col("rows").cast("double")
    mi = F.greatest(digamma(rows) + digamma(F.lit(float(k))) - F.col("s") / rows, F.lit(0.0))
    found = sums.select("feature", F.when(F.col("rows") > k, mi).alias("mi"))
    return found.orderBy(F.desc_nulls_last("mi"), "feature").limit(top)
