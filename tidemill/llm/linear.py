"""Logistic regression on hashed n-grams, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import cut


@dataclass
class Settings:
    """Of the per-coordinate updates: step size, its smoothing, and the penalties."""

    bits: int = 18
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    passes: int = 6
    shards: int = 8  # tasks that train side by side; their states are averaged after each pass


def weights(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    """The closed form of the leader: zero inside the first penalty, shrunk by the second outside it."""
    w = -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)
    return np.where(np.abs(z) <= s.l1, 0.0, w)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def row_vectors(rows: np.ndarray, slots: np.ndarray, count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per row its distinct slots and values: occurrences over the root of all occurrences of the row."""
    out = []
    edge = np.searchsorted(rows, np.arange(count + 1))
    for a, b in zip(edge[:-1], edge[1:]):
        i, k = np.unique(slots[a:b], return_counts=True)
        out.append((i.astype(np.int32), (k / np.sqrt(max(b - a, 1))).astype(np.float32)))
    return out


def row_margins(rows: np.ndarray, slots: np.ndarray, count: int, w: np.ndarray, bias: float) -> np.ndarray:
    """The sparse dot product of every row with the weights, plus the bias."""
    total = np.bincount(rows, weights=w[slots], minlength=count)
    seen = np.bincount(rows, minlength=count)
    return total / np.sqrt(np.maximum(seen, 1)) + bias


Slots = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]


def _vectors(slots: Slots):
    def run(batches):
        for b in batches:
            rows, found = slots(b)
            both = row_vectors(rows, found, b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("label"), pa.array([i for i, _ in both], pa.list_(pa.int32())),
                 pa.array([v for _, v in both], pa.list_(pa.float32()))],
                names=["key", "label", "slots", "vals"],
            )

    return run


def _pass(z0: np.ndarray, n0: np.ndarray, s: Settings):
    """One pass over the examples of a task; the state that it ends with comes back as changed coordinates."""

    def run(batches):
        z, n = z0.copy(), n0.copy()
        size = len(z) - 1  # the last coordinate is the bias
        seen = 0
        for b in batches:
            for label, slots, vals in zip(
                b.column("label").to_pylist(), b.column("slots").to_pylist(), b.column("vals").to_pylist()
            ):
                i = np.append(np.asarray(slots, dtype=np.int64), size)
                x = np.append(np.asarray(vals, dtype=np.float64), 1.0)
                w = weights(z[i], n[i], s)
                g = (sigmoid(w @ x) - label) * x
                sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / s.alpha
                z[i] += g - sigma * w
                n[i] += g * g
                seen += 1
        if seen:
            moved = np.flatnonzero((z != z0) | (n != n0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(moved, pa.int32()), pa.array((z - z0)[moved]), pa.array((n - n0)[moved])],
                names=["slot", "dz", "dn"],
            )

    return run


def train(examples: DataFrame, slots: Slots, s: Settings) -> tuple[np.ndarray, float]:
    """`(weights, bias)` learnt from `examples (key, label, ...)`, which must be a bounded sample.

    `slots` gives the row numbers (ascending) and slots of a batch of examples. The examples are dealt to a fixed number of tasks by
    `key` and read in its order, so a rerun gives the same weights. After each pass the tasks' changes are averaged;
    what reaches the driver is at most one row per slot. Without examples all weights and the bias are 0.
    """
    extra = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in examples.schema if f.name in ("key", "label"))
    rows = examples.mapInArrow(_vectors(slots), f"{extra}, slots array<int>, vals array<float>")
    kept = cut(rows.repartition(s.shards, F.xxhash64("key")))
    dealt = kept.repartition(s.shards, F.xxhash64("key")).sortWithinPartitions(F.xxhash64("key", F.lit(1)), "key", "label")
    z, n = np.zeros((1 << s.bits) + 1), np.zeros((1 << s.bits) + 1)
    for _ in range(s.passes):
        moved = dealt.mapInArrow(_pass(z, n, s), "slot int, dz double, dn double")
        # whole millionths add up alike in any order
        total = moved.groupBy("slot").agg(
            F.sum(F.round(F.col("dz") * 1e6).cast("long")).alias("dz"),
            F.sum(F.round(F.col("dn") * 1e6).cast("long")).alias("dn"),
        ).toPandas()
        if total.empty:
            break
        at = total["slot"].to_numpy()
        z[at] += total["dz"].to_numpy() / (1e6 * s.shards)
        n[at] += total["dn"].to_numpy() / (1e6 * s.shards)
    w = weights(z, n, s)
    return w[:-1].astype(np.float32), float(w[-1])
