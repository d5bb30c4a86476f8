"""Approximate dense search: inverted cells of a coarse quantiser, product codes of the residuals, exact re-ranking."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.arrays import dot, normalised
from tidemill.session import cut

SAMPLE = 20_000  # vectors that the quantisers learn from, those with the smallest hashed identifiers; all vectors are indexed
ROUNDS = 12
CELL_ROWS = 20_000  # codes of a cell that one task scans; larger cells are dealt to several


@dataclass
class VectorIndex:
    """`codes (id, cell, code)` and `units (id, v)`, both written tables, with what the quantisers learnt."""

    centres: np.ndarray  # cells x dimensions
    books: list[np.ndarray]  # per part of the dimensions, codes x dimensions of the part
    bounds: list[tuple[int, int]]
    codes: DataFrame
    units: DataFrame


def lloyd(x: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """At most `k` centres of the rows of `x` after some rounds of assignment; the first ones are drawn far from each other."""
    draw = np.random.default_rng(seed)
    centres = x[[draw.integers(len(x))]]
    away = ((x - centres[0]) ** 2).sum(axis=1)
    while len(centres) < min(k, len(x)) and away.sum() > 0:
        centres = np.vstack([centres, x[draw.choice(len(x), p=away / away.sum())]])
        away = np.minimum(away, ((x - centres[-1]) ** 2).sum(axis=1))
    for _ in range(ROUNDS):
        own = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        count = np.bincount(own, minlength=len(centres))
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2.0 * (x @ centres.T), axis=1)


def _rows(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _train(cells: int, parts: int, codes: int):
    """The centres and codebooks of a sample, which is bounded and learnt from in one task."""

    def run(batches):
        held = [_rows(b.column("v")) for b in batches if b.num_rows]
        if not held:
            return
        x = np.vstack(held)
        centres = lloyd(x, cells)
        rest = x - centres[nearest(x, centres)]
        edges = np.linspace(0, x.shape[1], min(parts, x.shape[1]) + 1).astype(int).tolist()
        books = [lloyd(rest[:, a:b], codes, seed=2 + a) for a, b in zip(edges, edges[1:])]
        for part, (table, a, b) in enumerate([(centres, 0, x.shape[1]), *zip(books, edges, edges[1:])]):
            for row in table:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([a], pa.int32()), pa.array([b], pa.int32()), pa.array([row.tolist()])],
                    names=["part", "a", "b", "row"],
                )

    return run


def build_index(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cells: int | None = None, parts: int = 16, codes: int = 64,
    sample: int = SAMPLE,
) -> VectorIndex:
    """Index every row of `vectors` that has a vector; all must have one length.

    `cells` defaults to the root of the number of rows, 4,096 at most. A code has one byte for each of `parts` parts of the residual. What
    the quantisers learn is bounded by cells, codes and dimensions, and goes to every task.
    """
    units = cut(vectors.select(F.col(key).alias("id"), normalised(vector).alias("v")).filter("id IS NOT NULL AND v IS NOT NULL"))
    n = units.count()
    cells = cells or max(1, min(4096, int(n**0.5)))
    few = units.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").coalesce(1)
    learnt = few.mapInArrow(_train(cells, parts, codes), "part int, a int, b int, row array<double>").collect()
    by_part: dict[int, list] = {}
    for r in learnt:
        by_part.setdefault(r["part"], []).append(r)
    tables = {p: np.array([r["row"] for r in rows]) for p, rows in by_part.items()}
    centres = tables.pop(0, np.zeros((0, 0)))
    bounds = [(by_part[p][0]["a"], by_part[p][0]["b"]) for p in sorted(tables)]
    books = [tables[p] for p in sorted(tables)]

    def encode(batches):
        for b in batches:
            x = _rows(b.column("v"))
            own = nearest(x, centres) if b.num_rows else np.zeros(0, np.int64)
            rest = x - centres[own] if b.num_rows else x
            code = np.stack([nearest(rest[:, s:e], book) for (s, e), book in zip(bounds, books)], axis=1).astype(np.uint8) if b.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(own, pa.int32()), pa.array([c.tobytes() for c in code], pa.binary())], names=["id", "cell", "code"]
            )

    kind = dict(units.dtypes)["id"]
    return VectorIndex(centres, books, bounds, cut(units.mapInArrow(encode, f"id {kind}, cell int, code binary")), units)


def search_index(
    index: VectorIndex, queries: DataFrame, k: int = 4, probe: int = 24, refine: int = 10, question: str = "question_id",
    key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """`(question, key, score, rank)`: the `k` best rows of the `probe` nearest cells of each query, by inner product of unit vectors.

    Within a cell rows are scored by their codes; the best `refine * k` of a query are scored again on their vectors, so scores are
    exact and only a neighbour in another cell, or one whose code misleads, can be missed. More cells and refinement miss
    less. Cells of more than `CELL_ROWS` rows are scanned by several tasks.
    """
    asked = cut(queries.select(F.col(question).alias("question"), normalised(vector).alias("q")).filter("q IS NOT NULL"))
    kind, id_kind = dict(asked.dtypes)["question"], dict(index.codes.dtypes)["id"]
    centres, books, bounds, wide = index.centres, index.books, index.bounds, refine * k
    schema = f"question {kind}, id {id_kind}, score double"
    if not len(centres):
        return queries.sparkSession.createDataFrame([], schema).selectExpr(f"question AS `{question}`", f"id AS `{key}`", "score", "0 AS rank")

    def visits(batches):
        for b in batches:
            q = _rows(b.column("q"))
            near = np.argsort(-(q @ centres.T), axis=1, kind="stable")[:, :probe] if b.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [b.column("question"), b.column("q"), pa.array([r.tolist() for r in near], pa.list_(pa.int32()))], names=["question", "q", "cells"]
            )

    routed = asked.mapInArrow(visits, f"question {kind}, q array<double>, cells array<int>").select("question", "q", F.explode("cells").alias("cell"))
    # a row per cell, at most as many as there are centres
    sizes = index.codes.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("slices"))
    sizes = F.broadcast(cut(sizes))
    dealt = index.codes.join(sizes, "cell").withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int")).drop("slices")
    sent = routed.join(sizes, "cell").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")

    def scan(rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(block):
            return pd.DataFrame({"question": block["question"][:0], "id": rows["id"][:0], "score": np.zeros(0)})
        code = np.frombuffer(b"".join(rows["code"]), dtype=np.uint8).reshape(len(rows), len(books))
        ids, out = rows["id"].to_numpy(), []
        for name, q in zip(block["question"], block["q"]):
            score = np.full(len(ids), float(q @ centres[rows["cell"].iloc[0]]))
            for p, ((s, e), book) in enumerate(zip(bounds, books)):
                score += (book @ q[s:e])[code[:, p]]
            top = np.argsort(-score, kind="stable")[:wide]
            out.append(pd.DataFrame({"question": name, "id": ids[top], "score": score[top]}))
        return pd.concat(out)

    near = dealt.groupBy("cell", "slice").cogroup(sent.groupBy("cell", "slice")).applyInPandas(scan, schema)
    best = Window.partitionBy("question").orderBy(F.desc("score"), "id")
    first = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= wide).select("question", "id")
    exact = first.join(index.units, "id").join(asked, "question").select("question", "id", dot("q", "v").alias("score")).distinct()
    ranked = exact.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select(F.col("question").alias(question), F.col("id").alias(key), "score", "rank")
