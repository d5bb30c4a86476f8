"""Exact top-k search by inner product: dimension blocks in vertical layout, bounds on what is left."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import cut

BLOCK_BYTES = 8 << 20  # components of one candidate block, eight bytes each
QUERY_SHARE = 16  # a query block holds that part of a candidate block
DIMENSIONS = 8  # components that are accumulated before the next bound


def whole_components(vector: Column, scale: int = 256) -> Column:
    """`floor(scale * x)` of every component as a long; null for a vector that is null or has a null or non-finite one."""
    v = vector.cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(fine, F.transform(v, lambda x: F.floor(x * scale).cast("long")))


def _columns(vectors: pd.Series, width: int) -> np.ndarray:
    """Vertical layout: one row of memory per dimension. A vector that is shorter than others ends in zeros."""
    out = np.zeros((width, len(vectors)), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[: len(v), i] = v
    return out


def _remaining(columns: np.ndarray) -> np.ndarray:
    """Per dimension block and vector, the length of what lies in this and later blocks."""
    width = columns.shape[0]
    squares = columns.astype(np.float64) ** 2
    return np.array([np.sqrt(squares[a:].sum(axis=0)) for a in range(0, width, DIMENSIONS)])


def best_of_block(query_ids, queries, ids, rows, k: int, names=None):
    """(name, vec_id, score) of the `k` best candidates of one block for each query, ties to the smaller id; a query goes by its id
    unless `names` has another name for it.

    Scores grow by one block of dimensions at a time. A candidate whose score so far plus the most that its other
    dimensions can add stays below the k-th best known score is given up, and the survivors are packed together.
    """
    width = max((len(v) for v in (*queries, *rows)), default=0)
    c, q = _columns(rows, width), _columns(queries, width)
    ids = np.asarray(ids)
    # long vectors first: the first rows then give a strong threshold
    order = np.argsort(-np.sum(c.astype(np.float64) ** 2, axis=0), kind="stable")
    c, ids = np.ascontiguousarray(c[:, order]), ids[order]
    left_c, left_q = _remaining(c), _remaining(q)
    out = []
    probe = max(4 * k, 64)
    for j, (own, name) in enumerate(zip(query_ids, query_ids if names is None else names)):
        x = q[:, j]
        # exact scores of some rows; the k-th best of them is a threshold no answer may fall below
        first = x @ c[:, :probe]
        first = first[ids[:probe] != own]
        floor = np.partition(first, len(first) - k)[len(first) - k] if len(first) >= k else None
        alive = np.flatnonzero(ids != own)
        score = np.zeros(len(alive), dtype=np.int64)
        for n, a in enumerate(range(0, width, DIMENSIONS)):
            score = score + x[a : a + DIMENSIONS] @ c[a : a + DIMENSIONS, alive]
            if floor is not None and a + DIMENSIONS < width:
                most = score + left_q[n + 1, j] * left_c[n + 1, alive]
                keep = most + np.abs(most) * 1e-12 + 1e-6 >= floor  # wider on either side of zero
                alive, score = alive[keep], score[keep]
        top = np.lexsort((ids[alive], -score))[:k]
        out.append((np.full(len(top), name), ids[alive[top]], score[top]))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3


def exact_top_k(candidates: DataFrame, queries: DataFrame, k: int, scale: int = 256) -> DataFrame:
    """`(query_id, rank, vec_id, score)`: the `k` largest integer inner products of each query row with all candidates.

    Both inputs have `(vec_id, embedding)`. A query never meets the row of its own id; ties go to the smaller id;
    fewer than `k` candidates give fewer rows. Vectors that are null, empty or hold null or non-finite components take
    no part, nor do rows without an id. A shorter vector counts as ending in zeros. Scores must fit a long. Query rows
    that share an id are answered each: equal ones alike, different ones under the same `query_id`, with ranks of their own.

    Candidates and queries are dealt into blocks of bounded bytes by a hash of id and vector, and each pair of blocks is one task
    that returns at most `k` rows per query; no row count is ever held in one place.
    """
    def cleaned(df: DataFrame) -> DataFrame:
        v = df.select(F.col("vec_id").cast("long"), whole_components(F.col("embedding"), scale).alias("v"))
        return v.filter("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")

    rows, asked = cleaned(candidates), cleaned(queries)
    # equal query rows are searched once; each of them then gets the answers
    asked = cut(asked.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("times")).withColumn("query_no", F.monotonically_increasing_id()))
    size = lambda df: df.agg(F.sum(F.size("v")).alias("n")).first()["n"] or 0
    row_blocks = max(1, -(-8 * size(rows) // BLOCK_BYTES))
    query_blocks = max(1, -(-8 * size(asked) // max(8, BLOCK_BYTES // QUERY_SHARE)))

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        # repeated rows of one id spread by their number, as a block must not grow with them
        spread = F.xxhash64("vec_id", F.monotonically_increasing_id() if own == "cb" else F.col("query_no"))
        placed = df.withColumn(own, F.pmod(spread, F.lit(blocks)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    c = dealt(rows, "cb", row_blocks, "qb", query_blocks)
    q = dealt(asked, "qb", query_blocks, "cb", row_blocks)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = best_of_block(
            right["vec_id"].to_numpy(), right["v"], left["vec_id"].to_numpy(), left["v"], k, right["query_no"].to_numpy()
        )
        return pd.DataFrame(dict(zip(("query_no", "vec_id", "score"), found)))

    parts = row_blocks * query_blocks
    near = (
        c.repartition(parts, "cb", "qb").groupBy("cb", "qb").cogroup(q.repartition(parts, "cb", "qb").groupBy("cb", "qb"))
        .applyInPandas(run, "query_no long, vec_id long, score long")
    )
    # at most k rows per query and block meet here
    best = near.groupBy("query_no").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("top")
    )
    named = best.join(asked.select("query_no", F.col("vec_id").alias("query_id"), "times"), "query_no")
    # as many answers as there are equal query rows
    each = named.select("query_id", "top", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    ranked = each.select("query_id", F.posexplode("top").alias("p", "t"))
    return ranked.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "t.vec_id", (-F.col("t.s")).alias("score"))
