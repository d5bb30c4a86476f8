"""Global order without a single-task window.

Everything here sorts by range partitions, writes the sorted copy once, and turns
per-partition totals (at most one row per partition) into offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import cut

_PID, _POS = "__pid", "__pos"


def _range_sorted(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Range-partition and sort by `keys`; add the partition number and the position inside it."""
    stamped = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("__mid", F.monotonically_increasing_id())
    )
    stamped = stamped.withColumn(_PID, F.shiftright("__mid", 33)).withColumn(
        _POS, F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    )
    return cut(stamped.drop("__mid"))


def _as_columns(keys) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def global_index(df: DataFrame, *keys, name: str = "idx", start: int = 0, total: str | None = None) -> DataFrame:
    """Dense row number over the whole table in the order of `keys` (which must be unique).

    `total` names an optional column with the row count.
    """
    if not keys:
        raise ValueError("global_index needs at least one order key")
    rows = _range_sorted(df, _as_columns(keys))
    sizes = rows.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    # one row per range partition, so this window is bounded by the partition count
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    whole = [F.sum("__n").over(Window.partitionBy()).alias(total)] if total else []
    offsets = sizes.select(_PID, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"), *whole)
    return (
        rows.join(F.broadcast(offsets), _PID)
        .withColumn(name, F.col("__off") + F.col(_POS) + F.lit(start))
        .drop(_PID, _POS, "__off")
    )


def ranked_values(df: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Distinct values with their count `n` and the number of rows `before` them, per group. A row counts `weight` times.

    Equal values are counted before the shuffle, a group may span many partitions, and no
    task holds a whole group.
    """
    by = list(by)
    counts = df.groupBy(*by, value).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n"))
    rows = _range_sorted(counts, [F.col(c) for c in (*by, value)])
    inside = Window.partitionBy(_PID, *by).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(_PID, *by).agg(F.sum("n").alias("__n"))
    # per group at most one row per range partition
    before = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_PID, *by, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    placed = rows.withColumn("__in", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    joined = null_safe_join(placed, offsets, [_PID, *by])
    return joined.select(*by, value, "n", (F.col("__off") + F.col("__in")).alias("before"))


def unpivot_numeric(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form `(by…, column, value)` of numeric columns, nulls left out."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return (
        df.select(*by, F.explode(pairs).alias("__p"))
        .select(*by, F.col("__p.column").alias("column"), F.col("__p.value").alias("value"))
        .filter(F.col("value").isNotNull())
    )


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in keys})
    on = None
    for c in keys:
        same = F.col(c).eqNullSafe(F.col(f"__r_{c}"))
        on = same if on is None else on & same
    return left.join(renamed, on, how).drop(*[f"__r_{c}" for c in keys])


# Ranks that a sketch quantile may be off by, as a share of the rows, with a wide margin.
SKETCH_ACCURACY = 10_000
SLACK = 0.002
SMALL_GROUP = 5_000


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles with linear interpolation: rows `(by…, column, p, value, n)`.

    Agrees with `percentile`, which keeps every distinct value of a group in one task. Here a
    sketch first brackets each quantile. The second pass counts what lies below the bracket and
    sorts only the values inside it, a small share of the rows.
    """
    keys = [*by, "column"]
    long = unpivot_numeric(df, columns, by)
    ps = [float(p) for p in probs]
    marks = [max(p - SLACK, 0.0) for p in ps] + [min(p + SLACK, 1.0) for p in ps]
    sketch = cut(
        long.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("__total"), F.min("value").alias("__min"), F.max("value").alias("__max"),
            F.percentile_approx("value", marks, SKETCH_ACCURACY).alias("__q"),
        )
    )
    few = F.col("__total") < SMALL_GROUP
    brackets = F.array(
        *[
            F.struct(
                F.lit(p).alias("p"),
                F.when(few, F.col("__min")).otherwise(F.col("__q")[i]).alias("__from"),
                F.when(few, F.col("__max")).otherwise(F.col("__q")[len(ps) + i]).alias("__to"),
            )
            for i, p in enumerate(ps)
        ]
    )
    at = F.col("p") * (F.col("__total") - 1)
    targets = sketch.select(*keys, "__total", F.inline(brackets)).withColumns(
        {"__at": at, "__lo": F.floor(at), "__hi": F.ceil(at)}
    )
    if not by:
        # columns x probs rows, fixed by the call and not by the data
        targets = F.broadcast(targets)
    near = null_safe_join(long, targets.select(*keys, "p", "__from", "__to"), keys).filter(F.col("value") <= F.col("__to"))
    # everything below the bracket is one null value, which sorts first
    marked = near.select(*keys, "p", F.when(F.col("value") >= F.col("__from"), F.col("value")).alias("value"))
    ranked = ranked_values(marked, "value", [*keys, "p"])

    def covers(rank: str) -> Column:
        return (F.col("before") <= F.col(rank)) & (F.col(rank) < F.col("before") + F.col("n"))

    hits = null_safe_join(ranked, targets.select(*keys, "p", "__total", "__at", "__lo", "__hi"), [*keys, "p"])
    picked = hits.filter(covers("__lo") | covers("__hi")).groupBy(*keys, "p", "__at", "__total").agg(
        F.max(F.when(covers("__lo"), F.col("value"))).alias("__vlo"),
        F.max(F.when(covers("__hi"), F.col("value"))).alias("__vhi"),
    )
    share = F.col("__at") - F.floor("__at")
    return picked.select(
        *keys,
        "p",
        (F.col("__vlo") + (F.col("__vhi") - F.col("__vlo")) * share).alias("value"),
        F.col("__total").alias("n"),
    )


def quantile_row(df: DataFrame, column: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """One row with one named quantile per column, for use as a scalar subquery."""
    q = quantiles(df, [column], probs)
    return q.agg(
        *[F.max(F.when(F.col("p") == F.lit(float(p)), F.col("value"))).alias(nm) for p, nm in zip(probs, names)]
    )


def quantile_values(df: DataFrame, column: str, probs: Sequence[float]) -> list[float]:
    """The quantiles of one column on the driver: as many numbers as `probs`."""
    rows = quantiles(df, [column], probs).select("p", "value").collect()
    found = {r["p"]: r["value"] for r in rows}
    return [found.get(float(p)) for p in probs]


def chronological_split(df: DataFrame, *keys, train_share: float = 0.8, name: str = "role") -> DataFrame:
    """Label the first `int(share * n)` rows in key order `train`, the rest `test`."""
    indexed = global_index(df, *keys, name="row_index", total="__rows")
    limit = F.floor(F.col("__rows") * F.lit(train_share))
    role = F.when(F.col("row_index") < limit, "train").otherwise("test")
    return indexed.withColumn(name, role).drop("__rows")


def contiguous_folds(df: DataFrame, *keys, folds: int = 5) -> DataFrame:
    """Unshuffled folds: the first `n % folds` folds hold one row more."""
    indexed = global_index(df, *keys, name="row_index", total="__rows")
    total = F.col("__rows")
    small = F.floor(total / F.lit(folds))
    extra = total % F.lit(folds)
    head = extra * (small + 1)
    fold = F.when(F.col("row_index") < head, F.floor(F.col("row_index") / (small + 1))).otherwise(
        extra + F.floor((F.col("row_index") - head) / F.greatest(small, F.lit(1)))
    )
    return indexed.withColumn("fold", fold.cast("int")).drop("__rows")


def expanding_folds(df: DataFrame, *keys, folds: int = 5) -> DataFrame:
    """Time folds: test blocks of `n // (folds+1)` rows at the end, all earlier rows as training.

    Emits one row per (row, fold) in which the row takes part.
    """
    indexed = global_index(df, *keys, name="row_index", total="__rows")
    total = F.col("__rows")
    block = F.floor(total / F.lit(folds + 1))
    tagged = indexed.withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(folds)])))
    first_test = total - (F.lit(folds) - F.col("fold")) * block
    role = F.when(F.col("row_index") < first_test, "train").when(
        F.col("row_index") < first_test + block, "test"
    )
    return tagged.withColumn("role", role).filter(F.col("role").isNotNull()).drop("__rows")


FIRST_ROWS = 10_000  # slices that end before this row do without numbering the table


def slice_rows(df: DataFrame, *keys, start: int, stop: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows `start:stop` (half open) in key order, and optionally some columns.

    A slice near the start keeps the first `stop` rows of every partition and numbers those of them that are left.
    """
    if stop <= FIRST_ROWS:
        number = F.row_number().over(Window.orderBy(*_as_columns(keys))) - 1
        first = df.orderBy(*_as_columns(keys)).limit(stop).withColumn("row_index", number)
        return first.filter(F.col("row_index") >= start).select(*(columns or df.columns))
    picked = global_index(df, *keys, name="row_index").filter(F.col("row_index").between(start, stop - 1))
    return picked.select(*(columns or df.columns))


def slice_labels(df: DataFrame, key: str, first, last) -> DataFrame:
    """Rows whose key lies in `[first, last]`, both ends included."""
    return df.filter(F.col(key).between(first, last))


def first_per_group(df: DataFrame, by: Sequence[str], keys: Sequence, n: int) -> DataFrame:
    """The first `n` rows of each group in key order; groups are cut before the shuffle."""
    order = Window.partitionBy(*by).orderBy(*_as_columns(keys))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def top_rows(df: DataFrame, *keys, n: int) -> DataFrame:
    """The first `n` rows in key order (a take-ordered plan, no full sort)."""
    return df.orderBy(*_as_columns(keys)).limit(n)


def capped(df: DataFrame, asked: int | None = None, cap: int = 200) -> DataFrame:
    """The result limit of an answer table: the asked limit if smaller, else the cap."""
    return df.limit(cap if asked is None else min(asked, cap))
