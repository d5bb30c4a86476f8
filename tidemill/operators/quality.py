"""Missing data, duplicates, fences, profiles and integrity checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.ordering import quantile_row, quantiles
from tidemill.session import cut


def _stack(row: DataFrame, names: Sequence[str], value: str) -> DataFrame:
    """Turn a one-row frame with one column per name into `(column, value)` rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias(value)) for c in names])
    return row.select(F.inline(pairs))


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, in one pass."""
    row = df.agg(*[F.sum(F.col(f"`{c}`").isNull().cast("bigint")).alias(c) for c in df.columns])
    return _stack(row, df.columns, "nulls")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(F.sum(F.col("copies") - 1).alias("duplicates"))


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by the exact median of the column; all medians come from the same passes."""
    medians = cut(quantiles(df, columns, [0.5]))
    fills = {
        c: F.coalesce(F.col(c), medians.filter(F.col("column") == c).agg(F.max("value")).scalar()) for c in columns
    }
    return df.withColumns(fills)


def fill_mean_rounded(df: DataFrame, column: str) -> DataFrame:
    """Replace nulls by the mean rounded half to even."""
    mean = df.agg(F.bround(F.avg(column), 0).alias("m")).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean.cast(df.schema[column].dataType)))


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(columns) if columns else None)


def outlier_fence(
    df: DataFrame, column: str, low: float = 0.01, high: float = 0.99, reach: float = 1.5
) -> DataFrame:
    """Keep rows within `reach` spreads of the two given percentiles."""
    bounds = quantile_row(df, column, [low, high], ["lo", "hi"]).agg(
        F.struct(F.max("lo").alias("lo"), F.max("hi").alias("hi")).alias("b")
    )
    b = bounds.scalar()
    spread = b["hi"] - b["lo"]
    return df.filter(
        F.col(column).between(b["lo"] - F.lit(reach) * spread, b["hi"] + F.lit(reach) * spread)
    )


def cardinality(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values and rows per column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    row = df.agg(*[count(F.col(c)).alias(c) for c in columns], F.count(F.lit(1)).alias("__rows"))
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct_values"), F.col("__rows").alias("rows"))
            for c in columns
        ]
    )
    return row.select(F.inline(pairs))


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """How many values of a column stand on more than one row."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .agg(F.count(F.lit(1)).alias("repeated"))
    )


def value_catalogue(df: DataFrame, columns: Sequence[str], samples: int = 10) -> DataFrame:
    """Column name, type and the first `samples` distinct values in sorted order."""
    types = dict(df.dtypes)
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col(c).cast("string").alias("value")
            )
            for c in columns
        ]
    )
    seen = df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()
    order = Window.partitionBy("column", "type").orderBy("value")
    kept = seen.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= samples)
    return kept.groupBy("column", "type").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "value"))), lambda s: s["value"]).alias("samples")
    )


def enum_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All distinct values per column, as rows."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()


def not_null_violations(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per missing mandatory cell."""
    missing = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]), lambda x: x.isNotNull()
    )
    return df.select(
        F.lit("not_null").alias("rule"), F.explode(missing).alias("column"), F.col(key).cast("string").alias("value")
    )


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """One row per value that occurs more than once."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .select(F.lit("unique").alias("rule"), F.lit(column).alias("column"), F.col(column).cast("string").alias("value"))
    )


def foreign_key_violations(fact: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """One row per fact key value that the dimension lacks."""
    present = dim.select(F.col(key).alias("__key"))
    return (
        fact.select(column)
        .filter(F.col(column).isNotNull())
        .distinct()
        .join(present, F.col(column) == F.col("__key"), "left_anti")
        .select(
            F.lit("foreign_key").alias("rule"), F.lit(column).alias("column"), F.col(column).cast("string").alias("value")
        )
    )

