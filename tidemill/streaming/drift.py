"""Weekly drift monitor: windowed bin counts on the stream, stability index downstream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.stats import EPSILON, bin_of, consecutive_alerts, drift_status


def weekly_bins(stream: DataFrame, time: str, column: str, edges: Sequence[float], start: str, late: str = "1 day") -> DataFrame:
    """Counts per week and bin. `start` shifts the weeks to begin on a given weekday."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.groupBy(F.window(time, "7 days", "7 days", start).alias("w"), bin_of(column, edges).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.col("w.start").alias("week_start"), "bin", "n")


def latest_counts(written: DataFrame) -> DataFrame:
    """Newest count of each week and bin from the batches of an update-mode run."""
    return written.groupBy("week_start", "bin").agg(F.max_by("n", "batch").alias("n"))


def drift_from_counts(counts: DataFrame, baseline: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """Stability index, status and retrain flag per week. The rows are weeks times bins."""
    bins = len(edges) + 1
    base = baseline.groupBy(bin_of(column, edges).alias("bin")).agg(F.count(F.lit(1)).alias("n"))

    def shares(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
        wide = df.groupBy(*by).agg(
            F.sum("n").alias("t"), *[F.sum(F.when(F.col("bin") == i, F.col("n"))).alias(f"b{i}") for i in range(bins)]
        )
        cells = [
            F.struct(F.lit(i).alias("bin"), (F.coalesce(f"b{i}", F.lit(0)) / F.col("t") + EPSILON).alias(name))
            for i in range(bins)
        ]
        return wide.select(*by, F.inline(F.array(*cells)))

    joined = shares(counts, ["week_start"], "a").join(F.broadcast(shares(base, [], "e")), "bin")
    term = (F.col("a") - F.col("e")) * F.ln(F.col("a") / F.col("e"))
    psi = joined.groupBy("week_start").agg(F.sum(term).alias("psi")).withColumn("status", drift_status("psi"))
    return consecutive_alerts(psi, "week_start")
