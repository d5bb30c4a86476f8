"""Running a stream over what is there now, with retry-safe output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import scratch_path


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 4) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_available(stream: DataFrame, output: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Process all waiting input and return what was written, with the batch number as `batch`.

    Each batch overwrites its own folder, so a batch that is run again leaves one copy.
    """
    spark = stream.sparkSession

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{output}/batch={batch}")

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-state"))
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    return spark.read.option("basePath", output).parquet(output)


def write_slices(df: DataFrame, path: str, order: str, slices: int = 4) -> int:
    """Write a table slice by slice of `order`, oldest first, and return the number of files of each slice.

    Reading that many files per batch then gives one batch per slice. The slices have as many files in all as `df` has
    partitions, four each at least. Rows without a value of `order` are in the first slice.
    """
    files = max(4, -(-df.rdd.getNumPartitions() // slices))
    edges = df.agg(F.percentile_approx(order, [i / slices for i in range(1, slices)], 1000)).first()[0]
    bounds = [None, *(edges or []), None]
    for low, high in zip(bounds, bounds[1:]):
        part = df
        if low is not None:
            part = part.filter(F.col(order) > F.lit(low))
        if high is not None:
            part = part.filter((F.col(order) <= F.lit(high)) | F.col(order).isNull() if low is None else F.col(order) <= F.lit(high))
        part.repartition(files).write.mode("append").parquet(path)
    return files
