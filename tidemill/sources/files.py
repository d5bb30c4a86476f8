"""Readers and writers: delimited text, JSON records, document folders, saved indexes and models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.scalars import title_case

DOCUMENT_TYPES = ("md", "txt")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> DataFrame:
    """Header row, fixed schema, empty fields as null."""
    return (
        spark.read.schema(schema)
        .options(header=True, mode="PERMISSIVE", nullValue="", multiLine=False, escape='"')
        .options(**options)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(header=True, escape='"').csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON record per row."""
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def read_documents(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """One row per Markdown or plain-text file in `path`, and with `recursive` below it: id, title, source path and text.

    The title is the first `# ` line, else the file stem with every run of letters in title case. Bytes that are not
    valid UTF-8 are dropped.
    """
    raw = (
        spark.read.options(
            recursiveFileLookup=recursive, pathGlobFilter="*.{" + ",".join(DOCUMENT_TYPES) + "}"
        )
        .text(path, wholetext=True)
        .select(
            F.regexp_replace(F.make_valid_utf8("value"), "�", "").alias("text"),
            F.col("_metadata.file_path").alias("source_path"),
            F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "").alias("doc_id"),
        )
    )
    heading = F.trim(F.regexp_extract("text", r"(?m)^#[ \t]+(.+)$", 1))
    return raw.select(
        "doc_id",
        F.when(heading != "", heading).otherwise(title_case(F.replace("doc_id", F.lit("_"), F.lit(" ")))).alias("title"),
        "source_path",
        "text",
    )


def skipped_files(spark: SparkSession, path: str) -> DataFrame:
    """Files that `read_documents` leaves out, with the reason. Only names are read, not contents."""
    kinds = "|".join(DOCUMENT_TYPES)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path")
        .filter(~F.lower("path").rlike(rf"\.({kinds})$"))
        .select("path", F.lit("unsupported file type").alias("message"))
    )


def save_index(index: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Persist index rows (terms and weights, or vectors) as parquet."""
    writer = index.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def load_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def index_exists(spark: SparkSession, path: str) -> bool:
    """True once a save has completed under `path`."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def save_model(model: MLWritable, root: str, name: str) -> str:
    path = f"{root.rstrip('/')}/{name}"
    model.write().overwrite().save(path)
    return path


def load_model(root: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{root.rstrip('/')}/{name}")
