"""Session defaults, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
# rows may be long texts: Spark's own 10,000 rows and 64 MB of a batch can fill a worker
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def build_session(app: str = "tidemill", master: str | None = None, **settings) -> SparkSession:
    """A session with the settings the operators assume; `settings` use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    defaults.update({k.replace("__", "."): str(v) for k, v in settings.items()})
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the time zone and make sure checkpoints have a home. Safe to call again."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    # rank filters up to this many rows per group are applied before the shuffle, too
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10000")
    given = spark.conf.getAll
    for key, value in BATCHES.items():
        if key not in given:
            spark.conf.set(key, value)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`. Only a local master may fall back to the warehouse folder."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if not root:
        current = context.getCheckpointDir()
        if current:
            return current.rsplit("/", 1)[0]
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
        # one machine: the warehouse folder is as shared as any
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, for tables written and read back within one job."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """A stored table that is read in fewer parts than the session has cores, dealt to all of them; any other as it is.

    Work on long texts would else keep one core busy per file. What moves is at most a split of a file for each core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def cut(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the checkpoint folder and go on from the written copy.

    Used where a plan is read twice and both reads must see the same rows, and where a loop
    would otherwise grow its lineage. A written table survives lost executors, is read by
    column, and has a known size, so the planner can tell what is small enough to broadcast.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
