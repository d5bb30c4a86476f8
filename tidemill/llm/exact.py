"""Exact deduplication by a stateful stream over content digests."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.kernels import as_bytes
from tidemill.session import cut, scratch_path

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKS,
    # stores are many and small: files grow as they fill instead of taking megabytes each from the start
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # all stores of an executor share one bound on their memory, and are closed soon after the stream has ended
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",
}
FEW = 200_000  # rows of identifiers and digests that may be sent to every task; more meet by a shuffle
ROWS = "doc_id long, digest binary, place string"
TEXTS = "doc_id long, digest binary, body binary"


def _digests(batches):
    for b in batches:
        found = [hashlib.sha256(t.lower()).digest() for t in as_bytes(b.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(found, pa.binary()), b.column("place")], names=["doc_id", "digest", "place"]
        )


def _bodies(batches):
    for b in batches:
        low = [t.lower() for t in as_bytes(b.column("text"))]
        found = [hashlib.sha256(t).digest() for t in low]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(found, pa.binary()), pa.array(low, pa.binary())],
            names=["doc_id", "digest", "body"],
        )


def _fold(rows_path: str, spark, max_files: int | None) -> DataFrame:
    """Run the arrivals through the keyed state; the last state of every digest comes back."""
    # settings of the state stay in a session of their own, which shares the application
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    for k, v in STATE.items():  # among them settings of the store itself, which Spark does not list as its own
        own.conf.set(k, v)
    source = own.readStream.schema(ROWS).option("maxFilesPerTrigger", max_files or 1_000_000).parquet(rows_path)
    state = source.groupBy("digest").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "place")).alias("keeper")
    )
    home, out = scratch_path(spark, "dedup-state"), scratch_path(spark, "dedup-seen")

    def keep_batch(changed: DataFrame, number: int) -> None:
        # a batch that is run again overwrites its own folder
        changed.write.mode("overwrite").parquet(f"{out}/batch={number}")

    run = (
        state.writeStream.outputMode("update").foreachBatch(keep_batch)
        .option("checkpointLocation", home).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    schema = "digest binary, group_size long, keeper struct<doc_id: long, place: string>"
    # a digest is written by every batch that met it; sizes only grow
    seen = spark.createDataFrame([], schema)
    if run.lastProgress is not None:
        seen = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out)
    return seen.groupBy("digest").agg(F.max(F.struct("group_size", "keeper")).alias("last")).select(
        "digest", "last.group_size", F.col("last.keeper.doc_id").alias("keep_id"), F.col("last.keeper.place").alias("place")
    )


def _few(rows: DataFrame) -> DataFrame:
    """A written table, marked for sending to every task if it is counted to be small."""
    rows = cut(rows)
    return F.broadcast(rows) if rows.count() <= FEW else rows


def exact_groups(docs: DataFrame, max_files: int | None = None) -> DataFrame:
    """`(doc_id, keep_id, group_size, kept, text_sha256, place)`: one row per row of `docs`.

    Texts are equal when their bytes are after lower-casing A-Z; null counts as empty. The largest `doc_id` of a
    group stays. Digests stream into disk-backed state that never expires and holds, by digest, the number of rows,
    the identifier that stays and `place`, the file its content lies in (empty if `docs` does not come from files).
    A digest seen more than once is a hit: the full bytes of its rows are then grouped as they are, and rows whose
    digests agree but whose bytes do not get groups of their own. Equal bytes are counted inside each task before they
    meet, so a text held by any number of rows reaches another task once per task that holds it; only bytes of hits are
    shuffled as long as there are few hits (`FEW`), else all are.

    A null `doc_id` never stays while its group has another one. Rows that agree in `doc_id` and text are one row
    seen again: each is returned, all with the same values. `max_files` bounds the files of arrivals per micro-batch.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows_path = scratch_path(spark, "dedup-rows")
    plain.withColumn("place", F.input_file_name()).mapInArrow(_digests, ROWS).write.parquet(rows_path)
    rows = spark.read.schema(ROWS).parquet(rows_path)
    groups = cut(_fold(rows_path, spark, max_files))
    bodies = plain.mapInArrow(_bodies, TEXTS)
    hits = _few(groups.filter("group_size > 1").select("digest"))
    # the sum inside each task stands before the exchange, which goes by the bytes as well as the digest
    by_bytes = bodies.join(hits, "digest", "left_semi").groupBy("digest", "body").agg(
        F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep")
    )
    # digests that stand for more than one text: none is expected, and each is resolved by its bytes
    texts = by_bytes.select("digest", "n", "keep").groupBy("digest").agg(F.count(F.lit(1)).alias("texts"))
    torn = cut(texts.filter("texts > 1").select("digest"))
    whole = rows.drop("place").join(groups, "digest", "left")
    if not torn.isEmpty():
        split = bodies.join(torn, "digest", "left_semi").join(
            by_bytes.join(torn, "digest", "left_semi"), ["digest", "body"]
        )
        whole = whole.join(torn, "digest", "left_anti").unionByName(
            split.select("digest", "doc_id", F.col("n").alias("group_size"), F.col("keep").alias("keep_id"),
                         F.lit(None).cast("string").alias("place"))
        )
    return whole.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "place",
    )


def drop_copies(docs: DataFrame, max_files: int | None = None) -> DataFrame:
    """The rows of `docs` that stay, once each, with the columns of `docs`.

    Of rows that agree in `doc_id` and text but not in other columns, the one whose columns come first as JSON text stays.
    Texts are not shuffled as long as few rows go (`FEW`), else once.
    """

    @F.arrow_udf("binary")
    def lowered_digest(text: pa.Array) -> pa.Array:
        return pa.array([hashlib.sha256(t.lower()).digest() for t in as_bytes(text)], pa.binary())

    names = docs.columns
    groups = cut(exact_groups(docs, max_files).select("doc_id", F.unhex("text_sha256").alias("digest"), "kept"))
    gone = _few(groups.filter("NOT kept").groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")))
    again = cut(groups.filter("kept").groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    # the given columns stay inside a struct, so none can clash with what is added
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    keyed = docs.select(
        row.alias("row"), F.col("doc_id").cast("long").alias("id"), lowered_digest(F.col("text").cast("string")).alias("sha")
    )

    def same(other: DataFrame):
        return keyed["id"].eqNullSafe(other["doc_id"]) & (keyed["sha"] == other["digest"])

    left = keyed.join(gone, same(gone), "left_anti")
    if again.isEmpty():
        return left.select("row.*")
    once = left.join(again, same(again), "left_semi").groupBy("id", "sha").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return left.join(again, same(again), "left_anti").select("row.*").unionByName(once.select("row.*"))
