"""Importance resampling towards a target distribution: overlapped n-gram spans, hashed counts, Gumbel draws."""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.kernels import as_bytes
from tidemill.operators.ordering import global_index
from tidemill.session import cut

BUCKETS = 10_000
SEED = "2024"
LEAST_WORDS = 20  # documents of fewer words are never drawn
PERCENT = 10


def _fold_table() -> bytes:
    """Capitals become small letters; every other ASCII character that is no letter or digit becomes a blank."""
    table = bytearray(range(256))
    for b in range(0x80):
        if not (chr(b).isascii() and chr(b).isalnum()):
            table[b] = 0x20
    return bytes(table).lower()


FOLD = _fold_table()


def collapse(text: bytes) -> bytes:
    """The words of a text, A-Z lower-cased, with each run of separators as one blank. Bytes beyond ASCII belong to words."""
    return b" ".join(text.translate(FOLD).split())


def span_patterns(longest: int) -> list[regex.Pattern]:
    """One pattern per length: that many words between word boundaries, found at every word when matches may overlap."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1)) for n in range(1, longest + 1)]


def feature_buckets(text: bytes, patterns: list[regex.Pattern], buckets: int) -> tuple[int, np.ndarray]:
    """(words, bucket of every feature) of one text: spans are read one by one, so only their buckets are kept."""
    words = collapse(text)

    def spans() -> Iterator[int]:
        for p in patterns:
            for m in p.finditer(words, overlapped=True):
                yield crc32(m[0])

    found = np.fromiter(spans(), dtype=np.uint32)
    return words.count(b" ") + 1 if words else 0, found % np.uint32(buckets)


def _features(longest: int, buckets: int):
    patterns = span_patterns(longest)

    def run(batches):
        for b in batches:
            both = [feature_buckets(t, patterns, buckets) for t in as_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(b.num_columns - 1)), pa.array([w for w, _ in both], pa.int64()),
                 pa.array([len(f) for _, f in both], pa.int64()), pa.array([f.astype("<u4").tobytes() for _, f in both], pa.binary())],
                names=[*b.schema.names[:-1], "n_words", "n_features", "found"],
            )

    return run


def features(rows: DataFrame, keys: list[Column], longest: int, buckets: int) -> DataFrame:
    """`keys` of `rows (…, text)` with `n_words`, `n_features` and `found`: the buckets of all features, four bytes each."""
    asked = rows.select(*keys, F.col("text").cast("string").alias("text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema[:-1])
    extra = "n_words long, n_features long, found binary"
    return asked.mapInArrow(_features(longest, buckets), f"{kept}, {extra}" if kept else extra)


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over all rows. Every task adds up its own; one row per bucket reaches the driver."""

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for v in b.column("found").to_pylist():
                total += np.bincount(np.frombuffer(v, dtype="<u4"), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["bucket", "n"])

    sums = found.select("found").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Per bucket, thousandths of the logarithm of its smoothed share of the target over that of the source, floored."""
    size = len(target)
    t_all, s_all = float(int(target.sum()) + size), float(int(source.sum()) + size)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for t, s in zip(target.tolist(), source.tolist())],
        dtype=np.int64,
    )


def weigh(found: DataFrame, gain: np.ndarray, out: str) -> DataFrame:
    """The columns that `out` names, `weight` being the floored mean of the gains over a row's features, 0 without any."""

    def run(batches):
        for b in batches:
            weight = []
            for v in b.column("found").to_pylist():
                at = np.frombuffer(v, dtype="<u4")
                weight.append(int(gain[at].sum()) // len(at) if len(at) else 0)
            columns = {n: b.column(n) for n in b.schema.names if n != "found"} | {"weight": pa.array(weight, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns)

    return found.mapInArrow(run, out)


def gumbel(key: Column, seed: str) -> Column:
    """Thousandths of a Gumbel variate, floored, from 32 bits of a digest of seed and key; a null key counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def importance_ranks(
    docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, least: int = LEAST_WORDS,
    percent: int = PERCENT, seed: str = SEED,
) -> DataFrame:
    """`(doc_id, digest, n_words, n_features, weight, score, rank)`: one row per row of `docs (doc_id, text)`.

    Features are all runs of 1 to `longest` words, repeats counted, by the CRC-32 of their bytes modulo `buckets`. `target (text)` gives the
    distribution aimed at. `score` is the weight plus a Gumbel variate of `doc_id`, so the highest scores are a draw without
    replacement by importance. Of the N rows of `least` words or more, the floor of `percent` % with the highest scores are drawn and
    ranked from 1; all others have a null rank. Ties go to the smaller `doc_id`, null last, then to fewer features and less weight;
    rows alike in all of these are interchangeable.

    Null texts count as empty: no features, weight 0. Repeated rows are scored each. Without target texts all targets are alike
    (each bucket counts 1 for smoothing). `digest` is the MD5 of the text, by which `draw` finds a row again.
    Features are found once and written (4 bytes each); counts per bucket are all that reaches the driver.
    """
    digest = F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))).alias("digest")
    found = cut(features(docs, [F.col("doc_id").cast("long").alias("doc_id"), digest], longest, buckets))
    aim = features(target, [], longest, buckets)
    gain = gains(bucket_counts(aim, buckets), bucket_counts(found, buckets))
    kept = "doc_id long, digest binary, n_words long, n_features long, weight long"
    scored = cut(weigh(found, gain, kept).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)))
    able = scored.filter(F.col("n_words") >= least)
    drawn = able.count() * percent // 100
    names = [*scored.columns, "rank"]
    if not drawn:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    # scores are whole numbers from a fixed range, so their histogram is small whatever the number of rows
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    levels = able.groupBy("score").agg(F.count(F.lit(1)).alias("n")).withColumn("above", F.coalesce(F.sum("n").over(higher), F.lit(0)))
    floor = levels.filter(F.col("above") < drawn).agg(F.min("score").alias("s")).first()["s"]
    near = (F.col("n_words") >= least) & (F.col("score") >= F.lit(floor))
    # the last key makes equal rows distinct, so that any number of them spreads over partitions
    high = scored.filter(near).withColumn("__row", F.monotonically_increasing_id())
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight"), F.asc("__row")]
    ranked = global_index(high, *order, name="rank", start=1)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    rest = scored.filter(~near).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*names).unionByName(rest.select(*names))


def draw(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` that `importance_ranks` draws, with all their columns. Rows alike in `doc_id` and text come together."""
    few = importance_ranks(docs, target, **settings).filter("rank IS NOT NULL")
    few = few.select(F.col("doc_id").alias("__key"), F.col("digest").alias("__digest"))
    digest = F.unhex(F.md5(F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")))
    return docs.join(few, docs["doc_id"].cast("long").eqNullSafe(few["__key"]) & (digest == few["__digest"]), "left_semi")
