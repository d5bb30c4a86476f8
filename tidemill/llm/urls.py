"""URL filters: host and path rules first, a linear model on hashed character n-grams for the rest."""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.kernels import GRAM, as_bytes, mix, pieces
from tidemill.llm.linear import Settings, row_margins, sigmoid, train

SAMPLE = 5000  # labelled URLs per verdict that the model may learn from; all URLs are judged
GRAM_SIZES = (3, 4, 5)
Rule = tuple[str, str]  # (verdict, host and path)


def _rest(url: Column) -> Column:
    """What follows the first `://`; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits: its host or a subdomain, and the start of the path."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule in sorted(rules, key=lambda r: len(r[1])):
        own_host, slash, tail = rule.partition("/")
        own_path = slash + tail
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, decision).otherwise(verdict)
    return name, verdict


def _grams(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of the byte n-grams of each text, rows ascending; texts begin and end with a line feed."""
    rows, slots = [], []
    for low, high in pieces([len(t) + 2 for t in texts], 1 << 20):
        framed = [b"\n" + t + b"\n" for t in texts[low:high]]
        data = np.frombuffer(b"".join(framed), dtype=np.uint8).astype(np.uint64)
        doc = np.repeat(np.arange(low, high), [len(t) for t in framed])
        for size in GRAM_SIZES:
            n = len(data) - size + 1
            if n <= 0:
                continue
            h = np.full(n, size, dtype=np.uint64)
            for j in range(size):
                h += data[j : j + n] * GRAM[j]
            whole = doc[:n] == doc[size - 1 :]
            rows.append(doc[:n][whole])
            slots.append((mix(h[whole]) >> np.uint64(64 - bits)).astype(np.int64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    r, s = np.concatenate(rows), np.concatenate(slots)
    order = np.argsort(r, kind="stable")
    return r[order], s[order]


def train_urls(labelled: DataFrame, settings: Settings | None = None, sample: int = SAMPLE):
    """A model from `labelled (host, path, verdict)`; at most `sample` distinct URLs of each verdict, smallest hashes first.

    A URL labelled both ways is not learnt from. Rows without a verdict are left out.
    """
    s = settings or Settings(bits=16, alpha=0.3, l1=0.002, l2=0.01, shards=1)
    known = labelled.filter("verdict is not null").groupBy("host", "path").agg(
        F.min("verdict").alias("low"), F.max("verdict").alias("high")
    ).filter("low = high")
    place = F.xxhash64("host", "path")
    chosen = [known.filter(F.col("low") == v).orderBy(place, "host", "path").limit(sample) for v in ("allow", "block")]
    examples = chosen[0].unionByName(chosen[1]).select(
        F.concat("host", "path").alias("key"), (F.col("low") == "allow").cast("double").alias("label"),
        F.concat("host", F.lit("\n"), "path").alias("text"),
    )
    w, bias = train(examples, lambda b: _grams(as_bytes(b.column("text")), s.bits), s)
    return w, bias, s


def judge_urls(pages: DataFrame, rules: list[Rule], sample: int = SAMPLE) -> DataFrame:
    """`(page_id, host, path, rule, verdict, score)` for every row of `pages`.

    `host` and `path` are empty for a null URL or one without `://`. The longest fitting rule decides. The URLs that
    rules decide form the labelled table from which the model learns; it decides the rest: `allow` from a score of a
    half on, which is also what it gives when there was nothing to learn from.
    """
    url = F.col("url").cast("string")
    parts = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumn("rule", name).withColumn("verdict", verdict)
    w, bias, s = train_urls(ruled, sample=sample)
    kind = pages.schema["page_id"].dataType.simpleString()
    names = ["page_id", "host", "path", "rule", "verdict", "score"]

    def run(batches):
        for b in batches:
            texts = [h + b"\n" + p for h, p in zip(as_bytes(b.column("host")), as_bytes(b.column("path")))]
            rows, slots = _grams(texts, s.bits)
            scores = sigmoid(row_margins(rows, slots, len(texts), w, bias))
            kept = [b.column(n) for n in names[:4]]
            decided = [v or ("allow" if x >= 0.5 else "block") for v, x in zip(b.column("verdict").to_pylist(), scores)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(decided, pa.string()), pa.array(scores)], names=names)

    schema = f"page_id {kind}, host string, path string, rule string, verdict string, score double"
    return ruled.mapInArrow(run, schema)
