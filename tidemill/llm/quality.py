"""Quality scores of texts by a linear model on hashed word n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.kernels import as_bytes, gram_hashes, mix, pieces, word_hashes
from tidemill.llm.linear import Settings, row_margins, sigmoid, train

SAMPLE = 6000  # labelled rows per label that the model may learn from; all rows are scored


def learnable(key: str = "doc_id"):
    """Rows that a model may learn from: crc32 of the identifier as text, modulo 3, is not 1."""
    return F.crc32(F.col(key).cast("string")) % 3 != 1


def _shape_tables() -> tuple[bytes, np.ndarray]:
    """Byte to shape (A, a and 0 for capitals, other letters and digits), and which shapes are written once per run."""
    shape = bytearray(range(256))
    for b in range(256):
        if 0x41 <= b <= 0x5A:
            shape[b] = ord("A")
        elif 0x61 <= b <= 0x7A or b >= 0x80:
            shape[b] = ord("a")
        elif 0x30 <= b <= 0x39:
            shape[b] = ord("0")
    once = np.zeros(256, dtype=bool)
    once[[ord(c) for c in "Aa0"]] = True
    return bytes(shape), once


SHAPE, ONCE = _shape_tables()


def shapes(text: bytes) -> bytes:
    """`Thus, 12 MEN!!` -> `Aa, 0 A!!`: words as they look, with runs of one kind of character written once."""
    data = np.frombuffer(text.translate(SHAPE), dtype=np.uint8)
    again = np.zeros(len(data), dtype=bool)
    again[1:] = (data[1:] == data[:-1]) & ONCE[data[1:]]
    return data[~again].tobytes()


def _grams(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of all words and word pairs, lower-cased and as shapes, rows ascending.

    A pair of equal words has the slot of all such pairs besides its own.
    """
    rows, slots = [], []
    for salt, seen in enumerate(([t.lower() for t in texts], [shapes(t) for t in texts])):
        docs, words = word_hashes(seen)
        for r, h in ((docs, words), gram_hashes(docs, words, 2)):
            rows.append(r)
            slots.append((mix(h + np.uint64(salt)) >> np.uint64(64 - bits)).astype(np.int64))
        if salt == 0:
            again = np.flatnonzero((words[1:] == words[:-1]) & (docs[1:] == docs[:-1]))
            rows.append(docs[again])
            slots.append(np.zeros(len(again), dtype=np.int64))
    rows, slots = np.concatenate(rows), np.concatenate(slots)
    order = np.argsort(rows, kind="stable")
    return rows[order], slots[order]


def train_quality(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, sample: int = SAMPLE):
    """`(weights, bias, settings)` learnt from `docs (doc_id, text)` and `labels (doc_id, quality)`.

    Rows without text, label or identifier are not learnt from; a document with several labels counts by their mean.
    At most `sample` labelled documents of each label are used, those with the smallest hashed identifiers.
    """
    s = settings or Settings()
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & learnable()).groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("double").alias("label")
    )
    place = F.xxhash64("doc_id")
    chosen = [known.filter(F.col("label") == v).orderBy(place, "doc_id").limit(sample) for v in (0.0, 1.0)]
    # at most two samples of identifiers: small enough to send to every task
    few = F.broadcast(chosen[0].unionByName(chosen[1]))
    rows = docs.select("doc_id", F.col("text").cast("string")).filter("text is not null").join(few, "doc_id")
    examples = rows.select(F.col("doc_id").cast("long").alias("key"), "label", "text")
    w, bias = train(examples, lambda b: _grams(as_bytes(b.column("text")), s.bits), s)
    return w, bias, s


def score_quality(docs: DataFrame, model) -> DataFrame:
    """`(doc_id, score)`: probability of label 1 for every row of `docs`; null counts as empty and gets the bias alone."""
    w, bias, s = model
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = as_bytes(b.column("text"))
            margins = np.empty(len(texts))
            for low, high in pieces([len(t) for t in texts]):
                rows, slots = _grams(texts[low:high], s.bits)
                margins[low:high] = row_margins(rows, slots, high - low, w, bias)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sigmoid(margins))], names=["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, score double")
