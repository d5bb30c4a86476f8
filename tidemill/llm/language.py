"""Language identification by bit-sliced Bloom filters of letter n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.kernels import GRAM, LETTER, char_classes, lower_points, mix, pieces
from tidemill.llm.quality import learnable

SAMPLE = 3000  # documents per language that the filters may learn from; all documents are judged
GRAMS = 60_000  # n-grams kept per language, the most frequent first
SHARE = 0.5  # an n-gram belongs to every language that uses it at least this often, against the one that uses it most
BITS = 20  # the filter has 2**BITS positions, each with one bit per language
HASHES = 3
CHUNK = 1 << 17  # code points handled at once
UNKNOWN = "und"


@dataclass
class Filters:
    """`planes[w][position]` holds one bit for each of up to 63 languages; `languages` are in code-point order."""

    languages: list[str]
    planes: list[np.ndarray]
    false_rate: np.ndarray  # per language, that an n-gram it lacks still passes
    fallback: int  # the most frequent language


def _windows(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the letter triples around every letter, lower-cased; other characters count as blanks."""
    letter = char_classes()[points] == LETTER
    c = np.where(letter, lower_points()[points], 0x20).astype(np.uint64)
    c = np.concatenate(([np.uint64(0x20)], c, [np.uint64(0x20)]))
    at = np.flatnonzero(letter)
    return at, mix(c[at] * GRAM[0] + c[at + 1] * GRAM[1] + c[at + 2] * GRAM[2] + np.uint64(3))


def text_grams(texts: list[str]):
    """(row, hash) arrays of the n-grams of all texts, a bounded number of characters at a time."""
    for low, high in pieces([len(t) for t in texts], CHUNK):
        if high - low == 1 and len(texts[low]) > CHUNK:
            text = texts[low]
            for a in range(0, len(text), CHUNK):
                before = max(a - 1, 0)
                part = text[before : a + CHUNK + 1]  # one character of context on either side
                at, h = _windows(np.frombuffer(part.encode("utf-32-le"), dtype=np.uint32))
                own = (at >= a - before) & (at < a - before + CHUNK)
                yield np.full(int(own.sum()), low), h[own]
            continue
        points = np.frombuffer("\n".join(texts[low:high]).encode("utf-32-le"), dtype=np.uint32)
        at, h = _windows(points)
        first = np.cumsum([0] + [len(t) + 1 for t in texts[low : high - 1]])
        yield np.searchsorted(first, at, side="right") - 1 + low, h


def positions(h: np.ndarray) -> list[np.ndarray]:
    """The places in the filter that an n-gram sets, one per hash function."""
    return [((h >> np.uint64(BITS * j)) & np.uint64((1 << BITS) - 1)).astype(np.int64) for j in range(HASHES)]


def _strings(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def _sample_grams(batches):
    """(language, n-gram) once per document that has it."""
    for b in batches:
        texts, langs = _strings(b.column("text")), b.column("lang").to_pylist()
        found = [[] for _ in texts]
        for rows, h in text_grams(texts):
            for r in np.unique(rows).tolist():
                found[r].append(np.unique(h[rows == r]))
        for r, parts in enumerate(found):
            if parts:
                grams = np.unique(np.concatenate(parts)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([langs[r]] * len(grams), pa.string()), pa.array(grams)], names=["lang", "gram"]
                )


def train_filters(docs: DataFrame, sample: int = SAMPLE, per_language: int = GRAMS) -> Filters:
    """Filters learnt from `docs (doc_id, text, lang)`, rows with null text or language left out.

    Only documents that `learnable` allows are read, at most `sample` per language (the smallest hashed identifiers).
    What reaches the driver is one row per position of the filter, a bound that does not depend on the data.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    digest = F.md5(F.col("text").cast("binary")).alias("__text")
    usable = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & learnable()).select(
        "doc_id", F.col("lang").cast("string").alias("lang"), digest
    )
    # hashes are even: twice the sample is let through to the ranking, whatever the size of a language. The sizes of the
    # languages stand in the filter, so that it is applied in the scan and no language is ever dealt whole to a task
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Filters([], [], np.zeros(0), 0)
    number = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, n)])
    near = place * number[F.col("lang")] < F.lit(2 * sample * (1 << 20))
    order = Window.partitionBy("lang").orderBy(place, "doc_id", "__text")
    # rows alike in identifier, text and language count once, before they are ranked
    ranked = usable.filter(near).distinct().withColumn("__r", F.row_number().over(order))
    few = ranked.filter(F.col("__r") <= sample).select("doc_id", "__text", F.col("lang").alias("__lang")).distinct()
    # bounded by the sample size times the number of languages
    chosen = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & learnable()).select(
        "doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), digest
    ).join(F.broadcast(few), ["doc_id", "__text"]).filter("lang = __lang").groupBy("doc_id", "__text", "lang").agg(F.max("text").alias("text"))
    sizes = {r["lang"]: r["n"] for r in chosen.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Filters([], [], np.zeros(0), 0)
    total = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, float(n))])
    grams = chosen.select("text", "lang").mapInArrow(_sample_grams, "lang string, gram long")
    rates = grams.groupBy("gram", "lang").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumn(
        "rate", F.col("n") / total[F.col("lang")]
    )
    best = Window.partitionBy("gram")
    shared = rates.withColumn("top", F.max("rate").over(best)).filter(F.col("rate") >= SHARE * F.col("top"))
    rank = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    kept = shared.withColumn("__r", F.row_number().over(rank)).filter(F.col("__r") <= per_language)
    number = F.create_map(*[F.lit(x) for i, k in enumerate(languages) for x in (k, i)])
    bit = number[F.col("lang")]
    gram = F.col("gram")
    slots = [F.shiftrightunsigned(gram, BITS * j).bitwiseAND(F.lit((1 << BITS) - 1)) for j in range(HASHES)]
    set_bits = kept.select(
        F.explode(F.array(*slots)).alias("slot"), F.floor(bit / 63).cast("int").alias("plane"),
        F.pow(F.lit(2.0), bit % 63).cast("long").alias("mask"),
    )
    table = set_bits.groupBy("plane", "slot").agg(F.bit_or("mask").alias("mask")).toPandas()
    widths = [min(63, len(languages) - 63 * w) for w in range((len(languages) + 62) // 63)]
    planes = []
    for w, width in enumerate(widths):
        plane = np.zeros(1 << BITS, dtype=np.uint8 if width <= 8 else np.uint64)
        own = table[table["plane"] == w]
        plane[own["slot"].to_numpy()] = own["mask"].to_numpy().astype(plane.dtype)
        planes.append(plane)
    fill = [
        float(np.mean((planes[i // 63] >> planes[i // 63].dtype.type(i % 63)) & planes[i // 63].dtype.type(1)))
        for i in range(len(languages))
    ]
    return Filters(languages, planes, np.array(fill) ** HASHES, languages.index(max(sizes, key=lambda k: (sizes[k], k))))


def hits_by_language(texts: list[str], f: Filters) -> tuple[np.ndarray, np.ndarray]:
    """(rows x languages) counts of the n-grams that each language's filter holds, and the n-grams of each row."""
    counts, seen = np.zeros((len(texts), len(f.languages))), np.zeros(len(texts))
    for rows, h in text_grams(texts):
        seen += np.bincount(rows, minlength=len(texts))
        at = positions(h)
        for w, plane in enumerate(f.planes):
            held = plane[at[0]]
            for p in at[1:]:
                held = held & plane[p]  # all languages that may contain the n-gram, at once
            for i in range(63 * w, min(63 * w + 63, len(f.languages))):
                own = rows[(held >> held.dtype.type(i - 63 * w)) & held.dtype.type(1) == 1]
                counts[:, i] += np.bincount(own, minlength=len(texts))
    return counts, seen


def _true_counts(texts: list[str], f: Filters) -> tuple[np.ndarray, np.ndarray]:
    """`hits_by_language` with the counts corrected for false positives."""
    counts, seen = hits_by_language(texts, f)
    return np.maximum((counts - seen[:, None] * f.false_rate) / (1.0 - f.false_rate), 0.0), seen


def _judged(texts: list[str], f: Filters) -> tuple[list[str], list[float]]:
    true, seen = _true_counts(texts, f)
    total = true.sum(axis=1)
    names, scores = [], []
    for r in range(len(texts)):
        if not seen[r] or not f.languages:
            names.append(UNKNOWN)
            scores.append(0.0)
        elif total[r] <= 0:
            names.append(f.languages[f.fallback])
            scores.append(0.0)
        else:
            i = int(np.argmax(true[r]))
            names.append(f.languages[i])
            scores.append(float(true[r, i] / total[r]))
    return names, scores


def predict_language(docs: DataFrame, f: Filters) -> DataFrame:
    """`(doc_id, lang_pred, score)` for every row of `docs`.

    Per language the n-grams that pass its filter are counted and the count is corrected for false positives; the
    largest count wins, the first language in code-point order on a tie, and `score` is its part of all corrected counts. A
    text without n-grams of any language gets the most frequent one with score 0. Null texts, texts without a letter
    and all texts when nothing was learnt are `und` with score 0.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            names, scores = _judged(_strings(b.column("text")), f)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double"
    )


def evidence(texts: list[str], f: Filters) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the part of its n-grams that the winner holds, and how far the winner leads the next language, as a part of its own
    corrected count. Neither depends on the number of languages; a text without n-grams of any language has 0 and 0."""
    true, seen = _true_counts(texts, f)
    ranked = np.sort(np.hstack([np.zeros((len(texts), 2)), true]), axis=1)
    best, second = ranked[:, -1], ranked[:, -2]
    return best / np.maximum(seen, 1.0), (best - second) / np.where(best > 0, best, 1.0)


def keep_identified(docs: DataFrame, f: Filters, covered: float, lead: float) -> DataFrame:
    """The rows of `docs`, with all their columns, whose winner has `evidence` of `covered` and `lead` or more.

    Only texts go to the Python workers, and only a flag comes back."""

    @F.arrow_udf("boolean")
    def identified(text: pa.Array) -> pa.Array:
        part, ahead = evidence(_strings(text), f)
        return pa.array((part > 0) & (part >= covered) & (ahead >= lead), pa.bool_())

    return docs.filter(identified(F.col("text").cast("string")))
