"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.kernels import as_bytes, pieces, word_hashes
from tidemill.llm.quality import learnable
from tidemill.session import cut

SAMPLE = 6000  # labelled rows per label that may be learnt from; all rows are scored
LEARNT = 300  # words that the lexicon takes from labelled texts
LEAST_TEXTS = 3  # toxic texts that a learnt word occurs in at least
LEAST_SHARE = 0.01  # and the least part of all toxic texts
LEAST_RATIO = 4.0  # and how much more often than in other texts
NEAR = 4  # words between an insult and a second-person pronoun
FOLDS = 3  # words, trees and calibration are learnt from different rows
ROUNDS, DEPTH, RATE, LEAF = 20, 3, 0.2, 4

# common insults of four languages, as `fold` writes them; a start that labelled texts add to
INSULTS = """
idiot idiots moron morons imbecile stupid dumb dumbass fool loser losers scum trash garbage clown freak creep jerk bastard bitch
asshole pathetic worthless disgusting ugly filthy vermin pig whore slut retard coward liar
dumm dummkopf trottel vollidiot arschloch abschaum versager schwachkopf wertlos ekelhaft hure depp
imbécile crétin débile connard connasse salaud salope ordure minable abruti dégoûtant pourriture
estúpido estúpida imbécil tonto basura inútil asqueroso cabrón payaso perdedor escoria patético
""".split()
SECOND_PERSON = """
you your yours yourself youre u ur du dich dir dein deine deinen deiner ihr euch euer eure tu te toi ton ta tes vous votre vos
tú ti tus usted ustedes vosotros vuestro eres
""".split()

FEATURES = (
    "insult_rate", "insults", "learnt_rate", "learnt_weight", "learnt_most", "second_person_rate", "near_rate", "near",
    "capital_rate", "shouted_rate", "exclamation_rate", "question_rate", "symbol_rate", "disguised", "disguised_rate", "mixed_rate", "words",
)

SYMBOLS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
CAPITALS = bytes(range(0x41, 0x5B))
LETTERS = CAPITALS + bytes(range(0x61, 0x7B))
INSIDE = b".*_-'`~^"  # characters put between letters to hide a word
PLAIN = bytes(b if b >= 0x80 or chr(b).isalnum() or b == 0x0A else 0x20 for b in range(256)).lower()
LOOKALIKE = bytes.maketrans(b"01345789@$|", b"oieastbgasi")
HIDDEN = bytes(LOOKALIKE[b] if LOOKALIKE[b] != b else PLAIN[b] for b in range(256))
BANG = regex.compile(rb"(?<=[A-Za-z])!(?=[A-Za-z])")
SPELLED = regex.compile(rb"(?<![^ \n])[a-z](?: [a-z]){2,}(?![^ \n])")
SHOUTED = regex.compile(rb"(?<![A-Za-z])[A-Z]{3,}(?![A-Za-z])")
MIXED = regex.compile(rb"[A-Za-z][0-9@$!*]+[A-Za-z]")


def squeeze(text: bytes) -> bytes:
    """Runs of three or more equal bytes as one: `looooser` as `loser`, while `looser` stays."""
    data = np.frombuffer(text, dtype=np.uint8)
    if len(data) < 3:
        return text
    edge = np.flatnonzero(np.concatenate(([True], data[1:] != data[:-1])))
    if len(edge) == len(data):
        return text
    long = np.diff(np.append(edge, len(data))) > 2
    keep = np.ones(len(data), dtype=bool)
    for a, b in zip(edge[long].tolist(), np.append(edge, len(data))[1:][long].tolist()):
        keep[a + 1 : b] = False
    return data[keep].tobytes()


def fold(text: bytes) -> bytes:
    """A text with disguises undone: look-alike digits and symbols as letters, marks inside words and stretched letters gone,
    words spelled letter by letter put together. `1d.i*0t`, `idiooot` and `i d i o t` all become `idiot`."""
    shown = BANG.sub(b"i", text).translate(HIDDEN, INSIDE)
    return SPELLED.sub(lambda m: m[0].replace(b" ", b""), squeeze(shown))


def _hashes(words: list[str]) -> np.ndarray:
    """Ascending hashes of words as they stand in folded texts."""
    found = [word_hashes([fold(w.encode())])[1] for w in words]
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *found]))


@dataclass
class Lexicon:
    """Hashes of words, each ascending: built-in insults, learnt words with their weights, second-person pronouns."""

    insults: np.ndarray
    learnt: np.ndarray
    weights: np.ndarray
    pronouns: np.ndarray


def _held(words: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which words the ascending table holds, their places in it)."""
    if not len(table):
        return np.zeros(len(words), dtype=bool), np.zeros(len(words), dtype=np.int64)
    at = np.minimum(np.searchsorted(table, words), len(table) - 1)
    return table[at] == words, at


def _gap_to_nearest(at: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Distance of every position of `at` to the nearest one of `others`, both ascending."""
    if not len(others):
        return np.full(len(at), np.iinfo(np.int64).max)
    i = np.searchsorted(others, at)
    return np.minimum(np.abs(others[np.maximum(i - 1, 0)] - at), np.abs(others[np.minimum(i, len(others) - 1)] - at))


def dense_features(texts: list[bytes], lex: Lexicon) -> np.ndarray:
    """(texts x `FEATURES`). Rates are per word or per byte; a text without words has zeros throughout."""
    count = len(texts)
    docs, words = word_hashes([fold(t) for t in texts])
    of = lambda rows, w=None: np.bincount(rows, weights=w, minlength=count).astype(np.float64)
    total = of(docs)
    insult = _held(words, lex.insults)[0]
    learnt, at = _held(words, lex.learnt)
    pronoun = _held(words, lex.pronouns)[0]
    weight = lex.weights[at[learnt]] if len(lex.learnt) else np.zeros(0)
    most = np.zeros(count)
    np.maximum.at(most, docs[learnt], weight)
    # a place of its own for every word, with texts further apart than any distance that counts
    place = np.arange(len(words)) + docs * (NEAR + 1)
    hit = insult | learnt
    close = np.zeros(len(words), dtype=bool)
    close[hit] = _gap_to_nearest(place[hit], place[pronoun]) <= NEAR
    # hits that the text shows only once its disguises are undone
    shown_docs, shown = word_hashes([t.translate(PLAIN) for t in texts])
    open_hits = of(shown_docs[_held(shown, lex.insults)[0] | _held(shown, lex.learnt)[0]])
    disguised = np.maximum(of(docs[hit]) - open_hits, 0.0)
    per_word, size = 1.0 / np.maximum(total, 1.0), np.array([max(len(t), 1) for t in texts], dtype=np.float64)
    letters = np.array([max(len(t) - len(t.translate(None, LETTERS)), 1) for t in texts], dtype=np.float64)
    number = lambda fn: np.array([fn(t) for t in texts], dtype=np.float64)
    columns = [
        of(docs[insult]) * per_word, of(docs[insult]), of(docs[learnt]) * per_word, of(docs[learnt], weight) * per_word, most,
        of(docs[pronoun]) * per_word, of(docs[close]) * per_word, of(docs[close]),
        number(lambda t: len(t) - len(t.translate(None, CAPITALS))) / letters, number(lambda t: len(SHOUTED.findall(t))) * per_word,
        number(lambda t: t.count(b"!")) / size, number(lambda t: t.count(b"?")) / size,
        number(lambda t: len(t) - len(t.translate(None, SYMBOLS))) / size,
        disguised, disguised * per_word, number(lambda t: len(MIXED.findall(t))) * per_word, total,
    ]
    out = np.stack(columns, axis=1) if count else np.zeros((0, len(FEATURES)))
    out[total == 0] = 0.0
    return out


def _featured(lex: Lexicon):
    """The columns before `text`, and the features, a bounded number of bytes at a time."""

    def run(batches):
        for b in batches:
            texts = as_bytes(b.column("text"))
            for low, high in pieces([len(t) for t in texts]):
                part = b.slice(low, high - low)
                found = dense_features(texts[low:high], lex)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(b.num_columns - 1)), pa.array(list(found), pa.list_(pa.float64()))],
                    names=[*b.schema.names[:-1], "features"],
                )

    return run


def with_features(rows: DataFrame, lex: Lexicon) -> DataFrame:
    """`rows (…, text)` with the vector `features` in place of the text, which must come last."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(_featured(lex), f"{kept}, features array<double>").withColumn("features", array_to_vector("features"))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """`(label, fold, weight, text)` of at most `sample` learnable documents per label, those with the smallest hashed identifiers.

    A document with several labels counts by their mean; equal texts count once. `weight` restores the labels' shares.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & learnable()).groupBy("doc_id").agg(
        (F.avg("toxic") >= 0.5).cast("double").alias("label")
    )
    place = F.xxhash64("doc_id")
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [known.filter(F.col("label") == v).orderBy(place, "doc_id").limit(sample) for v in (0.0, 1.0)]
    # at most two samples of identifiers: small enough to send to every task
    few = F.broadcast(chosen[0].unionByName(chosen[1]))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text is not null").join(few, "doc_id")
    once = rows.groupBy("text").agg(F.max("label").alias("label"), F.min("doc_id").alias("doc_id"))
    turn = F.pmod(F.xxhash64("doc_id", F.lit(FOLDS)), F.lit(FOLDS))
    share = lambda v: F.lit(max(sizes.get(v, 0) / max(min(sizes.get(v, 0), sample), 1), 1.0))
    weight = F.when(F.col("label") == 1.0, share(1.0)).otherwise(share(0.0))
    return cut(once.select("label", turn.alias("fold"), weight.alias("weight"), "text"))


def _text_words(batches):
    """(label, word) once per text that holds the folded word."""
    for b in batches:
        labels = b.column("label").to_pylist()
        for label, text in zip(labels, as_bytes(b.column("text"))):
            words = np.unique(word_hashes([fold(text)])[1]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(words), label)), pa.array(words)], names=["label", "word"])


def learn_lexicon(examples: DataFrame, most: int = LEARNT) -> Lexicon:
    """The built-in words, and at most `most` words that toxic texts of `examples (label, text)` use far more often than others."""
    sizes = {r["label"]: r["n"] for r in examples.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    words = examples.select("label", "text").mapInArrow(_text_words, "label double, word long")
    counts = words.groupBy("word").agg(F.sum("label").alias("k1"), F.sum(1.0 - F.col("label")).alias("k0"))
    rate = lambda k, v: (F.col(k) + 0.5) / (sizes.get(v, 0) + 1.0)
    weight = F.log(rate("k1", 1.0) / rate("k0", 0.0))
    kept = counts.withColumn("w", weight).filter((F.col("k1") >= max(LEAST_TEXTS, LEAST_SHARE * sizes.get(1.0, 0))) & (F.col("w") >= float(np.log(LEAST_RATIO))))
    rows = kept.orderBy(F.desc(F.col("k1") * F.col("w")), "word").limit(most).collect()
    pairs = sorted((int(r["word"]) % (1 << 64), r["w"]) for r in rows)
    learnt, weights = np.array([w for w, _ in pairs], dtype=np.uint64), np.array([w for _, w in pairs])
    return Lexicon(_hashes(INSULTS), learnt, weights, _hashes(SECOND_PERSON))


@dataclass
class Model:
    """`trees` and `steps` are None when the labels are all alike; every score is then `base`."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    steps: IsotonicRegressionModel | None
    base: float


def _raw(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])


def train_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """A model learnt from `docs (doc_id, text)` and `labels (doc_id, toxic)`.

    Rows without text, label or identifier are not learnt from. The sample is dealt to three folds: one gives the
    words, one the trees, one the calibration, so that none is judged by what it was learnt from. Where a fold lacks one of the
    labels, all three steps use the whole sample.
    """
    examples = labelled_sample(docs, labels, sample)
    seen = {(r["label"], r["fold"]) for r in examples.groupBy("label", "fold").count().collect()}
    split = len(seen) == 2 * FOLDS
    fold_of = lambda i: examples.filter(F.col("fold") == i) if split else examples
    lexicon = learn_lexicon(fold_of(0))
    if len({label for label, _ in seen}) < 2:
        return Model(lexicon, None, None, float(any(label for label, _ in seen)))
    parts = [cut(with_features(fold_of(i).select("label", "weight", "text"), lexicon)) for i in (1, 2)]
    trees = GBTClassifier(
        maxIter=rounds, maxDepth=DEPTH, stepSize=RATE, minInstancesPerNode=LEAF, weightCol="weight", seed=1,
    ).fit(parts[0].coalesce(1).sortWithinPartitions(F.hash("features"), "label"))
    steps = IsotonicRegression(featuresCol="raw", weightCol="weight", predictionCol="calibrated").fit(_raw(trees, parts[1]).select("raw", "label", "weight"))
    return Model(lexicon, trees, steps, 0.0)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """`(doc_id, score)`: the calibrated probability of label 1 for every row of `docs (doc_id, text)`.

    Null and empty texts, and texts of symbols only, have features of 0 throughout and the score that goes with them. Repeated rows are scored each.
    """
    rows = with_features(docs.select("doc_id", F.col("text").cast("string").alias("text")), model.lexicon)
    if model.trees is None:
        return rows.select("doc_id", F.lit(model.base).alias("score"))
    scored = model.steps.transform(_raw(model.trees, rows))
    score: Column = F.greatest(F.least(F.col("calibrated"), F.lit(1.0)), F.lit(0.0))
    return scored.select("doc_id", score.alias("score"))
