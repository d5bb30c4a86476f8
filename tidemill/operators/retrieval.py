"""Term weights, inverted-index and dense search, gates, contexts and extractive answers.

Spark cuts a chunk into tokens; terms are counted inside the rows of their chunk, as numbers of a batch's own words. A weight table is laid out by chunk, so normalising works inside the partitions.
Tables of questions are sent to every task only where they are counted to be small.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import texts
from tidemill.functions.arrays import normalised
from tidemill.session import cut

BLOCK_ROWS = 500_000
IDLE = 8  # times as many postings must go unread as are read for a question's light terms to be left out
QUESTION_CELLS = 2_000_000  # questions times different terms that a task may hold as one matrix
MARGIN = 1e-8  # of scores that are compared before they are rounded
SEEDS = 4  # times the number of answers: heaviest postings per term, and first candidates per question, that give the threshold
BLOCK_BYTES = 16 << 20  # components of a block of rows, eight bytes each
QUERY_BYTES = 2 << 20  # and of a block of queries
SCORE_BYTES = 16 << 20  # scores of one step within a pair of blocks


class _Coded:
    """The terms of a batch of token lists as numbers: `row` and `code` of every token, and of every pair if `stop_words` are given.

    A code below the number of different words is a word, any other a pair of words.
    """

    def __init__(self, lists: pa.ListArray, stop_words: Sequence[str] | None):
        flat = lists.flatten().dictionary_encode()
        row, code = pc.list_parent_indices(lists).to_numpy().astype(np.int64), flat.indices.to_numpy().astype(np.int64)
        self.words, n = flat.dictionary, len(flat.dictionary)
        if stop_words is not None:
            stops = pc.is_in(self.words, value_set=pa.array(stop_words, self.words.type)).to_numpy(zero_copy_only=False)
            row, code = row[~stops[code]], code[~stops[code]]
            beside = np.flatnonzero(row[1:] == row[:-1])
            row = np.concatenate([row, row[beside]])
            code = np.concatenate([code, n + code[beside] * n + code[beside + 1]])
        self.row, self.code, self.span = row, code, n * (n + 1) + 1

    def codes(self, terms: Sequence[str]) -> np.ndarray:
        """The code of each term, -1 where the batch has no such word."""
        parts = [t.partition(" ") for t in terms]
        a, b = self._places([p[0] for p in parts]), self._places([p[2] for p in parts])
        single = np.array([not p[1] for p in parts], dtype=bool)
        return np.where(single, a, np.where((a < 0) | (b < 0), -1, len(self.words) * (1 + a) + b))

    def _places(self, words: Sequence[str]) -> np.ndarray:
        found = pc.index_in(pa.array(words, self.words.type), value_set=self.words)
        return pc.fill_null(found, -1).to_numpy().astype(np.int64)

    def counted(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, code and count of each different term of a row, of those marked by `keep`."""
        row, code = (self.row, self.code) if keep is None else (self.row[keep], self.code[keep])
        both, tf = np.unique(row * self.span + code, return_counts=True)
        return both // self.span, both % self.span, tf

    def terms(self, codes: np.ndarray) -> pa.Array:
        """The terms of rising codes."""
        n = len(self.words)
        words, pairs = codes[codes < n], codes[codes >= n] - n
        joined = pc.binary_join_element_wise(self.words.take(pa.array(pairs // max(n, 1))), self.words.take(pa.array(pairs % max(n, 1))), " ")
        return pa.concat_arrays([self.words.take(pa.array(words)), joined])


def term_counts(
    chunks: DataFrame, key: str, text: str, stop_words: Sequence[str] | None = None, known: DataFrame | None = None
) -> DataFrame:
    """Counts `tf` per chunk and term, laid out by chunk; `key` must be unique. Texts do not move, and of the terms, counted
    inside each row, only those in `known (term, idf)`: those are few, and are collected when this is called."""
    table = None if known is None else list(map(tuple, known.select("term", "idf").collect()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if table is not None:
            names, idf = pa.array([t for t, _ in table], pa.string()), np.array([w for _, w in table], dtype=float)
        for batch in batches:
            coded = _Coded(batch.column(1), stop_words)
            if table is None:
                row, code, tf = coded.counted()
                different, at = np.unique(code, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), coded.terms(different).take(pa.array(at)), pa.array(tf)], [key, "term", "tf"]
                )
                continue
            codes = coded.codes([t for t, _ in table])
            order = np.argsort(codes)
            order = order[codes[order] >= 0]
            if len(order):
                place = np.minimum(np.searchsorted(codes[order], coded.code), len(order) - 1)
                row, code, tf = coded.counted(codes[order][place] == coded.code)
                at = order[np.searchsorted(codes[order], code)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), names.take(pa.array(at)), pa.array(idf[at]), pa.array(tf)],
                    [key, "term", "idf", "tf"],
                )

    listed = chunks.select(key, texts.tokens(text).alias("__t"))
    kind = listed.schema[key].dataType.simpleString()
    weight = "" if known is None else "idf double, "
    return listed.mapInArrow(count, f"`{key}` {kind}, term string, {weight}tf bigint").repartition(key)


def fit_terms(chunks: DataFrame, key: str, text: str, max_terms: int = 4096, stop_words: Sequence[str] | None = None) -> DataFrame:
    """The most frequent terms (ties alphabetical) with their inverse document weight."""
    total = chunks.agg(F.count(F.lit(1))).scalar()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = _Coded(batch.column(0), stop_words)
            _row, code, tf = coded.counted()
            different, at, rows = np.unique(code, return_inverse=True, return_counts=True)
            sums = np.bincount(at, weights=tf, minlength=len(different)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([coded.terms(different), pa.array(sums), pa.array(rows)], ["term", "n", "rows"])

    # a row per batch of chunks and different term, summed inside the tasks
    each = chunks.select(texts.tokens(text).alias("__t")).mapInArrow(count, "term string, n bigint, rows bigint")
    terms = each.groupBy("term").agg(F.sum("n").alias("count"), F.sum("rows").alias("df"))
    kept = terms.orderBy(F.desc("count"), "term").limit(max_terms)
    return kept.withColumn("idf", F.ln((1 + total) / (1 + F.col("df"))) + 1)


def term_weights(
    chunks: DataFrame, terms: DataFrame, key: str, text: str, stop_words: Sequence[str] | None = None, sublinear: bool = False
) -> DataFrame:
    """Normalised weights `(key, term, weight)`; a chunk without known terms has no rows. `key` must be unique.

    `terms` holds at most `max_terms` rows, which bounds what each task gets, and the window.
    """
    counts = term_counts(chunks, key, text, stop_words, terms)
    tf = 1 + F.ln(F.col("tf")) if sublinear else F.col("tf")
    raw = counts.select(key, "term", (tf * F.col("idf")).alias("raw"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("raw") / length).alias("weight"))


def _few(df: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """A written table, sent to every task if it is counted to be small; a larger one is joined by a shuffle."""
    kept = cut(df)
    return F.broadcast(kept) if kept.count() <= rows else kept


def _scored(pairs: DataFrame, posts: DataFrame, asked: DataFrame) -> DataFrame:
    """The full score of `pairs (question, chunk)`, from the postings of those chunks alone."""
    own = posts.join(_few(pairs), "chunk").join(_few(asked), ["question", "term"])
    return own.groupBy("question", "chunk").agg(F.round(F.sum(F.col("wq") * F.col("wc")), 9).alias("score"))


def _top(scored: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("question").orderBy(F.desc("score"), "chunk")
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def essential_terms(posts: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """`(question, term, wq, floor, rest)`: the terms of each question that an answer must have one of, out of `asked (question, term, wq)`.

    The heaviest postings of each term give some chunks for every question; the `k`-th best sum over those alone is the `floor`, which
    no answer falls below. Chunks have unit weight vectors, so terms bring a chunk no more than the length of the question's own weights
    on them, nor than the sum of its weights times the heaviest of each term. The lightest terms of a question, as many as cannot reach the floor
    together, can be left out; `rest` is the length of the question's weights on those. They are left out where that saves most of
    the question's postings (`IDLE` times as many as are read); else all terms are essential and `rest` is 0.
    """
    heavy = Window.partitionBy("term").orderBy(F.desc("wc"), "chunk")
    often = posts.groupBy("term").agg(F.count(F.lit(1)).alias("postings"), F.max("wc").alias("heaviest"))
    seeds = posts.withColumn("place", F.row_number().over(heavy)).filter(F.col("place") <= SEEDS * k).drop("place")
    first = _few(seeds).join(asked, "term").groupBy("question", "chunk").agg(F.sum(F.col("wq") * F.col("wc")).alias("score"))
    floors = _top(first, k).groupBy("question").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(0.0).alias("floor"))
    bound = asked.filter("wq > 0").join(often, "term").join(floors, "question")
    upward = Window.partitionBy("question").orderBy("wq", "term").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("question")
    length, parts = F.sqrt(F.sum(F.col("wq") * F.col("wq")).over(upward)), F.sum(F.col("wq") * F.col("heaviest")).over(upward)
    # scores are rounded; the margin keeps what may tie
    bound = bound.withColumn("length", length).withColumn("idle", F.least(length, parts) < F.col("floor") - MARGIN)
    saved, read = (F.coalesce(F.sum(F.when(F.col("idle") == i, F.col("postings"))).over(every), F.lit(0)) for i in (True, False))
    bound = bound.withColumn("idle", F.col("idle") & (saved >= IDLE * read))
    rest = F.coalesce(F.max(F.when(F.col("idle"), F.col("length"))).over(every), F.lit(0.0))
    return bound.withColumn("rest", rest).filter("NOT idle").select("question", "term", "wq", "floor", "rest")


def _scanned(index: DataFrame, asked: DataFrame, k: int, chunk: str) -> DataFrame:
    """The `k` best chunks of each question in each partition of the index: `(question, chunk, score)`.

    The weights of all questions are one small matrix. The postings of a chunk come together as one row, in the partition that the
    weights were made in, and give the chunk's scores with all questions at once, so no pair of question and chunk is ever a row.
    """
    rows = asked.toPandas()
    question_of, names = pd.factorize(rows["question"])
    term_of, terms = pd.factorize(rows["term"])
    matrix = np.zeros((len(terms), len(names)))
    np.add.at(matrix, (term_of, question_of), rows["wq"].to_numpy(dtype=float))
    names = names.to_numpy() if hasattr(names, "to_numpy") else np.asarray(names)
    numbers = index.sparkSession.createDataFrame([(str(t), i) for i, t in enumerate(terms)], "term string, __no int")
    # bounded by QUESTION_CELLS
    posts = index.join(F.broadcast(numbers), "term").select(F.col(chunk).alias("chunk"), F.struct("__no", "weight").alias("__p"))
    # at most one entry per known term
    packed = posts.groupBy("chunk").agg(F.collect_list("__p").alias("__p"))
    packed = packed.select("chunk", F.col("__p.__no").alias("no"), F.col("__p.weight").alias("weight"))

    def run(batches):
        floor = np.full(len(names), -np.inf)
        best = None
        for pdf in batches:
            if not len(pdf):
                continue
            raw = np.stack([w @ matrix[no] for no, w in zip(pdf["no"], pdf["weight"])])
            scores = np.round(raw, 9)
            at, q = np.nonzero((raw > 0) & (scores >= floor))
            if not len(at):
                continue
            found = pd.DataFrame({"question": q, "chunk": pdf["chunk"].to_numpy()[at], "score": scores[at, q]})
            found = found if best is None else pd.concat([best, found])
            best = found.sort_values(["question", "score", "chunk"], ascending=[True, False, True]).groupby("question").head(k)
            full = best.groupby("question")["score"].agg(["size", "min"])
            full = full[full["size"] >= k]
            floor[full.index] = full["min"]
        if best is not None:
            yield best.assign(question=names[best["question"]])

    kinds = dict(packed.dtypes) | dict(asked.dtypes)
    return packed.mapInPandas(run, f"question {kinds['question']}, chunk {kinds['chunk']}, score double")


def search_terms(
    index: DataFrame, questions: DataFrame, k: int = 4, chunk: str = "chunk_id", question: str = "question_id"
) -> DataFrame:
    """The `k` best chunks per question by cosine of term weights: `(question, chunk, score, rank)`.

    Exact for weights that are not negative and chunks of unit length or less, as `term_weights` gives them. As many questions as a task can
    hold are answered in one pass over the chunks (`_scanned`). With more of them, postings of a question's
    lightest terms are not read where that saves much (`essential_terms`). What the others add up to, and the most that the rest could
    add to a unit vector, then leaves few chunks that may reach the threshold, and those are scored in full. The postings are written once
    and each step reads them once, however many questions there are.
    """
    asked = cut(questions.select(F.col(question).alias("question"), "term", F.col("weight").alias("wq")))
    held = asked.agg(F.count_distinct("question").alias("q"), F.count_distinct("term").alias("t"), F.count("question").alias("n")).first()
    if 0 < held["q"] * held["t"] <= QUESTION_CELLS and held["n"] <= QUESTION_CELLS:
        best = _top(_scanned(index, asked.filter("question IS NOT NULL AND wq > 0"), k, chunk), k)
        return best.select(F.col("question").alias(question), F.col("chunk").alias(chunk), "score", "rank")
    posts = cut(index.select("term", F.col(chunk).alias("chunk"), F.col("weight").alias("wc")))
    needed = cut(essential_terms(posts, asked, k))
    # dealt by chunk before they meet the questions, which makes them many more
    met = posts.repartition("chunk").join(_few(needed), "term").groupBy("question", "chunk").agg(
        F.sum(F.col("wq") * F.col("wc")).alias("part"), F.sum(F.col("wc") * F.col("wc")).alias("used"),
        F.first("floor").alias("floor"), F.first("rest").alias("rest"),
    )
    most = F.col("part") + F.col("rest") * F.sqrt(F.greatest(1.0 - F.col("used"), F.lit(0.0)))
    met = met.filter(most >= F.col("floor") - MARGIN)
    if needed.filter("rest > 0").isEmpty():
        scored = met.select("question", "chunk", F.round("part", 9).alias("score"))
    else:
        met = cut(met)
        scored = met.filter("rest = 0").select("question", "chunk", F.round("part", 9).alias("score"))
        scored = scored.unionByName(_scored(met.filter("rest > 0").select("question", "chunk"), posts, asked))
    found = _top(scored, k)
    return found.select(F.col("question").alias(question), F.col("chunk").alias(chunk), "score", "rank")


def pad_results(found: DataFrame, questions: DataFrame, chunks: DataFrame, k: int = 4, chunk: str = "chunk_id", question: str = "question_id") -> DataFrame:
    """Fill up to `k` rows per question with score 0, the way a brute-force scan would.

    Fillers are the first chunks by id that the question did not hit. It can hit at most `k - 1`
    of them, so the first `2k` chunks are enough to choose from.
    """
    firsts = chunks.select(chunk).orderBy(chunk).limit(2 * k)
    pool = firsts.agg(F.sort_array(F.collect_list(chunk)).alias("p")).scalar()
    hits = questions.select(question).distinct().join(
        found.groupBy(question).agg(F.collect_list(chunk).alias("h")), question, "left"
    )
    have = F.coalesce(F.col("h"), F.array().cast("array<string>"))
    filled = hits.withColumn("__pool", pool).select(
        question, F.size(have).alias("__n"),
        F.posexplode(F.slice(F.array_except("__pool", have), F.lit(1), F.lit(k) - F.size(have))).alias("__p", chunk),
    )
    rows = filled.select(question, chunk, F.lit(0.0).alias("score"), (F.col("__n") + F.col("__p") + 1).alias("rank"))
    return found.unionByName(rows)


def _best(scores: np.ndarray, ids: np.ndarray, names: np.ndarray, k: int) -> pd.DataFrame:
    """The `k` best of each row of a score matrix (questions x candidates) in long form, ties to the smaller id."""
    take = min(k, len(ids))
    if not take or not len(names):
        return pd.DataFrame({"question": names[:0], "id": ids[:0], "score": np.zeros(0)})
    # keep all candidates that tie with the k-th, so that ties can be settled by id
    floor = np.partition(scores, len(ids) - take, axis=1)[:, len(ids) - take]
    q, r = np.nonzero(scores >= floor[:, None])
    rows = pd.DataFrame({"question": names[q], "id": ids[r], "score": scores[q, r]})
    return rows.sort_values(["question", "score", "id"], ascending=[True, False, True]).groupby("question").head(k)


def _blocked(df: DataFrame, own: str, other: str, count: int, others: int) -> DataFrame:
    """`df` dealt into `count` blocks by `own`, a copy for each of the other side's blocks."""
    placed = df.withColumn(own, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)).cast("int"))
    return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))


def _merged(near: DataFrame, k: int, question: str, key: str) -> DataFrame:
    order = Window.partitionBy("question").orderBy(F.desc("score"), "id")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("question").alias(question), F.col("id").alias(key), "score", "rank")


def search_vectors(
    vectors: DataFrame, queries: DataFrame, k: int = 4, key: str = "vec_id", vector: str = "embedding", question: str = "question_id"
) -> DataFrame:
    """Exact `k` nearest rows per query by inner product of unit vectors.

    Rows and queries are dealt into blocks of bounded bytes. Each pair of blocks is one task, which multiplies the two and keeps the
    best `k` per query, a few queries (`SCORE_BYTES`) at a time: the full score table never exists, and neither side passes through the driver. Null vectors take no part.
    """
    units = cut(vectors.select(F.col(key).alias("id"), normalised(vector).alias("v")).filter("id IS NOT NULL AND v IS NOT NULL"))
    asked = cut(queries.select(F.col(question).alias("question"), normalised(vector).alias("v")).filter("v IS NOT NULL"))
    kinds = dict(units.dtypes) | dict(asked.dtypes)
    size = lambda df: 8 * (df.agg(F.sum(F.size("v")).alias("n")).first()["n"] or 0)
    row_blocks, query_blocks = max(1, -(-size(units) // BLOCK_BYTES)), max(1, -(-size(asked) // QUERY_BYTES))

    def run(rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(block):
            return pd.DataFrame({"question": block["question"][:0], "id": rows["id"][:0], "score": np.zeros(0)})
        own, other = np.stack(block["v"].to_numpy()), np.stack(rows["v"].to_numpy()).T
        ids, names = rows["id"].to_numpy(), block["question"].to_numpy()
        step = max(1, SCORE_BYTES // (8 * len(rows)))
        return pd.concat([_best(own[i : i + step] @ other, ids, names[i : i + step], k) for i in range(0, len(names), step)])

    tasks = row_blocks * query_blocks
    left = _blocked(units, "rb", "qb", row_blocks, query_blocks).repartition(tasks, "rb", "qb").groupBy("rb", "qb")
    right = _blocked(asked, "qb", "rb", query_blocks, row_blocks).repartition(tasks, "rb", "qb").groupBy("rb", "qb")
    near = left.cogroup(right).applyInPandas(run, f"question {kinds['question']}, id {kinds['id']}, score double")
    return _merged(near, k, question, key)


def source_rows(found: DataFrame, chunks: DataFrame, chunk: str = "chunk_id") -> DataFrame:
    """Results with score to 4 places and an excerpt of 200 characters."""
    return found.join(chunks.select(chunk, F.col("text")), chunk).select(
        "question_id", "rank", chunk, F.round("score", 4).alias("score"), F.substring("text", 1, 200).alias("excerpt")
    )


def relevance_gate(
    found: DataFrame, questions: DataFrame, threshold: float = 0.15, chunk: str = "chunk_id", chunks: DataFrame | None = None,
    document: str = "doc_id",
) -> DataFrame:
    """Per question: answered or declined by the best score, and the citations in rank order.

    With `chunks` (as `window_chunks` makes them) a citation also names document, section and title.
    """
    fields = [F.col("rank"), F.col(chunk).alias("chunk")]
    if chunks is not None:
        names = [F.col(document).cast("string").alias("document"), F.col("section_number").alias("section"), F.col("title")]
        found = found.join(chunks.select(chunk, *names), chunk)
        fields += [F.col("document"), F.col("section"), F.col("title")]
    # at most `k` citations per question
    cites = found.groupBy("question_id").agg(
        F.max("score").alias("best"),
        F.sort_array(F.collect_list(F.struct(*fields, F.round("score", 3).alias("score")))).alias("citations"),
    )
    joined = questions.select("question_id").distinct().join(cites, "question_id", "left")
    ok = F.coalesce(F.col("best") >= threshold, F.lit(False))
    return joined.select(
        "question_id", ok.alias("success"), "best",
        F.when(ok, F.col("citations")).alias("citations"),
        F.when(~ok, "No document appears to address this question.").alias("error"),
    )


def _collected(found: DataFrame, chunks: DataFrame, fields: Sequence[str], chunk: str) -> DataFrame:
    """Chunk fields per question in rank order; at most `k` per question."""
    rows = found.join(chunks.select(chunk, *fields), chunk)
    return rows.groupBy("question_id").agg(F.sort_array(F.collect_list(F.struct("rank", *fields))).alias("hits"))


def numbered_context(found: DataFrame, chunks: DataFrame, questions: DataFrame, chunk: str = "chunk_id") -> DataFrame:
    """Prompt text with numbered excerpts and the question."""
    hits = _collected(found, chunks, ["text"], chunk)
    blocks_ = F.transform(
        "hits", lambda h, i: F.concat(F.lit("[Excerpt "), (i + 1).cast("string"), F.lit("]\n"), h["text"])
    )
    context = F.array_join(blocks_, "\n\n---\n\n")
    text = F.concat(
        F.lit("Context from the document:\n\n"), context, F.lit("\n\n---\n\nQuestion: "), F.col("question"),
        F.lit("\n\nAnswer using only the context above:"),
    )
    return hits.join(questions.select("question_id", "question"), "question_id").select("question_id", text.alias("prompt"))


def labelled_context(found: DataFrame, chunks: DataFrame, chunk: str = "chunk_id") -> DataFrame:
    """Context text whose excerpts carry document and section titles."""
    hits = _collected(found, chunks, ["text", "title", "section_number", "section_title"], chunk)
    label = lambda h: F.concat(
        h["title"], F.coalesce(F.concat(F.lit(" — Section "), h["section_number"], F.lit(": "), h["section_title"]), F.lit(""))
    )
    parts = F.transform("hits", lambda h: F.concat(F.lit("["), label(h), F.lit("]\n"), h["text"]))
    return hits.select("question_id", F.array_join(parts, "\n\n---\n\n").alias("context"))


def scored_sentences(
    found: DataFrame, chunks: DataFrame, questions: DataFrame, stop_words: Sequence[str] = texts.STOP_WORDS, chunk: str = "chunk_id"
) -> DataFrame:
    """Sentences of the found chunks with the number of distinct words shared with the question."""
    asked = questions.select(
        "question_id",
        F.filter(F.array_distinct(texts.tokens("question", texts.WORD)), lambda w: ~w.isin(list(stop_words))).alias("__q"),
    )
    rows = found.select("question_id", "rank", chunk).join(chunks.select(chunk, "text"), chunk).join(asked, "question_id")
    split = rows.select("question_id", "rank", "__q", F.posexplode(F.split("text", texts.SENTENCE_GAP)).alias("pos", "sentence"))
    shared = F.size(F.array_intersect(texts.tokens("sentence", texts.WORD), "__q"))
    return split.select("question_id", "rank", "pos", texts.strip("sentence").alias("sentence"), shared.alias("overlap")).filter(
        F.col("overlap") > 0
    )


def extractive_answers(
    found: DataFrame, chunks: DataFrame, questions: DataFrame, best: int = 3, stop_words: Sequence[str] = texts.STOP_WORDS,
    chunk: str = "chunk_id",
) -> DataFrame:
    """The sentences that share most words with the question, joined; else an excerpt of the best chunk."""
    scored = scored_sentences(found, chunks, questions, stop_words, chunk)
    order = Window.partitionBy("question_id").orderBy(F.desc("overlap"), "rank", "pos")
    top = scored.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= best)
    joined = top.groupBy("question_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__r", "sentence"))), lambda s: s["sentence"]), " ").alias("answer")
    )
    first = found.filter(F.col("rank") == 1).join(chunks.select(chunk, "text"), chunk).select("question_id", F.substring("text", 1, 400).alias("__f"))
    fallback = F.concat(
        F.lit("I couldn't find a direct answer in the retrieved context. Here's the most relevant excerpt I found:\n\n"), "__f"
    )
    nothing = F.lit("I don't have enough information in the document to answer that.")
    return (
        questions.select("question_id")
        .join(joined, "question_id", "left")
        .join(first, "question_id", "left")
        .select("question_id", F.coalesce("answer", fallback, nothing).alias("answer"))
    )


def verbatim_answers(found: DataFrame, chunks: DataFrame, chunk: str = "chunk_id") -> DataFrame:
    """The best chunk under a label naming its source, without the header line."""
    top = found.filter(F.col("rank") == 1).join(chunks, chunk)
    label = F.concat(
        "title", F.coalesce(F.concat(F.lit(", Section "), "section_number", F.lit(" ("), "section_title", F.lit(")")), F.lit(""))
    )
    at = F.locate("]\n", F.col("text"))
    body = F.when(at > 0, F.substring(F.col("text"), at + 2, F.length("text"))).otherwise(F.col("text"))
    return top.select("question_id", F.concat(F.lit("From "), label, F.lit(":\n\n"), body).alias("answer"))


