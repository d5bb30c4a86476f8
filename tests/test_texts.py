"""Text, retrieval and question operators against plain Python."""

from __future__ import annotations

import random

import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.functions import texts
from tidemill.operators import vectors
from tidemill.operators import questions as ask
from tidemill.operators import retrieval, text


def col(spark, value, expr):
    return spark.createDataFrame([(value,)], "t string").select(expr).first()[0]


def py_sentences(t):
    out = []
    for line in (x.strip() for x in t.split("\n")):
        out += [s.strip() for s in re.split(r"(?<=[.!?])\s+", line) if s.strip()]
    return out


def py_pack(sents, size, overlap):
    chunks, current = [], []
    for s in sents:
        if current and sum(map(len, current)) + len(s) > size:
            chunks.append(current)
            keep, used = [], 0
            while len(keep) < len(current) and used + len(current[-1 - len(keep)]) <= overlap:
                used += len(current[-1 - len(keep)])
                keep = [current[-1 - len(keep)], *keep]
            current = keep
        current = [*current, s]
    return [" ".join(c) for c in ([*chunks, current] if current else chunks)]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab.! \nÉ", max_size=60), min_size=1, max_size=6), st.integers(5, 40), st.integers(0, 20))
def test_sentence_packing(spark, docs, size, overlap):
    df = spark.createDataFrame(list(enumerate(docs)), "id int, t string")
    rows = text.sentence_chunks(df, "id", "t", size, overlap).orderBy("id", "chunk_index").collect()
    want = [(i, j, c) for i, d in enumerate(docs) for j, c in enumerate(py_pack(py_sentences(d), size, overlap))]
    assert [(r["id"], r["chunk_index"], r["text"]) for r in rows] == want


def test_keywords_and_cleanup(spark):
    assert col(spark, "Machine LEARNING models learn Patterns machine", texts.keywords("t")) == ["learn", "learning", "machine", "models", "patterns"]
    assert col(spark, "  a \r\n\n \t b c ", texts.clean_lines("t")) == "a\nb\nc"


def test_tokens_keep_accents_and_pair_after_stop_words(spark):
    assert col(spark, "L'été était à Zürich", texts.tokens("t")) == ["été", "était", "zürich"]
    assert col(spark, "the cat of the house", texts.tokens_and_bigrams("t")) == ["cat", "house", "cat house"]


def test_vocabulary_order(spark):
    df = spark.createDataFrame([(1, "Beta, alpha! beta"), (2, "gamma alpha")], "id int, t string")
    assert [(r["word"], r["index"]) for r in text.vocabulary(df, "id", "t").orderBy("index").collect()] == [("beta", 1), ("alpha", 2), ("gamma", 3)]


def test_prefixes_are_left_padded(spark):
    lines = spark.createDataFrame([(1, 0, [5, 6, 7]), (1, 1, [8]), (2, 0, [9, 4])], "id int, line int, tokens array<bigint>")
    rows = text.prefix_sequences(lines, "id").orderBy("id", "line", "length").collect()
    assert [(r["x"], r["y"]) for r in rows] == [([0, 5], 6), ([5, 6], 7), ([0, 9], 4)]


def test_continuation_stops_without_follower(spark):
    docs = spark.createDataFrame([("deep learning is fun",), ("deep learning is hard",), ("learning is fun",)], "t string")
    model = text.next_words(docs, "t")
    seeds = spark.createDataFrame([(1, "Deep"), (2, "unknown")], "id int, s string")
    got = {r["id"]: r["generated"] for r in text.continue_texts(seeds, model, "s", 5).collect()}
    assert got == {1: "Deep learning is fun", 2: "unknown"}


def test_sections_drop_preamble(spark):
    t = "# Title\nintro\n## 1. Hours \nNine to five.\n\n## 2. Rules\nBe kind.\n"
    df = spark.createDataFrame([("d", t, "Title")], "id string, t string, title string")
    rows = text.sections(df, "id", "t", "title").collect()
    assert [(r["section_number"], r["section_title"], r["body"]) for r in rows] == [("1", "Hours", "Nine to five."), ("2", "Rules", "Be kind.")]


@pytest.mark.parametrize("length", [0, 1, 800, 801, 1480, 1481, 5000])
def test_windows_reach_the_end(spark, length):
    body = "".join(chr(97 + i % 26) for i in range(length))
    want, start = [], 0
    while True:
        want.append(start)
        if start + 800 >= length:
            break
        start += 680
    assert col(spark, body, text.windows(F.col("t"), 800, 120)) == want


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [
        ("c1", "Visitors may come from nine to five. Children need a guardian."),
        ("c2", "Surgery needs a signed consent form. Do not eat before surgery."),
        ("c3", "Invoices are sent monthly. Payment plans exist."),
    ]
    return spark.createDataFrame(rows, "chunk_id string, text string")


@pytest.fixture(scope="module")
def asked(spark):
    rows = [(1, "When may visitors come?"), (2, "What is needed before surgery?"), (3, "Capital of France")]
    return spark.createDataFrame(rows, "question_id int, question string")


def found_for(corpus, asked, k=2):
    terms = retrieval.fit_terms(corpus, "chunk_id", "text")
    index = retrieval.term_weights(corpus, terms, "chunk_id", "text")
    return retrieval.search_terms(index, retrieval.term_weights(asked, terms, "question_id", "question"), k)


def test_search_gate_and_answers(corpus, asked):
    found = found_for(corpus, asked)
    best = {r["question_id"]: r["chunk_id"] for r in found.filter("rank = 1").collect()}
    assert best[1] == "c1" and best[2] == "c2"
    gate = {r["question_id"]: r for r in retrieval.relevance_gate(found, asked).collect()}
    assert gate[1]["success"] and not gate[3]["success"] and gate[3]["error"]
    answers = {r["question_id"]: r["answer"] for r in retrieval.extractive_answers(found, corpus, asked).collect()}
    assert answers[1] == "Visitors may come from nine to five."
    assert answers[3].startswith("I don't have enough")


@pytest.mark.parametrize("stop", [None, ("of", "the")])
def test_terms_are_counted_as_numbers(spark, stop):
    from collections import Counter

    rows = [(1, "The cat of the house, the CAT of the cat"), (2, None), (3, "the of"), (4, "house cat house"), (5, "élan")]
    df = spark.createDataFrame(rows, "id long, t string").repartition(2)

    def terms(t):
        kept = [w for w in (t or "").lower().replace(",", "").split() if w not in (stop or ())]
        return Counter(kept if stop is None else kept + [f"{a} {b}" for a, b in zip(kept, kept[1:])])

    want = {(i, w): n for i, t in rows for w, n in terms(t).items()}
    counted = retrieval.term_counts(df, "id", "t", stop)
    assert {(r["id"], r["term"]): r["tf"] for r in counted.collect()} == want
    # tokens leave Spark's expressions as they are: no sorting and no pairs in functions on arrays
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array" not in plan and "zip_with" not in plan
    fitted = retrieval.fit_terms(df, "id", "t", 4, stop)
    totals = sum((terms(t) for _, t in rows), Counter())
    best = sorted(totals.items(), key=lambda e: (-e[1], e[0]))[:4]
    assert [(r["term"], r["count"]) for r in fitted.orderBy(F.desc("count"), "term").collect()] == best
    assert {r["term"]: r["df"] for r in fitted.collect()} == {w: sum(w in terms(t) for _, t in rows) for w, _ in best}
    known = spark.createDataFrame([("cat house", 2.0), ("cat", 1.0), ("unknown cat", 3.0), ("dog", 4.0)], "term string, idf double")
    some = {(r["id"], r["term"]): (r["idf"], r["tf"]) for r in retrieval.term_counts(df, "id", "t", stop, known).collect()}
    idf = {"cat house": 2.0, "cat": 1.0}
    assert some == {(i, w): (idf[w], n) for (i, w), n in want.items() if w in idf}


def test_question_blocks_give_the_same_result(corpus, asked, monkeypatch):
    whole = sorted(map(tuple, found_for(corpus, asked).collect()))
    monkeypatch.setattr(retrieval, "BLOCK_ROWS", 2)
    assert sorted(map(tuple, found_for(corpus, asked).collect())) == whole


def test_dense_search_in_blocks_with_ties(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(40, 5)), np.repeat(rng.normal(size=(1, 5)), 6, axis=0)])
    df = spark.createDataFrame([(i, [float(a) for a in r]) for i, r in enumerate(x)], "vec_id int, embedding array<double>").repartition(4)
    q = df.select(F.col("vec_id").alias("question_id"), "embedding")
    monkeypatch.setattr(retrieval, "BLOCK_BYTES", 300)
    monkeypatch.setattr(retrieval, "QUERY_BYTES", 200)
    got = {(r["question_id"], r["rank"]): r["vec_id"] for r in retrieval.search_vectors(df, q, 3).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 12)
    for i in range(len(x)):
        want = sorted(range(len(x)), key=lambda j: (-s[i, j], j))[:3]
        assert {got[(i, r)] for r in (1, 2, 3)} == set(want) or i >= 40


def test_tool_route(spark):
    rows = [("Calculate 2 + 3",), ("Keywords From Large Language models",), ("hello",), ("keyword from tiny words here please",)]
    df = spark.createDataFrame(rows, "q string")
    strict = [(r["type"], r["result"]) for r in ask.tool_route(df, "q").collect()]
    assert strict[0] == ("calculation", "2 + 3") and strict[1] == ("keywords", "language, large, models")
    assert strict[2][0] == "general" and strict[3] == ("keywords", "please, words")
    loose = [r["type"] for r in ask.tool_route(df, "q", strict=False).collect()]
    assert loose == ["calculation", "error", "general", "keywords"]


def test_source_route(spark):
    rows = [("How many diabetic patients?",), ("Visiting hours of the ICU",), ("average stay and discharge process",), ("Sing a song",)]
    got = [r["route"] for r in ask.source_route(spark.createDataFrame(rows, "q string"), "q").collect()]
    assert got == ["sql", "rag", "hybrid", "clarify"]


def test_slots_strict_and_loose(spark):
    rows = [("Show abnormal asthmatic patients older than 60",), ("How many Emergency admissions?",), ("Patients of Dr. sharma this week",)]
    df = spark.createDataFrame(rows, "q string")
    a, b, c = ask.extract_slots(df, "q").collect()
    assert (a["condition"], a["result"], a["older"], a["template"]) == ("Asthma", "Abnormal", 60, "list")
    assert (b["admission_type"], b["template"]) == ("Emergency", "count")
    assert (c["doctor"], c["week"], c["template"]) == ("Sharma", True, "doctor")
    assert ask.extract_slots(df, "q", strict=False).first()["result"] == "Normal"


def test_names_containing_fragments(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abAB é#") for _ in range(n))
    names = [word(rng.randint(0, 12)) for _ in range(120)] + ["Ann Sharma", "Bo SHARMAJI", None, "", "Ann Sharma", "x" * 5000]
    frags = [word(rng.randint(1, 5)) for _ in range(60)] + ["Sharma", "sharma", "Lee", "", None, "x" * 40, "é", "#"]
    got = ask.matching_fragments(
        spark.createDataFrame([(n, 1) for n in names], "name string, gram int"), "name",
        spark.createDataFrame([(f, 2) for f in frags], "doctor string, __low int"), "doctor",
    ).collect()
    want = {(n, f) for n in names for f in frags if n and f and f.lower() in n.lower()}
    assert len(got) == len(want) and {tuple(r) for r in got} == want and len(want) > 100
    none = spark.createDataFrame([], "doctor string")
    assert ask.matching_fragments(spark.createDataFrame([("a",)], "name string"), "name", none, "doctor").count() == 0


def test_next_words_splits_each_line_once(spark, capsys):
    docs = spark.createDataFrame([("A b. a-b\nb\n\na c, a",), (None,), ("",)], "text string")
    model = text.next_words(docs, "text")
    model.explain()
    assert capsys.readouterr().out.count("lower(") == 1
    assert {r["word"]: r["next"] for r in model.collect()} == {"a": "b", "b": "a", "c": "a"}


def test_questions_of_one_filter_set_are_dealt_to_many_tasks(spark):
    asked = spark.range(400).select("id", F.lit("list").alias("template"), F.when(F.col("id") < 390, "hot").otherwise("rare").alias("combo"))
    found = spark.createDataFrame([("hot", 1), ("hot", 2), ("rare", 3), ("unasked", 4)], "combo string, admission_id long")
    dealt = ask._dealt(asked, found, "id", per_key=10).select("id", "admission_id", F.spark_partition_id().alias("task"))
    rows = dealt.collect()
    assert sorted((r["id"], r["admission_id"]) for r in rows) == sorted([(i, n) for i in range(390) for n in (1, 2)] + [(i, 3) for i in range(390, 400)])
    assert len({r["task"] for r in rows}) == 4  # all shuffle partitions of the test session


@pytest.mark.parametrize("cell_rows", [20_000, 7])
def test_approximate_search_against_the_exact_one(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(vectors, "CELL_ROWS", cell_rows)
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    q = e.select(F.col("vec_id").alias("question_id"), "embedding")
    exact = {(r["question_id"], r["vec_id"]): r["score"] for r in retrieval.search_vectors(e, q, 4).collect()}
    index = vectors.build_index(e)
    got = {(r["question_id"], r["vec_id"]): r["score"] for r in vectors.search_index(index, q, 4).collect()}
    assert len(got) == len(exact)
    assert len(set(got) & set(exact)) / len(exact) >= 0.9
    assert all(abs(exact[p] - s) < 1e-9 for p, s in got.items() if p in exact)
    # all cells and every candidate scored again: the exact answer
    whole = vectors.search_index(index, q.filter("question_id < 20"), 4, probe=100, refine=200).collect()
    assert {(r["question_id"], r["vec_id"]) for r in whole} == {p for p in exact if p[0] < 20}


def test_index_of_few_and_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None), (None, [1.0, 1.0]), (4, [1.0, 0.0]), (4, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = spark.createDataFrame([(7, [2.0, 0.1]), (8, None)], "question_id long, embedding array<double>")
    got = vectors.search_index(vectors.build_index(df), q, 2).collect()
    assert sorted((r["question_id"], r["rank"], r["vec_id"]) for r in got) == [(7, 1, 1), (7, 2, 4)]
    assert vectors.search_index(vectors.build_index(df.limit(0)), q, 2).count() == 0
    assert vectors.search_index(vectors.build_index(df), q.limit(0), 2).count() == 0


@pytest.mark.parametrize("idle", [0, 2, 10**9])
def test_pruned_search_is_exact_and_reads_fewer_postings(spark, monkeypatch, idle):
    monkeypatch.setattr(retrieval, "IDLE", idle)
    rng = random.Random(9)
    chunks = {}
    for i in range(400):
        weights = {"the": rng.uniform(0.05, 0.2), "and": rng.uniform(0.05, 0.2), **{f"t{rng.randrange(60)}": rng.uniform(0.2, 1) for _ in range(6)}}
        if i % 25 == 0:
            weights = {"the": 0.1, f"rare{i // 50}": 1.0}
        if i in (7, 8, 9):
            weights = {"the": 0.3, "and": 0.3}  # equal scores
        length = sum(w * w for w in weights.values()) ** 0.5
        chunks[f"c{i:03}"] = {t: w / length for t, w in weights.items()}
    asked = {q: {f"rare{q}": 0.95, "the": 0.2, "and": 0.2} for q in range(6)} | {6: {"the": 1.0}, 7: {f"t{j}": 0.3 for j in range(12)}, 8: {"none": 1.0}}
    index = spark.createDataFrame([(c, t, w) for c, ws in chunks.items() for t, w in ws.items()], "chunk_id string, term string, weight double")
    questions = spark.createDataFrame([(q, t, w) for q, ws in asked.items() for t, w in ws.items()], "question_id int, term string, weight double")
    want = {}
    for q, ws in asked.items():
        scores = [(-round(sum(w * c.get(t, 0.0) for t, w in ws.items()), 9), n) for n, c in chunks.items()]
        want[q] = [(n, r + 1) for r, (s, n) in enumerate(sorted(x for x in scores if x[0] < 0)[:2])]
    got = {q: [] for q in asked}
    for r in retrieval.search_terms(index, questions, 2).orderBy("question_id", "rank").collect():
        got[r["question_id"]].append((r["chunk_id"], r["rank"]))
    assert got == want
    posts = index.selectExpr("term", "chunk_id AS chunk", "weight AS wc")
    all_terms = questions.selectExpr("question_id AS question", "term", "weight AS wq")
    read = posts.join(retrieval.essential_terms(posts, all_terms, 2), "term").count()
    every = posts.join(all_terms, "term").count()
    assert read == every if idle == 10**9 else read < every / 2
    assert retrieval.search_terms(index.limit(0), questions, 2).count() == 0
    assert retrieval.search_terms(index, questions.limit(0), 2).count() == 0


@pytest.mark.parametrize("cells", [0, 2_000_000])
def test_search_of_few_and_many_questions_agrees(spark, monkeypatch, cells):
    monkeypatch.setattr(retrieval, "QUESTION_CELLS", cells)
    index = spark.createDataFrame([(f"c{i:03}", t, 0.6 if t == "a" else 0.8 / (1 + i % 3)) for i in range(90) for t in "ab"], "chunk_id string, term string, weight double")
    questions = spark.createDataFrame([("x", "a", 1.0), ("y", "b", 1.0), ("z", "none", 1.0)], "question_id string, term string, weight double")
    found = retrieval.search_terms(index, questions, 3)
    got = sorted((r["question_id"], r["rank"], r["chunk_id"], r["score"]) for r in found.collect())
    assert got == [(q, i + 1, f"c{c:03}", s) for q, cs, s in (("x", (0, 1, 2), 0.6), ("y", (0, 3, 6), 0.8)) for i, c in enumerate(cs)]
    # a pair of question and chunk is a row only where many questions are asked
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert ("MapInPandas" in plan) == (cells > 0)


def test_dense_search_scores_a_few_queries_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "SCORE_BYTES", 8 * 40 * 3)
    rng = np.random.default_rng(4)
    v = rng.normal(size=(40, 5))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = np.argsort(-(unit @ unit.T), axis=1)[:, :3]
    found = retrieval.search_vectors(df, df.withColumnRenamed("vec_id", "question_id"), 3).collect()
    assert {(r["question_id"], r["rank"]): r["vec_id"] for r in found} == {(i, j + 1): want[i, j] for i in range(40) for j in range(3)}
