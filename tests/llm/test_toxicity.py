"""Toxicity: features against plain counting, held-out accuracy, disguised words, odd input."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest

from tidemill.llm import queries, toxicity

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.train_toxicity(spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet"))


def test_held_out(spark):
    rows = queries.QUERIES["op13_toxicity"](spark, DATA)
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    assert rows.count() == docs.count()
    both = rows.join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in both)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in both)
    held = [r for r in both if r["held_out"]]
    # labels also mark texts without any insult; those with one must be found, and clean ones left alone
    insults = re.compile(r"\b(" + "|".join(toxicity.INSULTS) + r")\b", re.I)
    open_ones = [r for r in held if r["toxic"] and insults.search(r["text"] or "")]
    assert len(open_ones) > 50 and np.mean([r["predicted"] for r in open_ones]) > 0.98
    assert np.mean([r["predicted"] for r in held if not r["toxic"]]) < 0.005
    toxic, clean = (np.array([r["score"] for r in held if r["toxic"] == v]) for v in (1, 0))
    assert np.mean([(v > clean).mean() + 0.5 * (v == clean).mean() for v in toxic]) > 0.85


def test_disguises(spark, model):
    cases = [
        (1, "you are such an 1d.i*0t, go away"), (2, "what l o s e r you are"), (3, "stuuuupid people like you"),
        (4, "YOU PATHETIC CLOWN"), (5, "Is the weather nice over there, " * 10), (6, None), (7, ""), (8, "?!*# 12"),
    ]
    df = spark.createDataFrame(cases, "doc_id long, text string").selectExpr("*", "1 AS label", "2 AS raw", "'f' AS features", "0 AS score")
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(df, model).collect()}
    assert len(got) == 8 and all(got[i] >= 0.7 for i in (1, 2, 3, 4)) and all(got[i] < 0.3 for i in (5, 6, 7, 8))
    assert got[6] == got[7]
    assert toxicity.fold(b"1d.i*0t idiooot i d i o t Looser! sh!t\nok a b") == b"idiot idiot idiot looser  shit\nok a b"
    assert toxicity.score_toxicity(df.limit(0), model).collect() == []


def test_features_equal_plain_counting(spark, model):
    lex = toxicity.Lexicon(toxicity._hashes(["moron", "clown"]), toxicity._hashes(["zork"]), np.array([2.5]), toxicity._hashes(["you"]))
    text = "You MORON! zork zork, a b cl0wn and fourteen words far from it all here you see? x1y"
    row = dict(zip(toxicity.FEATURES, toxicity.dense_features([b"", text.encode(), b"you", b"moron"], lex)[1]))
    words = text.split()
    letters = sum(c.isalpha() for c in text)
    assert row["words"] == len(words) and row["insults"] == 2 and row["disguised"] == 1
    assert row["learnt_most"] == 2.5 and row["learnt_weight"] == pytest.approx(5.0 / len(words))
    assert row["second_person_rate"] == pytest.approx(2 / len(words))
    assert row["near"] == 3  # moron and both zorks; the pronouns of other texts are out of reach
    assert row["capital_rate"] == pytest.approx(6 / letters) and row["shouted_rate"] == pytest.approx(1 / len(words))
    assert row["exclamation_rate"] == pytest.approx(1 / len(text)) and row["question_rate"] == pytest.approx(1 / len(text))
    assert row["symbol_rate"] == pytest.approx(3 / len(text)) and row["mixed_rate"] == pytest.approx(2 / len(words))
    long = ("clean words here " * 300_000 + "you moron").encode()
    found = dict(zip(toxicity.FEATURES, toxicity.dense_features([long], lex)[0]))
    assert found["insults"] == 1 and found["near"] == 1 and found["words"] == 900_002


def test_gaps():
    assert toxicity._gap_to_nearest(np.array([0, 5, 9]), np.array([4, 7])).tolist() == [4, 1, 2]
    assert (toxicity._gap_to_nearest(np.array([3]), np.array([], dtype=np.int64)) > 1 << 60).all()


def test_labels_of_one_kind_or_none(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(12)] + [(None, None)], "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, none)).collect()} == {0.0}
    toxic = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, toxic int")
    scored = toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, toxic)).collect()
    assert len(scored) == 13 and {r["score"] for r in scored} == {1.0}


def test_same_model_again(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    score = lambda d: sorted(tuple(r) for r in toxicity.score_toxicity(docs, toxicity.train_toxicity(d, labels)).collect())
    assert score(docs) == score(docs.repartition(7))
