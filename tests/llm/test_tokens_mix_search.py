"""Byte-level BPE against the rank file, the source mix, exact search, and the pipeline stage by stage."""

from __future__ import annotations

import base64
import hashlib
import math
import random
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.harness import duck
from tests.llm.test_dedup import exact_brute, near_brute
from tidemill.llm import bpe, mixing, queries, topk


@pytest.fixture(scope="module")
def ranks():
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def odd_texts(n=400):
    rng = random.Random(4)
    letters = [chr(i) for i in [*range(0, 0x250), 0x2028, 0x3000, 0x4E2D, 0x1F600, 0x10FFFF, 0x17F, 0x200B]] + list(" \n'sdmre") * 40
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(n)]
    return [*texts, "<|endoftext|>", "it's we'll THEY'RE 'd''s", "   \n\n  x", "a" * 3000, " " * 5000, "", None]


def digests(text, ranks):
    ids = ranks.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("step", [bpe.STEP, 9])
def test_pieces_match_the_rank_file(ranks, step, monkeypatch):
    monkeypatch.setattr(bpe, "STEP", step)
    codec = bpe.Codec(public_tokenizers.path("byte_bpe_50k.json"))
    for t in odd_texts():
        ids = codec.encode(t or "").tolist()
        assert ids == ranks.encode_ordinary(t or "")
        assert codec.decode(ids) == (t or "").encode()


def test_round_trip_and_offsets(spark, ranks):
    rows = [*enumerate(odd_texts()), (None, "x"), (3, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = bpe.round_trip(df, queries.vocabulary()).collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *digests(t, ranks)) for i, t in rows)
    coded = bpe.encode(df.filter("doc_id < 50"), queries.vocabulary())
    for r in bpe.decode(coded, queries.vocabulary()).collect():
        text = r["text"] or ""
        assert bytes(r["decoded"]) == text.encode()
        assert all(s < e <= len(text) for s, e in zip(r["starts"], r["ends"]))
        assert "".join(text[s:e] for s, e in zip(r["starts"][:1], r["ends"][:1])) == text[: r["ends"][0] if r["ends"] else 0]


def mix_rows():
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randint(0, 90)), rng.choice(["a", "a", "a", "b", "é", None, "Z"])) for i in range(600)]
    rows += [(5, rows[5][1], rows[5][2]), (None, "x y", "a"), (700, None, "b"), (701, "solo", "tiny"), (702, "", "void")]
    return rows


def test_mix_follows_its_schedule(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS", 4000)  # blocks of several words
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS start")
    documents, slices = mixing.mix(df)
    got, parts = documents.collect(), slices.collect()
    assert len(got) == len(rows)
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    goals = {r["source"]: (r["target"], r["source_size"]) for r in got}
    length = mixing.block_length(sum(t for t, _ in goals.values()))
    assert length > 1
    for s, (target, size) in goals.items():
        own = [p for p in parts if p["source"] == s]
        words = sum(p["words"] for p in own)
        assert sum(r["taken"] for r in got if r["source"] == s) == words <= 2 * size
        assert abs(words - target) <= mixing.ERROR * length
        # every block but a last one that the stream cuts short has the same length, and blocks follow the slots' order
        blocks = Counter()
        for p in own:
            blocks[p["slot"]] += p["words"]
        in_order = [blocks[j] for j in sorted(blocks)]
        assert all(n == length for n in in_order[:-1]) and all(0 < n <= length for n in in_order[-1:])
        order = [p["first"] for p in sorted(own, key=lambda p: (p["slot"], p["first"]))]
        assert order == sorted(order)
    again = mixing.mix(df.repartition(5))[0].collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert mixing.mix(df.limit(0))[0].count() == 0
    # what is taken comes through the schedule: another sequence of points gives other numbers
    other = mixing.mix(df, step=1 << 20)[0].collect()
    assert Counter(map(tuple, got)) != Counter(map(tuple, other))


def test_schedule_is_spread_evenly(spark):
    targets = spark.createDataFrame([(0, 50.0), (1, 30.0), (2, 20.0), (3, 0.0)], "source_no int, target double")
    for scale in (1, 655.36, 10_000):
        goal = targets.withColumn("target", F.col("target") * scale)
        found, length = mixing.schedule(goal)
        slots = found.orderBy("slot").collect()
        n = int(100 * scale / length)
        assert length == max(1, min(256, int(100 * scale / mixing.SLOTS))) and [r["slot"] for r in slots] == [*range(n)]
        for share, no in ((0.5, 0), (0.3, 1), (0.2, 2)):
            seen = 0
            for r in slots:
                seen += r["source_no"] == no
                assert abs(seen - share * (r["slot"] + 1)) < mixing.ERROR
            assert [r["nth"] for r in slots if r["source_no"] == no] == [*range(seen)]


def test_points_do_not_overflow(spark):
    slots = [0, 1, 65_535, 65_536, (1 << 31) + 7, (1 << 32) - 1, (1 << 32) + 3, 10**12]
    df = spark.createDataFrame([(j,) for j in slots], "slot long").select("slot", mixing.points(F.col("slot"), mixing.GOLDEN).alias("p"))
    assert {r["slot"]: r["p"] for r in df.collect()} == {j: j * mixing.GOLDEN % (1 << 32) for j in slots}


def test_rows_come_in_the_order_of_the_schedule_and_equal_ones_as_often_as_taken(spark):
    two = spark.createDataFrame([(1, "a b c", "s", "y"), (1, "a b c", "s", "x")], "doc_id long, text string, source string, row string")
    # 9 words are asked for: one and a half times six
    assert sorted(r["row"] for r in mixing.repeat_by_mix(two).collect()) == ["x"] * 3
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "doc_id AS slot", "1 AS place", "2 AS key")
    _, slices = mixing.mix(df)
    want = {}
    for r in mixing.copies(slices).collect():
        want.setdefault(r["place"], []).append(r["slot"])
    mixed = mixing.repeat_by_mix(df)
    assert mixed.columns == df.columns
    got = mixed.select("doc_id", mixing.shuffle_key().alias("p")).collect()
    assert Counter(r["p"] for r in got) == Counter({p: len(s) for p, s in want.items()})
    seen, turn = {}, Counter()
    for i, r in enumerate(got):
        slot = sorted(want[r["p"]])[turn[r["p"]]]
        turn[r["p"]] += 1
        seen[i] = slot
    assert [seen[i] for i in range(len(got))] == sorted(seen.values())


def test_top_k_against_all_products(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 40 * 20 * 8)
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) for _ in range(20)]) for i in range(150)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, None), (203, [1.0, None]), (204, [float("nan")] * 20), (205, []),
             (206, [float("inf")] + [0.0] * 19), (207, [3.0, -2.0]), (None, rows[1][1]), (250, [0.0] * 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "2 AS cb")
    fine = {i: [math.floor(256 * x) for x in v] for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in fine if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(fine[q], v)), i) for i, v in fine.items() if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    got = topk.exact_top_k(df, df.filter("vec_id % 50 = 0"), 5)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.exact_top_k(df, df.limit(0), 5).count() == 0
    few = topk.exact_top_k(df.filter("vec_id IN (0, 1, 2)"), df.filter("vec_id = 0"), 5)
    assert [r["rank"] for r in few.orderBy("rank").collect()] == [1, 2]


def test_top_k_of_repeated_ids(spark):
    rows = [(i, [float(9 - i), 1.0]) for i in range(9)] + [(50, [1.0, 0.0]), (50, [1.0, 0.0]), (50, [-1.0, 0.0]), (3, [7.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.exact_top_k(df, df.filter("vec_id = 50"), 3, 1).collect()
    ahead = [(1, 0, 9), (2, 1, 8), (3, 2, 7)]
    back = [(1, 8, -1), (2, 7, -2), (3, 6, -3)]
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(ahead * 2 + back)
    assert {r["query_id"] for r in got} == {50}


def test_top_k_of_large_negative_scores_before_zeros():
    rows = [np.array([2_000_000 + i // 3] + [0] * 23) for i in range(10)]
    query = np.array([-2_000_000] + [0] * 23)
    _, ids, scores = topk.best_of_block([-1], [query], range(10), rows, 5)
    assert ids.tolist() == [0, 1, 2, 3, 4]
    assert scores.tolist() == [int(query @ rows[i]) for i in range(5)]


def test_pipeline_stage_by_stage(spark, sf, ranks):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(9001, "123 456", "en", "src0", 7), (9002, None, None, None, None)], docs.schema)
    docs = docs.unionByName(extra)
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    known = stages["identify"](spark, docs, sf).cache()
    assert known.columns == columns
    assert {i for i, _ in rows(docs)} - {i for i, _ in rows(known)} <= {9001, 9002} | {i for i, t in rows(docs) if len(t or "") < 30}
    single = stages["exact_dedup"](spark, known, sf).cache()
    assert single.columns == columns
    assert sorted(i for i, _ in rows(single)) == sorted(r[0] for r in exact_brute(rows(known)) if r[3])
    near = stages["near_dedup"](spark, single, sf).cache()
    assert sorted(i for i, _ in rows(near)) == sorted(r[0] for r in near_brute(rows(single)) if r[3])
    near.write.mode("overwrite").parquet(f"{spark.conf.get('spark.checkpoint.dir')}/mixed/documents.parquet")
    con = duck(sf)
    con.execute("DROP VIEW documents")
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{spark.conf.get('spark.checkpoint.dir')}/mixed/documents.parquet/*.parquet'")
    taken = con.execute(queries.ORACLES["op5_mixing"]).fetchall()
    times = {r[0]: math.floor(r[4] / r[1] + 0.5) for r in taken if r[1]}
    mixed = stages["mix"](spark, near, sf).cache()
    assert mixed.columns == columns
    assert Counter(i for i, _ in rows(mixed)) == Counter({i: n for i, n in times.items() if n})
    done = stages["tokenize"](spark, mixed, sf).collect()
    assert Counter(map(tuple, done)) == Counter((i, *digests(t, ranks)) for i, t in rows(mixed))
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_pipeline_on_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == 0
