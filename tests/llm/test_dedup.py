"""Exact and near deduplication against brute force, with long lists and divided groups."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tidemill.llm import exact, graph, kernels, neardup

ASCII = {ord(c): ord(c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def exact_brute(rows):
    low = [((t or "").translate(ASCII), i) for i, t in rows]
    out = []
    for t, i in low:
        own = [j for u, j in low if u == t]
        keep = max((j for j in own if j is not None), default=None)
        out.append((i, keep, len(own), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_files,few", [(None, exact.FEW), (1, 0)])
def test_exact_groups(spark, monkeypatch, max_files, few):
    monkeypatch.setattr(exact, "FEW", few)
    rows = [(1, "A b"), (2, "a B"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "x" * 100_000), (8, "X" * 100_000),
            (2, "a B"), (None, "a b"), (None, "lone"), (9, "same"), (10, "same")] + [(100 + i, "hot") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("x", "y").repartition(6)
    df = df.selectExpr("*", "1 AS digest", "'p' AS place", "2 AS group_size")
    got = sorted((tuple(r)[:5] for r in exact.exact_groups(df, max_files).collect()), key=repr)
    assert got == exact_brute(rows)
    once = exact.drop_copies(df, max_files)
    assert once.columns == df.columns
    assert sorted(r["doc_id"] for r in once.collect() if r["doc_id"]) == [2, 4, 5, 6, 8, 10, 399]


def test_of_rows_alike_in_identifier_and_text_the_first_as_json_stays(spark):
    rows = [(1, "a", 9, "z"), (1, "A", 2, "y"), (1, "a", 9, "b"), (2, "c", None, None), (2, "c", None, None), (None, "q", 1, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __sha long, id string")
    got = sorted((tuple(r) for r in exact.drop_copies(df).collect()), key=repr)
    assert got == sorted([(1, "A", 2, "y"), (2, "c", None, None)], key=repr) + [(None, "q", 1, "")]


def test_state_settings_stay_out_of_the_session(spark):
    before = spark.conf.getAll
    exact.exact_groups(spark.createDataFrame([(1, "a")], "doc_id long, text string")).collect()
    assert spark.conf.getAll == before


def test_equal_bytes_are_counted_before_the_exchange(spark, tmp_path):
    spark.createDataFrame([(i, "hot") for i in range(50)], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    seen = []
    real = exact.cut
    exact_cut = lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or real(df)
    try:
        exact.cut = exact_cut
        exact.exact_groups(spark.read.parquet(str(tmp_path / "d")))
    finally:
        exact.cut = real
    plan = next(p for p in seen if "body" in p)
    assert "hashpartitioning(digest" in plan and "partial_count" in plan.split("hashpartitioning(digest", 1)[1].split("MapInArrow")[0]


def test_full_bytes_decide_when_digests_agree(spark, monkeypatch):
    real = hashlib.sha256

    class Weak:
        def __init__(self, data=b""):
            self.data = data

        def digest(self):
            return real(self.data[:1]).digest()

    monkeypatch.setattr(exact.hashlib, "sha256", Weak)
    # workers import the module anew, so the functions travel with the weak digest inside
    def digests(batches):
        import pyarrow as pa

        for b in batches:
            texts = [(t or "").encode().lower() for t in b.column("text").to_pylist()]
            found = [hashlib.md5(t[:1]).digest() for t in texts]
            extra = [b.column("place")] if "place" in b.schema.names else [pa.array(texts, pa.binary())]
            names = ["doc_id", "digest", "place" if "place" in b.schema.names else "body"]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, pa.binary()), *extra], names=names)

    monkeypatch.setattr(exact, "_digests", digests)
    monkeypatch.setattr(exact, "_bodies", digests)
    rows = [(1, "ab"), (2, "ac"), (3, "AB"), (4, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in exact.exact_groups(df).collect())
    assert got == [(1, 3, 2), (2, 2, 1), (3, 3, 2), (4, 4, 1)]


def near_brute(rows, percent=85):
    import re

    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", (t or "").translate(ASCII))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[top(i)] = top(j)
    out = []
    for i, (k, _) in enumerate(rows):
        least = min((rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None), default=None)
        out.append((k, len(sets[i]), least, k == least))
    return sorted(out, key=repr)


def near_cases():
    rng = random.Random(2)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]

    def edited(base, times):
        w = list(base)
        for _ in range(times):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        return " ".join(w)

    base, line = words(140), words(12)
    texts = [edited(base, rng.randrange(0, 8)) for _ in range(130)]  # one large group of near copies
    for _ in range(12):
        other = words(rng.randint(30, 200))
        texts += [edited(other, rng.randrange(0, 3)) for _ in range(rng.randint(1, 5))]
    texts += [" ".join(line + words(rng.randint(0, 3))) for _ in range(60)]  # mostly one common line
    texts += ["one two", "ONE two", "one  two\n", "five words are one shingle", "five words are one Shingle", "a", "  ", "", None, None]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return [*rows, (None, "one two"), (None, None), (3, texts[3])]


@pytest.mark.parametrize("short,tile", [(neardup.LIST, neardup.TILE), (3, 8)])
def test_near_duplicates(spark, monkeypatch, short, tile):
    monkeypatch.setattr(neardup, "LIST", short)
    monkeypatch.setattr(neardup, "TILE", tile)
    rows = near_cases()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "2 AS n", "3 AS sig").repartition(5)
    got = sorted((tuple(r) for r in neardup.near_duplicates(df).collect()), key=repr)
    assert got == near_brute(rows)


def test_near_duplicates_of_nothing(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert exact.exact_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    links = [(1, 2), (3, 2), (9, 8), (8, 7), (7, 6), (5, 5), (20, 21)] + [(30 + i, 31 + i) for i in range(20)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 6: 6, 7: 6, 8: 6, 9: 6, 20: 20, 21: 20} | {30 + i: 30 for i in range(21)}


def test_a_long_path_takes_few_rounds(spark, monkeypatch):
    written = []
    real = graph.cut
    monkeypatch.setattr(graph, "cut", lambda df: written.append(1) or real(df))
    links = [(i, i + 1) for i in range(300)]
    got = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == 301 and {r["root"] for r in got} == {0}
    assert len(written) < 40


def test_words_of_a_long_text_do_not_depend_on_the_piece():
    text = ("Ab  c\n" + "x" * 37 + " \u00e9t\u00e9 " + "y" * 5 + "\tz ").encode() * 9 + b"end"
    whole = kernels.word_hashes([text])[1]
    for size in (1, 2, 3, 7, 16, 50, 1000):
        assert np.array_equal(np.concatenate(list(kernels.text_words(text, size=size))), whole)
    low = np.concatenate(list(kernels.text_words(text, lower=True, size=11)))
    assert np.array_equal(low, kernels.word_hashes([text.lower()])[1])
    assert list(kernels.text_words(b"")) == [] and not sum(map(len, kernels.text_words(b" \n ", size=1)))


def test_the_set_of_a_long_text(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(f"W{rng.randrange(400)}" for _ in range(n)).encode() for n in (900, 5, 4, 1)] + [b" " * 500, b"long" * 300]
    want = [s.tolist() for s in neardup.shingle_sets(texts)]
    monkeypatch.setattr(neardup, "PIECE_BYTES", 64)
    assert [s.tolist() for s in neardup.shingle_sets(texts)] == want


WORKER = """
import resource, sys
import numpy as np, pyarrow as pa
from tidemill.llm import language, neardup
text = (" ".join(f"w{i}" for i in range(7_000_000)))[: 50 << 20] if sys.argv[1] == "words" else "x" * (50 << 20)
batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["doc_id", "text"])
del text
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for _ in neardup._sketches([batch]):
    pass
filters = language.Filters(["a", "b"], [np.ones(1 << language.BITS, np.uint8)], np.zeros(2), 0)
language.evidence(language._strings(batch.column("text")), filters)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


@pytest.mark.parametrize("kind", ["words", "one word"])
def test_a_text_of_50_mb_stays_below_400_mb_of_a_worker(kind):
    import subprocess
    import sys

    out = subprocess.run([sys.executable, "-c", WORKER, kind], capture_output=True, text=True, check=True)
    assert int(out.stdout) < 400


def test_estimate_hardly_drops_a_pair_at_the_threshold():
    import math

    k, p = neardup.KEPT, neardup.PERCENT / 100
    missed = sum(math.comb(k, i) * p**i * (1 - p) ** (k - i) for i in range(k + 1) if i / k < neardup.ESTIMATE)
    assert missed < 1e-8
