"""Importance resampling against a plain loop, for one and several words, with ties, repeats and empty tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest

from tidemill.llm import resample

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def grams(text, longest):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, longest=1, size=10_000, least=20, percent=10):
    bucket = lambda g: crc32(g.encode()) % size
    found = [grams(t, longest) for _, t in docs]
    s, t = Counter(bucket(g) for _, f in found for g in f), Counter(bucket(g) for x in target for g in grams(x, longest)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + size) / ((s[b] + 1) * (t_all + size))))
    rows = []
    for (i, _), (words, f) in zip(docs, found):
        weight = sum(gain(bucket(g)) for g in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296.0)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = len(able) * percent // 100
    out = [(*r, k + 1 if k < drawn else None) for k, r in enumerate(able)] + [(*r, None) for r in rows if r[1] < least]
    return sorted(out, key=repr)


def ranks(df, target, **settings):
    rows = resample.importance_ranks(df, target, **settings).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in rows), key=repr)


@pytest.mark.parametrize("longest,size,least,percent", [(1, 10_000, 20, 10), (3, 500, 5, 37), (2, 7, 0, 100)])
def test_equals_a_plain_loop(spark, sf, longest, size, least, percent):
    docs, target = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain(given, [r["text"] for r in target.collect()], longest, size, least, percent)
    settings = {"longest": longest, "buckets": size, "least": least, "percent": percent}
    assert ranks(docs.repartition(5), target, **settings) == want


def test_odd_rows(spark):
    text = "Ein Wort, zwei_Wörter; drei-fach \x00 A1 ÉCOLE " * 6
    rows = [(1, None), (2, ""), (3, " .,!\n"), (None, text), (4, text), (5, text), (5, text), (5, text), (6, "x " * 300_000)]
    rows += [(7, text + " more")] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string")
    odd = df.selectExpr("*", "0 AS score", "'r' AS rank", "1 AS weight", "2 AS __row", "3 AS found", "4 AS digest")
    target = spark.createDataFrame([(None,), ("",), ("wort École a1",)], "text string")
    got = ranks(odd, target, percent=50)
    assert got == plain(rows, [None, "", "wort École a1"], percent=50)
    assert sorted(r[5] for r in got if r[5]) == list(range(1, 14))
    assert ranks(odd, target.limit(0)) == plain(rows, [])
    assert ranks(odd.limit(0), target) == []
    assert ranks(odd.filter("doc_id < 4"), target) == plain(rows[:3], [None, "", "wort École a1"])


def test_draw_gives_whole_rows(spark, sf):
    docs, target = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    few = {r["doc_id"] for r in resample.importance_ranks(docs, target, percent=20).filter("rank IS NOT NULL").collect()}
    got = resample.draw(docs, target, percent=20)
    assert got.columns == docs.columns and {r["doc_id"] for r in got.collect()} == few


def test_spans_stand_between_word_boundaries():
    one, two = resample.span_patterns(2)
    text = resample.collapse("Über--all, a.b c".encode())
    assert [m[0].decode() for m in one.finditer(text, overlapped=True)] == ["Über", "all", "a", "b", "c"]
    assert [m[0].decode() for m in two.finditer(text, overlapped=True)] == ["Über all", "all a", "a b", "b c"]
