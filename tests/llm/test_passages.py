"""Suffix arrays, and repeated passages against a table of all passages."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemill.llm import passages, queries
from tidemill.llm.suffix import permuted_prefixes, suffix_array


def brute(texts: list[bytes], length: int = 200):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("alphabet", [1, 2, 4, 30])
def test_suffix_array_and_prefixes(alphabet):
    rng = random.Random(alphabet)
    for _ in range(150):
        s = np.array([rng.randrange(alphabet) for _ in range(rng.randint(1, 70))])
        sa = suffix_array(s, alphabet)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        plcp, phi = permuted_prefixes(s, sa)
        for a, b in zip(sa[:-1].tolist(), sa[1:].tolist()):
            same = 0
            while max(a, b) + same < len(s) and s[a + same] == s[b + same]:
                same += 1
            assert (plcp[b], phi[b]) == (same, a)


def test_large_alphabets_are_sorted_element_by_element():
    rng = random.Random(5)
    s = np.array([rng.randrange(6000) for _ in range(5000)] * 2)
    assert suffix_array(s, 6000).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def cases():
    rng = random.Random(11)
    letters = "abcdefgh é"
    words = lambda n: "".join(rng.choices(letters, k=n))
    shared, license_line = words(230), words(400)
    texts = [words(900), words(300) + shared + words(250), shared[:215] + words(90), words(50) + shared[5:] + words(400)]
    texts += [words(rng.randint(1, 120)) + license_line + words(rng.randint(1, 300)) for _ in range(40)]
    texts += [texts[4], texts[4], "ab" * 700, "x" * 1000, words(150) * 3, words(199), words(200)]
    return [*texts, None, "", None, words(60) + "\u0000" + shared]


@pytest.mark.parametrize("split", [passages.SPLIT_BYTES, 3000])
def test_passages_match_brute_force(spark, monkeypatch, split):
    # the second run divides the anchors of the license line among several shards
    monkeypatch.setattr(passages, "SPLIT_BYTES", split)
    monkeypatch.setattr(passages, "SHARD_BYTES", 1 << 12)
    texts = cases()
    rows = [(i if i != 7 else None, t) for i, t in enumerate(texts)] + [(2, texts[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r)[:5] for r in passages.remove_passages(df).collect() if r["doc_id"] is not None)
    want = brute([(t or "").encode() for _, t in rows])
    assert got == sorted((i, *w) for (i, _), w in zip(rows, want) if i is not None)


def test_query_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want = brute([(r["text"] or "").encode() for r in docs])
    got = queries.QUERIES["op8_repeated_passages"](spark, sf).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(r["doc_id"], *w) for r, w in zip(docs, want)]


def test_empty_table(spark):
    assert passages.remove_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0
