"""Removal of passages that repeat across or within documents, by suffix arrays over shards of anchored segments."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.kernels import BASE, as_bytes, mix, pieces
from tidemill.llm.suffix import permuted_prefixes, suffix_array
from tidemill.session import cut

LENGTH = 200  # bytes of a passage
GRAM = 32  # bytes of an anchor, the smallest-hashed run of a passage; equal passages have equal anchors
CHUNK = 1 << 20  # passages of one text whose anchors are found at once
SHARD_BYTES = 2 << 20  # segments that are sorted together, on average
SPLIT_BYTES = 2 << 20  # segments of one anchor beyond which they are dealt to several shards
EDGE = 255  # stands between segments and occurs in no UTF-8 text
SIDE = (LENGTH - GRAM) // 2
PIECE = 2 << 20  # bytes of short texts that are searched for anchors together


def _anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every anchor candidate, position of the anchor of every passage) of a run of bytes.

    The anchor of a passage is its run of GRAM bytes with the smallest hash, the first of them on a tie.
    """
    h = mix(data.astype(np.uint64) + np.uint64(1))
    factor, width = BASE, 1
    while width < GRAM:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor, width = factor * factor % (1 << 64), 2 * width
    h = mix(h)
    low = np.uint64(0xFFFFFFFF)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    span, width = LENGTH - GRAM + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    return h, (least & low).astype(np.int64)


def _segments(text: bytes, data: np.ndarray, ends: np.ndarray):
    """(document, anchor hash, anchor, first passage, last passage) of the neighbouring passages that share an anchor.

    `text` is a run of documents one after the other, `ends` where each ends; passages lie within one document.
    """
    h, anchor = _anchors(data)
    starts = np.arange(len(anchor))
    doc = np.searchsorted(ends, starts, side="right")
    inside = starts + LENGTH <= ends[doc]
    starts, anchor, doc = starts[inside], anchor[inside], doc[inside]
    if not len(starts):
        return None
    fresh = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1) | (doc[1:] != doc[:-1])))
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(starts)) - 1
    return doc[first], h[anchor[first]], anchor[first], starts[first], starts[last]


SEGMENTS = "doc_id long, th long, h long, dig long, dig2 long, s long, m int, n int"


def _segment_rows(batches):
    """A row per segment: document, anchor hash, digest of its bytes in two halves, where it starts, the anchor in it, its length."""
    for b in batches:
        texts = as_bytes(b.column("text"))
        ids, hashes = b.column("doc_id"), b.column("th").to_numpy(zero_copy_only=False)
        for low, high in pieces([len(t) for t in texts], PIECE):
            if high - low == 1:
                whole = texts[low]
                parts = [([low], a, whole[a : a + CHUNK + LENGTH - 1]) for a in range(0, max(len(whole) - LENGTH + 1, 0), CHUNK)]
            else:
                parts = [(range(low, high), 0, b"".join(texts[low:high]))]
            for rows, shift, text in parts:
                if len(text) < LENGTH:
                    continue
                sizes = [len(texts[r]) for r in rows] if len(rows) > 1 else [len(text)]
                ends = np.cumsum(sizes)
                found = _segments(text, np.frombuffer(text, dtype=np.uint8), ends)
                if found is None:
                    continue
                doc, h, anchor, first, last = found
                begin = np.concatenate(([0], ends[:-1]))[doc]
                digests = np.frombuffer(b"".join(
                    xxhash.xxh3_128_digest(text[i : j + LENGTH]) for i, j in zip(first.tolist(), last.tolist())
                ), dtype=np.int64).reshape(-1, 2)
                row = np.asarray(rows)[doc]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row)), pa.array(hashes[row]), pa.array(h.view(np.int64)),
                     pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy()), pa.array(first - begin + shift),
                     pa.array((anchor - first).astype(np.int32)), pa.array((last - first + LENGTH).astype(np.int32))],
                    names=["doc_id", "th", "h", "dig", "dig2", "s", "m", "n"],
                )


def _cut_segments(batches):
    """The bytes of the wanted segments of each document."""
    for b in batches:
        texts, wanted = as_bytes(b.column("text")), b.column("wanted").to_pylist()
        out = [(w["shard"], w["part"], w["h"], w["cls"], w["m"], t[w["s"] : w["s"] + w["n"]]) for t, ws in zip(texts, wanted) for w in ws]
        columns = list(zip(*out)) if out else [[]] * 6
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "part", "h", "cls", "m", "seg"]
        )


def _possible(pdf: pd.DataFrame) -> pd.DataFrame:
    """Segments that may share a passage with another one of their anchor.

    A shared passage reaches at least SIDE bytes to one side of the anchor, so those bytes are shared as well. Within one
    segment no passage repeats: equal passages have their anchor in the same place.
    """
    sides = []
    for h, m, seg in zip(pdf["h"], pdf["m"], pdf["seg"]):
        left = (h, 0, seg[m - SIDE : m]) if m >= SIDE else None
        right = seg[m + GRAM : m + GRAM + SIDE]
        sides.append((left, (h, 1, right) if len(right) == SIDE else None))
    seen = Counter(k for pair in sides for k in pair if k is not None)
    return pdf[[any(k is not None and seen[k] > 1 for k in pair) for pair in sides]]


def _sort_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """Spans of the segments of a shard whose passages start more than once in it.

    Shards of a divided anchor also return every different passage once, as a digest, to be met with the others.
    """
    divided = int(pdf["part"].iloc[0]) >= 0
    if not divided:
        pdf = _possible(pdf)
    empty = pd.DataFrame({"cls": np.zeros(0, np.int64), "a": np.zeros(0, np.int32), "b": np.zeros(0, np.int32), "dig": []})
    if pdf.empty:
        return empty
    segs, classes = list(pdf["seg"]), pdf["cls"].to_numpy()
    text = b"\xff".join(segs) + b"\xff"
    s = np.frombuffer(text, dtype=np.uint8)
    sizes = np.array([len(x) for x in segs])
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    sa = suffix_array(s, 256)
    plcp, phi = permuted_prefixes(s, sa)
    of = np.searchsorted(ends, np.arange(len(s)))
    room = ends[of] - np.arange(len(s))
    same = np.minimum(plcp, room) >= LENGTH
    hit = same.copy()
    hit[phi[same]] = True
    at = np.flatnonzero(hit)
    out = []
    if len(at):
        new = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (of[at[1:]] != of[at[:-1]])))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        a, b = at[first], at[last] + LENGTH
        out.append(pd.DataFrame({"cls": classes[of[a]], "a": a - begins[of[a]], "b": b - begins[of[a]], "dig": None}))
    if divided:
        once = np.flatnonzero((room >= LENGTH) & ~same)
        digests = [hashlib.blake2b(text[i : i + LENGTH], digest_size=16).digest() for i in once.tolist()]
        a = once - begins[of[once]]
        out.append(pd.DataFrame({"cls": classes[of[once]], "a": a, "b": a + LENGTH, "dig": digests}))
    return pd.concat(out) if out else empty


def _merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def repeated_spans(docs: DataFrame) -> DataFrame:
    """`(doc_id, text, found)`: `found` lists where in the UTF-8 bytes of each text repeated passages lie, or is null.

    A passage is a string of LENGTH bytes that also starts anywhere else, in any document, the same one and equal rows
    included. Null texts count as empty and passages never cross documents.

    Neighbouring passages with a common anchor form a segment. Equal passages have equal anchors, so only anchors met more than
    once matter, and equal segments (of one anchor and one 128-bit digest) are one class with a count. The classes of an anchor are sorted in one shard by induced
    sorting; the permuted common prefixes say which passages start twice. Shards hold many
    anchors and a bounded number of bytes on average; an anchor with more classes than a shard should hold is divided, and its
    shards' different passages then meet by digest. Lists per document are bounded by the document.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long"), text.alias("text")).withColumn("th", F.xxhash64("text"))
    segments = cut(keyed.mapInArrow(_segment_rows, SEGMENTS))
    # a written table, so the join deals both sides itself and can split the rows of a frequent anchor
    repeated = cut(segments.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h"))
    kept = cut(segments.join(repeated, "h", "left_semi"))
    first = F.min(F.struct("doc_id", "th", "s", "m", "n"))
    classes = kept.groupBy("h", "dig", "dig2").agg(F.count(F.lit(1)).alias("c"), first.alias("rep"))
    classes = cut(classes.withColumn("cls", F.monotonically_increasing_id()))
    groups = classes.groupBy("h").agg(F.count(F.lit(1)).alias("d"), F.sum("rep.n").alias("bytes")).filter("d > 1")
    groups = cut(groups)
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    divided = F.col("bytes") > SPLIT_BYTES
    shard = F.when(divided, F.col("h")).otherwise(F.pmod(F.xxhash64("h"), F.lit(shards)))
    parts = F.ceil(F.col("bytes") / (SHARD_BYTES / 2)).cast("long")
    part = F.when(divided, F.pmod(F.xxhash64("cls"), parts)).otherwise(-1).cast("int")
    wanted = classes.join(groups, "h").select(
        F.col("rep.doc_id").alias("__id"), F.col("rep.th").alias("__th"),
        F.struct(shard.alias("shard"), part.alias("part"), "h", "cls", F.col("rep.s").alias("s"), F.col("rep.m").alias("m"),
                 F.col("rep.n").alias("n")).alias("w"),
    ).groupBy("__id", "__th").agg(F.collect_list("w").alias("wanted"))
    same_doc = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th"))
    pieces_of = keyed.join(wanted, same_doc).select("text", "wanted").mapInArrow(
        _cut_segments, "shard long, part int, h long, cls long, m int, seg binary"
    )
    found = cut(pieces_of.groupBy("shard", "part").applyInPandas(_sort_shard, "cls long, a int, b int, dig binary"))
    met = found.filter("dig IS NOT NULL").groupBy("dig").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("dig")
    spans = (
        classes.filter("c > 1").select("cls", F.lit(0).alias("a"), F.col("rep.n").alias("b"))
        .unionByName(found.filter("dig IS NULL").select("cls", "a", "b"))
        .unionByName(found.join(met, "dig", "left_semi").select("cls", "a", "b"))
        .groupBy("cls").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    )
    of_class = classes.select("h", "dig", "dig2", "cls").join(spans, "cls").drop("cls")
    placed = kept.select("doc_id", "th", "h", "dig", "dig2", "s").join(of_class, ["h", "dig", "dig2"])
    per_doc = placed.groupBy(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).agg(
        F.collect_list(F.struct("s", "spans")).alias("found")
    )
    return keyed.join(per_doc, same_doc, "left").select("doc_id", "text", "found")


def _removed(batches):
    for b in batches:
        texts, found = as_bytes(b.column("text")), b.column("found").to_pylist()
        rows = []
        for t, f in zip(texts, found):
            spans = _merged({(x["s"] + p["a"], x["s"] + p["b"]) for x in f for p in x["spans"]}) if f else []
            digest, at = hashlib.sha256(), 0
            for a, z in spans:
                digest.update(t[at:a])
                at = z
            digest.update(t[at:])
            rows.append((len(t), sum(z - a for a, z in spans), len(spans), digest.hexdigest(), [{"a": a, "b": z} for a, z in spans]))
        columns = list(zip(*rows)) if rows else [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def remove_passages(docs: DataFrame) -> DataFrame:
    """`(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)`: one row per row of `docs`.

    `spans` are the maximal removed runs as byte offsets, end exclusive; overlapping and adjoining ones are one. `kept_sha256` is the
    digest of the bytes that remain, one after the other. A text without repeated passages stays as it is.
    """
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<a: long, b: long>>"
    return repeated_spans(docs).mapInArrow(_removed, schema)
