"""Vocabularies, token sequences, next-word tables and chunkers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import texts
from tidemill.operators.ordering import global_index
from tidemill.session import cut


def vocabulary(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Words with counts and an index from 1 by falling count, then first appearance."""
    seen = docs.select(F.col(key).alias("__k"), F.posexplode(texts.words(text)).alias("__p", "word"))
    counts = seen.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("__k", "__p")).alias("__first"))
    return global_index(counts, F.desc("n"), "__first", name="index", start=1).select("word", "n", "index")


def token_lines(docs: DataFrame, key: str, text: str, vocab: DataFrame) -> DataFrame:
    """One row per line with its token numbers."""
    split = docs.select(key, F.posexplode(texts.lines(text)).alias("line", "__t"))
    placed = split.select(key, "line", F.posexplode(texts.words("__t")).alias("__p", "word"))
    coded = placed.join(vocab.select("word", "index"), "word")
    # a group is one line of one document
    return coded.groupBy(key, "line").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("__p", "index"))), lambda s: s["index"]).alias("tokens")
    )


def prefix_sequences(lines: DataFrame, key: str) -> DataFrame:
    """All prefixes of two or more tokens, left-padded with 0 to the longest line; last token apart."""
    longest = lines.agg(F.max(F.size("tokens"))).scalar()
    usable = lines.filter(F.size("tokens") > 1).withColumn("__m", longest)
    grown = usable.select(key, "line", "tokens", "__m", F.explode(F.sequence(F.lit(2), F.size("tokens"))).alias("length"))
    zero = F.lit(0).cast("bigint")
    return grown.select(
        key, "line", "length",
        F.concat(
            F.array_repeat(zero, F.col("__m") - F.col("length")), F.slice("tokens", F.lit(1), F.col("length") - 1)
        ).alias("x"),
        F.element_at("tokens", F.col("length")).alias("y"),
    )


def next_words(docs: DataFrame, text: str) -> DataFrame:
    """Most frequent follower of each word within a line, ties in alphabetical order."""
    line = docs.select(F.explode(texts.lines(text)).alias("t")).select(texts.words("t").alias("w"))
    n = F.greatest(F.size("w") - 1, F.lit(0))
    # the outer form, and no filter on the number of words: either would be put below with a second copy of all that makes the words
    pairs = line.select(
        F.inline_outer(F.arrays_zip(F.slice("w", F.lit(1), n).alias("word"), F.slice("w", F.lit(2), n).alias("next")))
    ).filter("word IS NOT NULL")
    counts = pairs.groupBy("word", "next").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("word").agg(F.min_by("next", F.struct(-F.col("n"), F.col("next"))).alias("next"))


def continue_texts(seeds: DataFrame, model: DataFrame, text: str, steps: int = 5) -> DataFrame:
    """Append the most likely next word `steps` times; a text without a known follower stays as it is."""
    table = cut(model)
    out = seeds.withColumn("generated", F.col(text)).withColumn("__last", F.element_at(texts.words(text), -1))
    for _ in range(steps):
        step = table.select(F.col("word").alias("__last"), F.col("next").alias("__next"))
        out = out.join(step, "__last", "left").withColumns(
            {"generated": F.concat_ws(" ", "generated", "__next"), "__last": F.col("__next")}
        ).drop("__next")
    return out.drop("__last")


_BOUNDS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))


def _pack(size: int, overlap: int):
    """Chunk bounds (sentence numbers) from sentence lengths; only lengths travel to Python."""

    def bounds(lengths: np.ndarray) -> list[dict]:
        ends = np.concatenate([[0], np.cumsum(lengths)])
        found, start, at = [], 0, 1
        while at < len(lengths):
            # first sentence that no longer fits after `start`
            over = int(np.searchsorted(ends, ends[start] + size, side="right")) - 1
            stop = max(over, at)
            if stop >= len(lengths):
                break
            found.append({"start": start, "stop": stop})
            carry = int(np.searchsorted(ends, ends[stop] - overlap, side="left"))
            start, at = max(start, min(carry, stop)), stop + 1
        if len(lengths):
            found.append({"start": start, "stop": len(lengths)})
        return found

    @F.pandas_udf(_BOUNDS)
    def pack(lengths: pd.Series) -> pd.Series:
        return pd.Series([bounds(np.asarray(x, dtype=np.int64)) for x in lengths])

    return pack


def sentence_chunks(docs: DataFrame, key: str, text: str, size: int = 800, overlap: int = 150) -> DataFrame:
    """Greedy sentence packing with carried sentences: `(key, chunk_index, start, stop, text)`.

    A chunk closes before the sentence that would push the sum of sentence lengths above
    `size`. The next one starts with the trailing sentences of at most `overlap` characters.
    """
    split = docs.select(key, texts.sentences(text).alias("s"))
    packed = split.withColumn("b", _pack(size, overlap)(F.transform("s", F.length)))
    # the chunks' texts are made before the rows are multiplied, so no row carries the document
    joined = F.transform(
        "b",
        lambda b: F.struct(
            b["start"].alias("start"), b["stop"].alias("stop"),
            F.array_join(F.slice(F.col("s"), b["start"] + 1, b["stop"] - b["start"]), " ").alias("text"),
        ),
    )
    # the outer form: below the plain one the optimiser puts a filter on the array's size, with a second copy of all that makes it
    each = packed.select(key, joined.alias("c")).select(key, F.posexplode_outer("c").alias("chunk_index", "c")).filter("c IS NOT NULL")
    return each.select(key, "chunk_index", "c.start", "c.stop", "c.text").withColumn("chunk_id", F.concat(F.col(key).cast("string"), F.lit("::chunk"), F.col("chunk_index").cast("string")))


def sections(docs: DataFrame, key: str, text: str, title: str) -> DataFrame:
    """Parts at numbered headers `## n. Title`; what stands before the first header is dropped.

    A text without headers is one part without number and title.
    """
    headers = F.regexp_extract_all(F.col(text), F.lit(texts.SECTION_HEADER), F.lit(0))
    numbers = F.regexp_extract_all(F.col(text), F.lit(texts.SECTION_HEADER), F.lit(1))
    titles = F.regexp_extract_all(F.col(text), F.lit(texts.SECTION_HEADER), F.lit(2))
    bodies = F.slice(F.split(F.col(text), texts.SECTION_HEADER), F.lit(2), F.size("__h"))
    base = docs.select(key, title, text, headers.alias("__h"))
    whole = F.array(
        F.struct(
            F.lit(None).cast("string").alias("section_number"), F.lit(None).cast("string").alias("section_title"),
            F.col(text).alias("body"),
        )
    )
    parts = F.transform(
        F.arrays_zip(numbers.alias("a"), titles.alias("b"), bodies.alias("c")),
        lambda z: F.struct(
            z["a"].alias("section_number"), texts.strip(z["b"]).alias("section_title"), texts.strip(z["c"]).alias("body")
        ),
    )
    rows = F.when(F.size("__h") == 0, whole).otherwise(parts)
    return base.select(key, F.col(title).alias("title"), F.posexplode(rows).alias("section", "__s")).select(
        key, "title", "section", "__s.*"
    )


def windows(column, size: int, overlap: int) -> Column:
    """Start offsets of fixed windows; the last one reaches the end of the text."""
    length, step = F.length(column), size - overlap
    last = F.when(length <= size, 0).otherwise(F.ceil((length - size) / step) * step).cast("int")
    return F.sequence(F.lit(0), last, F.lit(step))


def window_chunks(parts: DataFrame, key: str, size: int = 800, overlap: int = 120) -> DataFrame:
    """Fixed windows over section bodies, each with a header line naming document and section."""
    starts = windows(F.col("body"), size, overlap)
    # the pieces are cut before the rows are multiplied, so no row carries the body
    cut_up = F.transform(starts, lambda at: texts.strip(F.substring(F.col("body"), at + 1, F.lit(size))))
    bodies = parts.withColumn("__n", F.size(starts)).withColumn("__pieces", cut_up).drop("body")
    each = bodies.select(*[c for c in bodies.columns if c != "__pieces"], F.posexplode_outer("__pieces").alias("piece", "__piece"))
    each = each.filter("__piece IS NOT NULL")
    suffix = F.concat(
        F.lit("-"), F.coalesce("section_number", F.lit("full")),
        F.when(F.col("__n") > 1, F.concat(F.lit("."), F.col("piece").cast("string"))).otherwise(""),
    )
    header = F.concat(
        F.lit("["), "title", F.lit(". "), "title",
        F.coalesce(F.concat(F.lit(" — Section "), "section_number", F.lit(": "), "section_title"), F.lit("")), F.lit("]\n"),
    )
    return each.select(
        F.concat(F.col(key).cast("string"), suffix).alias("chunk_id"), key, "title", "section_number", "section_title",
        F.concat(header, "__piece").alias("text"),
    )
