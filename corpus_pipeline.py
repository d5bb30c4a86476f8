"""The corpus pipeline: language, exact copies, near copies, source mix, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import bpe, exact, language, mixing, neardup
from tidemill.llm.queries import vocabulary
from tidemill.session import cut, prepare

LEAST_COVERED = 0.5  # documents are rejected when their best language holds a smaller part of their n-grams
LEAST_LEAD = 0.02  # and when it is ahead of the next one by less than this part of its count


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those without letters, of another language or of no language for certain, go."""
    prepare(spark)
    return language.keep_identified(docs, language.train_filters(docs), LEAST_COVERED, LEAST_LEAD)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest identifier."""
    prepare(spark)
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest identifier."""
    prepare(spark)
    return neardup.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix to target weights takes them."""
    prepare(spark)
    return mixing.repeat_by_mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the bytes decoded from them."""
    prepare(spark)
    return bpe.round_trip(docs, vocabulary())


STAGES = [("identify", identify), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix", mix), ("tokenize", tokenize)]

# trained filters and the library's tokens have no SQL; tests compare every stage with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole `documents` table, each written and read again before the next."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
