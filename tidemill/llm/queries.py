"""Registered queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import (
    bpe, exact, language, mixing, neardup, passages, quality, resample, secrets, topk, toxicity, urls, whitening,
)
from tidemill.session import prepare

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
# rules of the URL filter, as the task gives them
URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
]


def query(name: str, sql: str | None = None):
    def wrap(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """The byte-level vocabulary file of the public tokenizers package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def held_out():
    return F.coalesce(~quality.learnable(), F.lit(False)).alias("held_out")


@query("op1_secrets")
def op1_secrets(spark, sf_dir):
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    number = lambda kind: F.size(F.filter(spans, lambda r: r["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter(spans, lambda r: r["ord"] < len(secrets.LEAST))
    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(secrets.span_list(base).cast("binary"), 256).alias("base_sha256"), secrets.span_list(spans).alias("spans"),
    )


@query("op2_language")
def op2_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language.predict_language(docs, language.train_filters(docs))
    return found.select("doc_id", held_out(), "lang_pred", "score")


@query("op3_exact_dedup", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
WINDOW same AS (PARTITION BY t)
""")
def op3_exact_dedup(spark, sf_dir):
    return exact.exact_groups(table(spark, sf_dir, "documents")).drop("place")


@query("op4_quality")
def op4_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.train_quality(docs, table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return quality.score_quality(docs, model).select("doc_id", held_out(), "score", predicted)


@query("op5_mixing", r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(text, '')) AS place
  FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 AS INT) + 1]::DOUBLE AS weight
  FROM sized GROUP BY source
), caps AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source IS NULL, encode(source)) AS r FROM sizes
), levels AS (
  SELECT *, ((SELECT sum(source_size) FROM caps) * 1.5::DOUBLE - coalesce(sum(cap) OVER earlier, 0))
            / ((SELECT sum(weight) FROM caps) - coalesce(sum(weight) OVER earlier, 0)) AS level
  FROM caps WINDOW earlier AS (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         CASE WHEN level * weight >= cap THEN cap
              ELSE (SELECT arg_min(level, r) FROM levels WHERE NOT level * weight >= cap) * weight END AS target
  FROM levels
), cuts AS (
  SELECT source, source_size, target, 4294967296 AS unit, greatest(1, least(256, CAST(floor(sum(target) OVER () / 65536) AS BIGINT))) AS block,
         sum(target) OVER () AS whole, sum(target) OVER (ORDER BY source IS NULL, encode(source)) AS upto,
         row_number() OVER (ORDER BY source IS NULL, encode(source)) AS no
  FROM targets WHERE target > 0
), stretches AS (
  SELECT *, CASE WHEN no = max(no) OVER () THEN unit ELSE CAST(floor(upto / whole * unit::DOUBLE) AS BIGINT) END AS behind FROM cuts
), slots AS (
  SELECT (j * 2654435769::HUGEINT) % 4294967296 AS point
  FROM (SELECT unnest(range((SELECT CAST(floor(max(whole) / max(block)) AS BIGINT) FROM cuts))) AS j)
), drawn AS (
  SELECT source, any_value(block) * count(point) AS words
  FROM (SELECT *, coalesce(lag(behind) OVER (ORDER BY no), 0) AS front FROM stretches) JOIN slots ON point >= front AND point < behind
  GROUP BY source
), laid AS (
  SELECT doc_id, size, source_size, target, CAST(least(coalesce(words, 0), 2 * source_size) AS BIGINT) AS words,
         CAST(sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN drawn d ON s.source IS NOT DISTINCT FROM d.source
)
SELECT doc_id, size, source_size, target,
       CAST(greatest(least(start + size, words) - start, 0) + greatest(least(source_size + start + size, words) - source_size - start, 0)
            AS BIGINT) AS taken
FROM laid
""")
def op5_mixing(spark, sf_dir):
    documents, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return documents.select("doc_id", "size", "source_size", "target", "taken")


@query("op6_bpe")
def op6_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


@query("op7_near_dedup", r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                 ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT x, y FROM met JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * i >= 85 * (p.n + q.n - i)
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, y FROM reach JOIN links ON r = x
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
LEFT JOIN sizes USING (doc_id)
""")
def op7_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_repeated_passages")
def op8_repeated_passages(spark, sf_dir):
    return passages.remove_passages(table(spark, sf_dir, "documents")).drop("spans")


@query("op9_top_k", """
WITH vecs AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM vecs q JOIN vecs c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored) WHERE r <= 5
""")
def op9_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.exact_top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), 5)


@query("op10_url_filter")
def op10_url_filter(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES).drop("score")


@query("op11_whitening")
def op11_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op12_resampling", r"""
WITH polynomial AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS t FROM range(256) AS r(i)
), read AS (
  SELECT 0 AS aim, row_number() OVER () AS row_no, doc_id, text FROM documents UNION ALL SELECT 1, NULL, NULL, text FROM benchmark
), words AS (
  SELECT aim, row_no, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM read
), counted AS (SELECT aim, row_no, w, count(*) AS n FROM words GROUP BY ALL),
coded AS (
  SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM counted)
), buckets AS (
  SELECT w, xor(list_reduce(list_concat([4294967295::BIGINT], [('0x' || substr(h, 2 * i - 1, 2))::BIGINT FOR i IN range(1, len(h) // 2 + 1)]),
                            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM coded, polynomial
), sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (aim = 0), 0) AS s, coalesce(sum(n) FILTER (aim = 1), 0) AS t
  FROM counted JOIN buckets USING (w) GROUP BY bucket
), totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM sums, totals
), weights AS (
  SELECT row_no, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS gained
  FROM counted JOIN buckets USING (w) JOIN gains USING (bucket) WHERE aim = 0 GROUP BY row_no
), weighed AS (
  SELECT row_no, doc_id, coalesce(n_features, 0) AS n_features, coalesce(CAST(floor(gained / n_features) AS BIGINT), 0) AS weight,
         ('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT AS h
  FROM read LEFT JOIN weights USING (row_no) WHERE aim = 0
), scored AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM weighed
), ranked AS (
  SELECT row_no, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS r, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= n * 10 // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (row_no)
""")
def op12_resampling(spark, sf_dir):
    ranks = resample.importance_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranks.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_toxicity")
def op13_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return toxicity.score_toxicity(docs, model).select("doc_id", held_out(), "score", predicted)
