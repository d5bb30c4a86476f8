"""Queries: text clean-up, chunking, vocabularies, term weights, search and answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import texts
from tidemill.functions.arrays import normalised
from tidemill.operators import retrieval, text, vectors
from tidemill.plans.registry import query
from tidemill.plans.tables import BLANKS
from tidemill.plans.timeline import rounded
from tidemill.plans.views import table
from tidemill.session import cut, scratch_path, spread
from tidemill.sources import files

# ---- vocabularies and sequences

PUNCT_SQL = r"""[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~\t\n]"""


def words_sql(column):
    return f"list_filter(string_split(regexp_replace(lower({column}), '{PUNCT_SQL}', ' ', 'g'), ' '), lambda w: w <> '')"


VOCAB_SQL = """w AS (SELECT {key} AS k, {words} AS ws FROM {table}),
    e AS (SELECT k, unnest(ws) AS word, unnest(range(len(ws))) AS p FROM w),
    c AS (SELECT word, count(*) AS n, min((k, p)) AS f FROM e GROUP BY word),
    vocab AS (SELECT word, CAST(n AS BIGINT) AS n, row_number() OVER (ORDER BY n DESC, f) AS index FROM c)"""


def documents(spark, sf):
    return spread(table(spark, sf, "documents"))


@query("x1_vocabulary", "WITH " + VOCAB_SQL.format(key="doc_id", words=words_sql("text"), table="documents") + " SELECT word, n, index FROM vocab")
def _(spark, sf):
    return text.vocabulary(documents(spark, sf), "doc_id", "text")


@query(
    "x2_prefix_sequences",
    "WITH " + VOCAB_SQL.format(key="item_id", words=words_sql("text"), table="benchmark") + f""",
    l AS (SELECT item_id, unnest(string_split(text, chr(10))) AS t, unnest(range(len(string_split(text, chr(10))))) AS line FROM benchmark),
    t AS (SELECT item_id, line, {words_sql("t")} AS ws FROM l),
    u AS (SELECT item_id, line, unnest(ws) AS word, unnest(range(len(ws))) AS p FROM t),
    s AS (SELECT item_id, line, list(index ORDER BY p) AS toks FROM u JOIN vocab USING (word) GROUP BY ALL),
    m AS (SELECT max(len(toks)) AS m FROM s),
    g AS (SELECT item_id, line, toks, m, unnest(range(2, len(toks) + 1)) AS length FROM s, m WHERE len(toks) > 1)
    SELECT item_id, line, length, array_to_string(list_concat(list_transform(range(m - length), lambda z: 0), toks[1:length - 1]), ' ') AS x,
           toks[length] AS y FROM g""",
)
def _(spark, sf):
    docs = table(spark, sf, "benchmark")
    vocab = text.vocabulary(docs, "item_id", "text")
    seqs = text.prefix_sequences(cut(text.token_lines(docs, "item_id", "text", vocab)), "item_id")
    return seqs.select(
        "item_id", F.col("line").cast("bigint").alias("line"), F.col("length").cast("bigint").alias("length"),
        F.array_join(F.col("x").cast("array<string>"), " ").alias("x"), "y",
    )


NEXT_SQL = f"""l AS (SELECT unnest(string_split(text, chr(10))) AS t FROM documents),
    a AS (SELECT {words_sql("t")} AS ws FROM l),
    p AS (SELECT unnest(ws[1:-2]) AS word, unnest(ws[2:]) AS next FROM a WHERE len(ws) > 1),
    c AS (SELECT word, next, count(*) AS n FROM p GROUP BY ALL),
    model AS (SELECT word, next FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, next) AS r FROM c) WHERE r = 1)"""


@query("x3_next_words", f"WITH {NEXT_SQL} SELECT word, next FROM model")
def _(spark, sf):
    return text.next_words(documents(spark, sf), "text")


@query(
    "x3_continue_texts",
    f"""WITH {NEXT_SQL.replace("model AS (", "model AS MATERIALIZED (")}, s0 AS MATERIALIZED (SELECT item_id, text AS g, {words_sql("text")}[-1] AS last FROM benchmark),
    """
    + ",\n".join(
        f"s{i + 1} AS MATERIALIZED (SELECT item_id, CASE WHEN next IS NULL THEN g ELSE g || ' ' || next END AS g, next AS last FROM s{i} LEFT JOIN model ON word = last)"
        for i in range(5)
    )
    + " SELECT item_id, g AS generated FROM s5",
)
def _(spark, sf):
    model = text.next_words(documents(spark, sf), "text")
    return text.continue_texts(table(spark, sf, "benchmark"), model, "text").select("item_id", "generated")


# ---- clean-up and chunking

def strip_sql(column):
    return f"regexp_replace({column}, '^{BLANKS}|{BLANKS}$', '', 'g')"



BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"


@query(
    "x4_clean_lines",
    f"""SELECT doc_id, md5(array_to_string(list_filter(list_transform(regexp_split_to_array(text, '{BREAKS}'),
        lambda x: {strip_sql("x")}), lambda x: x <> ''), chr(10))) AS digest FROM documents""",
)
def _(spark, sf):
    return documents(spark, sf).select("doc_id", F.md5(texts.clean_lines("text").cast("binary")).alias("digest"))


def sentences_sql(column, mark="chr(1)"):
    lines_ = f"list_filter(list_transform(string_split({column}, chr(10)), lambda x: {strip_sql('x')}), lambda x: x <> '')"
    cut_ = f"string_split(regexp_replace(p, '([.!?]){BLANKS}', '\\1' || {mark}, 'g'), {mark})"
    return f"list_filter(list_transform(flatten(list_transform({lines_}, lambda p: {cut_})), lambda x: {strip_sql('x')}), lambda x: x <> '')"


@query(
    "x5_sentences",
    f"""WITH s AS (SELECT doc_id, {sentences_sql("text")} AS s FROM documents)
        SELECT doc_id, unnest(range(len(s))) AS pos, unnest(s) AS sentence FROM s""",
)
def _(spark, sf):
    rows = documents(spark, sf).select("doc_id", F.posexplode(texts.sentences("text")).alias("pos", "sentence"))
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def packed(spark, sf):
    return text.sentence_chunks(documents(spark, sf), "doc_id", "text")


@query(
    "x6_sentence_chunks",
    f"""WITH RECURSIVE docs AS MATERIALIZED (SELECT doc_id, {sentences_sql("text")} AS s FROM documents),
    one AS (SELECT doc_id, i, n, sum(n) OVER (PARTITION BY doc_id ORDER BY i) - n AS b FROM
            (SELECT doc_id, unnest(range(len(s))) AS i, unnest(list_transform(s, lambda x: length(x))) AS n FROM docs)),
    arr AS MATERIALIZED (SELECT doc_id, list(b ORDER BY i) AS bs, list(b + n ORDER BY i) AS es, count(*) AS n FROM one GROUP BY doc_id),
    walk(doc_id, chunk_index, start, nxt, stop, bs, es, n) AS (
        SELECT doc_id, 0, 0, 1, CAST(NULL AS BIGINT), bs, es, n FROM arr
        UNION ALL
        SELECT doc_id, chunk_index + 1,
               greatest(start, coalesce(list_min(list_filter(range(stop), lambda j: bs[stop + 1] - bs[j + 1] <= 150)), stop)),
               stop + 1, stop, bs, es, n
        FROM (SELECT doc_id, chunk_index, start, bs, es, n,
                     list_min(list_filter(range(nxt, n), lambda i: es[i + 1] - bs[start + 1] > 800)) AS stop FROM walk) WHERE stop IS NOT NULL),
    spans AS (SELECT doc_id, chunk_index, start, coalesce(lead(stop) OVER (PARTITION BY doc_id ORDER BY chunk_index), n) AS stop FROM walk)
    SELECT doc_id, CAST(chunk_index AS BIGINT) AS chunk_index, md5(array_to_string(s[start + 1:stop], ' ')) AS digest,
           CAST(doc_id AS VARCHAR) || '::chunk' || CAST(chunk_index AS VARCHAR) AS chunk_id
    FROM spans JOIN docs USING (doc_id)""",
)
def _(spark, sf):
    return packed(spark, sf).select(
        "doc_id", F.col("chunk_index").cast("bigint").alias("chunk_index"), F.md5(F.col("text").cast("binary")).alias("digest"), "chunk_id"
    )


SECTIONED_SQL = """lined AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)"""


def sectioned(spark, sf):
    """Documents whose lines each got a numbered header, below a title line."""
    numbered = F.transform(
        texts.lines("text"),
        lambda x, i: F.concat(F.lit("## "), i.cast("string"), F.lit(". Part "), i.cast("string"), F.lit("\n"), x),
    )
    title = F.concat(F.lit("Doc "), F.col("doc_id").cast("string"))
    return documents(spark, sf).select(
        "doc_id", title.alias("title"), F.concat(F.lit("# "), title, F.lit("\n"), F.array_join(numbered, "\n")).alias("text")
    )


@query(
    "x7_sections",
    f"""WITH {SECTIONED_SQL} SELECT doc_id, CAST(i AS VARCHAR) AS section_number, 'Part ' || CAST(i AS VARCHAR) AS section_title,
        {strip_sql("t")} AS body FROM lined""",
)
def _(spark, sf):
    parts = text.sections(sectioned(spark, sf), "doc_id", "text", "title")
    return parts.select("doc_id", "section_number", "section_title", "body")


@query(
    "x7_without_headers",
    "SELECT doc_id, text AS body FROM documents",
)
def _(spark, sf):
    docs = documents(spark, sf).withColumn("title", F.lit("untitled"))
    return text.sections(docs, "doc_id", "text", "title").filter(F.col("section_number").isNull()).select("doc_id", "body")


WINDOW_SQL = """pieces AS (SELECT *, CASE WHEN length(body) <= 800 THEN [0] ELSE
        range(0, CAST(ceil((length(body) - 800) / 680.0) AS BIGINT) * 680 + 1, 680) END AS starts FROM parts),
    each AS (SELECT *, unnest(starts) AS offs, unnest(range(len(starts))) AS piece, len(starts) AS n FROM pieces)"""


@query(
    "x8_window_chunks",
    f"""WITH {SECTIONED_SQL}, parts AS (SELECT doc_id, i, {strip_sql("t")} AS body FROM lined), {WINDOW_SQL}
        SELECT CAST(doc_id AS VARCHAR) || '-' || CAST(i AS VARCHAR) || CASE WHEN n > 1 THEN '.' || CAST(piece AS VARCHAR) ELSE '' END AS chunk_id,
               md5('[Doc ' || CAST(doc_id AS VARCHAR) || '. Doc ' || CAST(doc_id AS VARCHAR) || ' — Section ' || CAST(i AS VARCHAR) || ': Part '
                   || CAST(i AS VARCHAR) || ']' || chr(10) || {strip_sql("substr(body, offs + 1, 800)")}) AS digest FROM each""",
)
def _(spark, sf):
    chunks = text.window_chunks(text.sections(sectioned(spark, sf), "doc_id", "text", "title"), "doc_id")
    return chunks.select("chunk_id", F.md5(F.col("text").cast("binary")).alias("digest"))


@query(
    "x8_whole_windows",
    f"""WITH parts AS (SELECT doc_id, text AS body FROM documents), {WINDOW_SQL}
        SELECT CAST(doc_id AS VARCHAR) || '-full' || CASE WHEN n > 1 THEN '.' || CAST(piece AS VARCHAR) ELSE '' END AS chunk_id,
               md5('[Doc ' || CAST(doc_id AS VARCHAR) || '. Doc ' || CAST(doc_id AS VARCHAR) || ']' || chr(10)
                   || {strip_sql("substr(body, offs + 1, 800)")}) AS digest FROM each""",
)
def _(spark, sf):
    return window_chunks(spark, sf).select("chunk_id", F.md5(F.col("text").cast("binary")).alias("digest"))


def window_chunks(spark, sf):
    """Fixed windows over the plain documents."""
    title = F.concat(F.lit("Doc "), F.col("doc_id").cast("string"))
    docs = documents(spark, sf).select("doc_id", title.alias("title"), "text")
    return text.window_chunks(text.sections(docs, "doc_id", "text", "title"), "doc_id")


# ---- term weights and search

TOKENS_SQL = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"
STOP_SQL = "[" + ", ".join(f"'{w}'" for w in texts.STOP_WORDS) + "]"


KEPT_SQL = f"kept AS MATERIALIZED (SELECT doc_id, list_filter({TOKENS_SQL.format('text')}, lambda t: NOT list_contains({STOP_SQL}, t)) AS k FROM documents)"
GRAMS_SQL = "list_concat({0}, list_transform(list_zip({0}[1:-2], {0}[2:]), lambda z: z[1] || ' ' || z[2]))"


def weights_sql(source, key, column, terms, name, tf="tf", expr=TOKENS_SQL):
    toks = expr.format(column)
    return f"""{name}_tf AS (SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest({toks}) AS term FROM {source}) GROUP BY ALL),
    {name}_raw AS (SELECT {key}, term, ({tf}) * idf AS raw FROM {name}_tf JOIN {terms} USING (term)),
    {name} AS (SELECT {key}, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY {key})) AS weight FROM {name}_raw)"""


def terms_sql(source, key, column, name="terms", expr=TOKENS_SQL):
    toks = expr.format(column)
    return f"""{name}_c AS (SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest({toks}) AS term FROM {source}) GROUP BY ALL),
    {name} AS (SELECT term, sum(tf) AS n, count(*) AS df, ln((1 + (SELECT count(*) FROM {source})) / (1 + count(*))) + 1 AS idf
        FROM {name}_c GROUP BY term ORDER BY n DESC, term LIMIT 4096)"""


DOC_TERMS = terms_sql("documents", "doc_id", "text")
DOC_WEIGHTS = weights_sql("documents", "doc_id", "text", "terms", "idx")


@query("x9_term_weights", f"WITH {DOC_TERMS}, {DOC_WEIGHTS} SELECT doc_id, term, round(weight, 6) AS weight FROM idx")
def _(spark, sf):
    docs = documents(spark, sf)
    terms = retrieval.fit_terms(docs, "doc_id", "text")
    return rounded(retrieval.term_weights(docs, terms, "doc_id", "text"), 6, "weight")


@query(
    "x10_bigram_weights",
    f"""WITH {KEPT_SQL}, {terms_sql("kept", "doc_id", "k", expr=GRAMS_SQL)}, {weights_sql("kept", "doc_id", "k", "terms", "idx", tf="1 + ln(tf)", expr=GRAMS_SQL)}
        SELECT doc_id, term, round(weight, 6) AS weight FROM idx""",
)
def _(spark, sf):
    docs, stop = documents(spark, sf), texts.STOP_WORDS
    terms = retrieval.fit_terms(docs, "doc_id", "text", stop_words=stop)
    return rounded(retrieval.term_weights(docs, terms, "doc_id", "text", stop_words=stop, sublinear=True), 6, "weight")


CHUNKS_SQL = f"""parts AS (SELECT doc_id, text AS body FROM documents), {WINDOW_SQL},
    chunks AS MATERIALIZED (SELECT CAST(doc_id AS VARCHAR) || '-full' || CASE WHEN n > 1 THEN '.' || CAST(piece AS VARCHAR) ELSE '' END AS chunk_id,
        'Doc ' || CAST(doc_id AS VARCHAR) AS title,
        '[Doc ' || CAST(doc_id AS VARCHAR) || '. Doc ' || CAST(doc_id AS VARCHAR) || ']' || chr(10) || {strip_sql("substr(body, offs + 1, 800)")} AS text FROM each),
    questions AS (SELECT item_id AS question_id, text AS question FROM benchmark)"""
FOUND_SQL = f"""{CHUNKS_SQL}, {terms_sql("chunks", "chunk_id", "text")}, {weights_sql("chunks", "chunk_id", "text", "terms", "idx")},
    {weights_sql("questions", "question_id", "question", "terms", "asked")},
    scored AS (SELECT question_id, chunk_id, round(sum(a.weight * i.weight), 9) AS score FROM asked a JOIN idx i USING (term) GROUP BY ALL),
    found AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, chunk_id) AS rank FROM scored) WHERE rank <= 4)"""


def questions(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))


def searched(spark, sf):
    """Chunks, questions and the best four chunks of each."""
    chunks, asked = cut(window_chunks(spark, sf)), questions(spark, sf)
    terms = cut(retrieval.fit_terms(chunks, "chunk_id", "text"))
    index = retrieval.term_weights(chunks, terms, "chunk_id", "text")
    weights = retrieval.term_weights(asked, terms, "question_id", "question")
    return chunks, asked, cut(retrieval.search_terms(index, weights))


@query(
    "x11_search",
    f"""WITH {FOUND_SQL} SELECT question_id, CAST(rank AS BIGINT) AS rank, chunk_id, round(score, 4) AS score, substr(text, 1, 200) AS excerpt
        FROM found JOIN chunks USING (chunk_id)""",
)
def _(spark, sf):
    chunks, _asked, found = searched(spark, sf)
    return retrieval.source_rows(found, chunks).withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "x12_dense_search",
    """WITH u AS (SELECT vec_id, label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))) AS v FROM embeddings),
       s AS (SELECT q.vec_id AS question_id, d.vec_id AS vec_id, list_dot_product(q.v, d.v) AS score FROM u q, u d),
       r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, vec_id) AS rank FROM s)
       SELECT question_id, vec_id, CAST(rank AS BIGINT) AS rank, round(score, 6) AS score FROM r WHERE rank <= 4""",
)
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    asked = e.select(F.col("vec_id").alias("question_id"), "embedding")
    out = retrieval.search_vectors(e, asked)
    return rounded(out.withColumn("rank", F.col("rank").cast("bigint")), 6, "score")


@query("x12_approximate_search")
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    out = vectors.search_index(vectors.build_index(e), e.select(F.col("vec_id").alias("question_id"), "embedding"))
    return rounded(out.withColumn("rank", F.col("rank").cast("bigint")), 6, "score")


@query(
    "x13_relevance_gate",
    f"""WITH {FOUND_SQL}, b AS (SELECT question_id, max(score) AS best, string_agg(chunk_id, '|' ORDER BY rank) AS cited FROM found GROUP BY 1)
        SELECT q.question_id AS question_id, CAST(coalesce(best >= 0.5, false) AS BIGINT) AS success, round(best, 4) AS best,
               CASE WHEN best >= 0.5 THEN cited END AS cited FROM questions q LEFT JOIN b ON q.question_id = b.question_id""",
)
def _(spark, sf):
    _chunks, asked, found = searched(spark, sf)
    gate = retrieval.relevance_gate(found, asked, threshold=0.5)
    cited = F.when(F.col("citations").isNotNull(), F.array_join(F.transform("citations", lambda c: c["chunk"]), "|"))
    return gate.select("question_id", F.col("success").cast("bigint").alias("success"), F.round("best", 4).alias("best"), cited.alias("cited"))


SECTION_CHUNKS_SQL = f"""{SECTIONED_SQL}, parts AS (SELECT doc_id, i, {strip_sql("t")} AS body FROM lined), {WINDOW_SQL},
    chunks AS MATERIALIZED (SELECT CAST(doc_id AS VARCHAR) AS document, CAST(i AS VARCHAR) AS section, 'Doc ' || CAST(doc_id AS VARCHAR) AS title,
        CAST(doc_id AS VARCHAR) || '-' || CAST(i AS VARCHAR) || CASE WHEN n > 1 THEN '.' || CAST(piece AS VARCHAR) ELSE '' END AS chunk_id,
        '[Doc ' || CAST(doc_id AS VARCHAR) || '. Doc ' || CAST(doc_id AS VARCHAR) || ' — Section ' || CAST(i AS VARCHAR) || ': Part '
            || CAST(i AS VARCHAR) || ']' || chr(10) || {strip_sql("substr(body, offs + 1, 800)")} AS text FROM each),
    kept AS MATERIALIZED (SELECT chunk_id, list_filter({TOKENS_SQL.format("text")}, lambda t: NOT list_contains({STOP_SQL}, t)) AS k FROM chunks),
    asking AS MATERIALIZED (SELECT item_id AS question_id, list_filter({TOKENS_SQL.format("text")}, lambda t: NOT list_contains({STOP_SQL}, t)) AS k FROM benchmark)"""


@query(
    "x13_section_citations",
    f"""WITH {SECTION_CHUNKS_SQL}, {terms_sql("kept", "chunk_id", "k", expr=GRAMS_SQL)},
    {weights_sql("kept", "chunk_id", "k", "terms", "idx", tf="1 + ln(tf)", expr=GRAMS_SQL)},
    {weights_sql("asking", "question_id", "k", "terms", "asked", tf="1 + ln(tf)", expr=GRAMS_SQL)},
    scored AS (SELECT question_id, chunk_id, round(sum(a.weight * i.weight), 9) AS score FROM asked a JOIN idx i USING (term) GROUP BY ALL),
    found AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, chunk_id) AS rank FROM scored) WHERE rank <= 4),
    b AS (SELECT question_id, max(score) AS best, string_agg(chunk_id || '|' || document || '|' || section || '|' || title, ';' ORDER BY rank) AS cited
          FROM found JOIN chunks USING (chunk_id) GROUP BY 1)
    SELECT q.question_id AS question_id, CAST(coalesce(best >= 0.15, false) AS BIGINT) AS success, round(best, 4) AS best,
           CASE WHEN best >= 0.15 THEN cited END AS cited FROM asking q LEFT JOIN b ON q.question_id = b.question_id""",
)
def _(spark, sf):
    stop = texts.STOP_WORDS
    chunks = cut(text.window_chunks(text.sections(sectioned(spark, sf), "doc_id", "text", "title"), "doc_id"))
    asked = questions(spark, sf)
    terms = cut(retrieval.fit_terms(chunks, "chunk_id", "text", stop_words=stop))
    index = retrieval.term_weights(chunks, terms, "chunk_id", "text", stop_words=stop, sublinear=True)
    weights = retrieval.term_weights(asked, terms, "question_id", "question", stop_words=stop, sublinear=True)
    found = cut(retrieval.search_terms(index, weights))
    gate = retrieval.relevance_gate(found, asked, chunks=chunks)
    one = lambda c: F.concat_ws("|", c["chunk"], c["document"], c["section"], c["title"])
    cited = F.when(F.col("citations").isNotNull(), F.array_join(F.transform("citations", one), ";"))
    return gate.select("question_id", F.col("success").cast("bigint").alias("success"), F.round("best", 4).alias("best"), cited.alias("cited"))


@query(
    "x14_numbered_context",
    f"""WITH {FOUND_SQL}, c AS (SELECT question_id, string_agg('[Excerpt ' || CAST(rank AS VARCHAR) || ']' || chr(10) || text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS ctx
            FROM found JOIN chunks USING (chunk_id) GROUP BY 1)
        SELECT question_id, md5('Context from the document:' || chr(10) || chr(10) || ctx || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'Question: ' || question
               || chr(10) || chr(10) || 'Answer using only the context above:') AS digest FROM c JOIN questions USING (question_id)""",
)
def _(spark, sf):
    chunks, asked, found = searched(spark, sf)
    prompts = retrieval.numbered_context(found, chunks, asked)
    return prompts.select("question_id", F.md5(F.col("prompt").cast("binary")).alias("digest"))


@query(
    "x14_labelled_context",
    f"""WITH {FOUND_SQL} SELECT question_id, md5(string_agg('[' || title || ']' || chr(10) || text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank)) AS digest
        FROM found JOIN chunks USING (chunk_id) GROUP BY 1""",
)
def _(spark, sf):
    chunks, _asked, found = searched(spark, sf)
    return retrieval.labelled_context(found, chunks).select("question_id", F.md5(F.col("context").cast("binary")).alias("digest"))


WORDS_SQL = "list_distinct(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]+'))"
SCORED_SQL = f"""asked_words AS (SELECT question_id, list_filter({WORDS_SQL.format("question")}, lambda w: NOT list_contains({STOP_SQL}, w)) AS q FROM questions),
    cutup AS (SELECT question_id, rank, string_split(regexp_replace(text, '([.!?]){BLANKS}', '\\1' || chr(1), 'g'), chr(1)) AS ss FROM found JOIN chunks USING (chunk_id)),
    sents AS (SELECT question_id, rank, unnest(ss) AS s, unnest(range(len(ss))) AS pos FROM cutup),
    hits AS (SELECT question_id, rank, pos, {strip_sql("s")} AS sentence, len(list_intersect({WORDS_SQL.format("s")}, q)) AS overlap
             FROM sents JOIN asked_words USING (question_id))"""


@query(
    "x15_sentence_scores",
    f"WITH {FOUND_SQL}, {SCORED_SQL} SELECT question_id, CAST(rank AS BIGINT) AS rank, pos, sentence, CAST(overlap AS BIGINT) AS overlap FROM hits WHERE overlap > 0",
)
def _(spark, sf):
    chunks, asked, found = searched(spark, sf)
    scored = retrieval.scored_sentences(found, chunks, asked)
    return scored.withColumns({c: F.col(c).cast("bigint") for c in ("rank", "pos", "overlap")})


@query(
    "x15_extractive_answers",
    f"""WITH {FOUND_SQL}, {SCORED_SQL},
        top AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY overlap DESC, rank, pos) AS r FROM hits WHERE overlap > 0),
        ans AS (SELECT question_id, string_agg(sentence, ' ' ORDER BY r) AS a FROM top WHERE r <= 3 GROUP BY 1),
        f AS (SELECT question_id, 'I couldn''t find a direct answer in the retrieved context. Here''s the most relevant excerpt I found:' || chr(10) || chr(10)
              || substr(text, 1, 400) AS a FROM found JOIN chunks USING (chunk_id) WHERE rank = 1)
        SELECT q.question_id AS question_id, coalesce(ans.a, f.a, 'I don''t have enough information in the document to answer that.') AS answer
        FROM questions q LEFT JOIN ans ON q.question_id = ans.question_id LEFT JOIN f ON q.question_id = f.question_id""",
)
def _(spark, sf):
    chunks, asked, found = searched(spark, sf)
    return retrieval.extractive_answers(found, chunks, asked)


@query(
    "x15_verbatim_answers",
    f"""WITH {FOUND_SQL} SELECT question_id, 'From ' || title || ':' || chr(10) || chr(10) || substr(text, strpos(text, ']' || chr(10)) + 2) AS answer
        FROM found JOIN chunks USING (chunk_id) WHERE rank = 1""",
)
def _(spark, sf):
    chunks, _asked, found = searched(spark, sf)
    return retrieval.verbatim_answers(found, chunks)


@query(
    "s6_index_round_trip",
    f"WITH {DOC_TERMS}, {DOC_WEIGHTS} SELECT doc_id, CAST(count(*) AS BIGINT) AS terms, round(sum(weight), 5) AS total FROM idx GROUP BY doc_id",
)
def _(spark, sf):
    docs = documents(spark, sf)
    path = scratch_path(spark, "term-index")
    index = retrieval.term_weights(docs, retrieval.fit_terms(docs, "doc_id", "text"), "doc_id", "text")
    files.save_index(index, path)
    assert files.index_exists(spark, path) and not files.index_exists(spark, path + "-absent")
    return files.load_index(spark, path).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("terms"), F.round(F.sum("weight"), 5).alias("total")
    )


@query(
    "s6_vector_round_trip",
    """SELECT vec_id, round(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))))), 6) AS total
       FROM embeddings""",
)
def _(spark, sf):
    path = scratch_path(spark, "vector-index")
    e = table(spark, sf, "embeddings")
    files.save_index(e.select("vec_id", "label", normalised("embedding").alias("v")), path, "label")
    total = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x)
    return files.load_index(spark, path).select("vec_id", F.round(total, 6).alias("total"))


@query(
    "x16_keywords",
    f"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(list_filter(regexp_split_to_array(text, '{BLANKS}'),
        lambda w: length(w) > 4), lambda w: lower(w))))[1:5], ' ') AS keywords FROM documents""",
)
def _(spark, sf):
    return documents(spark, sf).select("doc_id", F.array_join(texts.keywords("text"), " ").alias("keywords"))


@query(
    "x11_padded_search",
    f"""WITH {FOUND_SQL}, pool AS (SELECT chunk_id, row_number() OVER (ORDER BY chunk_id) AS p FROM chunks),
        have AS (SELECT question_id, count(*) AS n FROM found GROUP BY 1),
        free AS (SELECT q.question_id AS question_id, pool.chunk_id AS chunk_id, coalesce(n, 0) + row_number() OVER (PARTITION BY q.question_id ORDER BY pool.chunk_id) AS rank
                 FROM questions q JOIN pool ON p <= 8 LEFT JOIN have ON have.question_id = q.question_id
                 WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.question_id = q.question_id AND f.chunk_id = pool.chunk_id))
        SELECT question_id, chunk_id, CAST(rank AS BIGINT) AS rank, round(score, 6) AS score FROM found
        UNION ALL SELECT question_id, chunk_id, CAST(rank AS BIGINT) AS rank, 0.0::DOUBLE AS score FROM free WHERE rank <= 4""",
)
def _(spark, sf):
    chunks, asked, found = searched(spark, sf)
    padded = retrieval.pad_results(found, asked, chunks)
    return rounded(padded.withColumn("rank", F.col("rank").cast("bigint")), 6, "score")
