"""Queries: routing, slots and templated answers over a question table built from the customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.scalars import length_of_stay
from tidemill.operators import questions as ask
from tidemill.operators.star import attach_key, build_dimension
from tidemill.plans.registry import query
from tidemill.plans.tables import BLANKS
from tidemill.plans.timeline import rounded
from tidemill.plans.views import ADMISSIONS_SQL, admissions, table
from tidemill.session import cut, spread

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]
ALIASES = {"builders": "BUILDING", "critical": "1-URGENT", "finished": "F"}
NAMED = r"dr\.?\s+([a-z0-9#]+)"
TODAY = "1998-08-03"

# one question per customer; the nation decides the wording
KINDS = [
    (4, "'What is the average length of stay for ' || c_mktsegment || ' patients?'"),
    (6, "'Average stay of critical cases older than ' || CAST(30 + c_nationkey AS VARCHAR)"),
    (9, "'How many ' || c_mktsegment || ' patients had 2-HIGH admission?'"),
    (11, "'count builders with result finished'"),
    (14, "'Show ' || c_mktsegment || ' patients older than ' || CAST(50 + c_nationkey AS VARCHAR)"),
    (16, "'List 5-LOW patients aged under ' || CAST(20 + c_nationkey AS VARCHAR)"),
    (18, "'Which ' || c_mktsegment || ' cases came this week?'"),
    (22, "'Which patients saw Dr. ' || c_name || '?'"),
    (25, "'What is the visitor policy in nation ' || CAST(c_nationkey AS VARCHAR) || '?'"),
]
TEXT_SQL = "CASE " + " ".join(f"WHEN c_nationkey < {n} THEN {t}" for n, t in KINDS) + " END"
ASKED_SQL = f"asked AS (SELECT c_custkey AS question_id, {TEXT_SQL} AS question FROM customer)"


def asked(spark, sf):
    return spread(table(spark, sf, "customer")).select(F.col("c_custkey").alias("question_id"), F.expr(TEXT_SQL.replace("VARCHAR", "STRING")).alias("question"))


ROUTED_TEXT = "CASE role WHEN 'user' THEN 'Extract keywords From ' || text WHEN 'assistant' THEN 'Calculate ' || CAST(length(text) AS VARCHAR) || ' + 1' ELSE text END"


def tool_questions(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", F.expr(ROUTED_TEXT.replace("VARCHAR", "STRING")).alias("q"))


KEYWORDS_SQL = (
    "array_to_string(list_sort(list_distinct(list_transform(list_filter(regexp_split_to_array({0}, '" + BLANKS.replace("{", "{{").replace("}", "}}")
    + "'), lambda w: length(w) > 4), lambda w: lower(w))))[1:5], ', ')"
)


@query(
    "x17_tool_route",
    f"""WITH c AS (SELECT conv_id, turn, {ROUTED_TEXT} AS q FROM conversations)
        SELECT conv_id, turn, CASE WHEN contains(lower(q), 'calculate') THEN 'calculation' WHEN contains(lower(q), 'keyword') THEN 'keywords' ELSE 'general' END AS type,
          CASE WHEN contains(lower(q), 'calculate') THEN trim(replace(lower(q), 'calculate', ''))
               WHEN contains(lower(q), 'keyword') THEN {KEYWORDS_SQL.format("CASE WHEN contains(lower(q), 'from') THEN substr(q, strpos(lower(q), 'from') + 4) ELSE q END")}
               ELSE 'You asked: ' || q || '. This is a general response.' END AS result FROM c""",
)
def _(spark, sf):
    routed = ask.tool_route(tool_questions(spark, sf), "q")
    parsed = F.from_json("answer", "type string, result string")
    return routed.select("conv_id", "turn", parsed["type"].alias("type"), parsed["result"].alias("result"))


@query(
    "x17_source_route",
    f"""WITH {ASKED_SQL}, h AS (SELECT question_id, list_bool_or(list_transform([{", ".join(f"'{h}'" for h in ask.DATA_HINTS)}], lambda h: contains(lower(question), h))) AS d,
        list_bool_or(list_transform([{", ".join(f"'{h}'" for h in ask.POLICY_HINTS)}], lambda h: contains(lower(question), h))) AS p FROM asked)
        SELECT question_id, CASE WHEN d AND p THEN 'hybrid' WHEN d THEN 'sql' WHEN p THEN 'rag' ELSE 'clarify' END AS route,
               CASE WHEN d AND p THEN 0.5 WHEN d THEN 0.55 WHEN p THEN 0.55 ELSE 0.3 END::DOUBLE AS confidence FROM h""",
)
def _(spark, sf):
    return ask.source_route(asked(spark, sf), "question").select("question_id", "route", "confidence")


@query(
    "x17_route_conversations",
    """WITH h AS (SELECT conv_id, turn, contains(lower(text), 'the ') OR contains(lower(text), 'ation') AS d,
           contains(lower(text), 'que') OR contains(lower(text), 'sch') AS p FROM conversations)
       SELECT conv_id, turn, CASE WHEN d AND p THEN 'hybrid' WHEN d THEN 'sql' WHEN p THEN 'rag' ELSE 'clarify' END AS route FROM h""",
)
def _(spark, sf):
    routed = ask.source_route(table(spark, sf, "conversations"), "text", ("the ", "ation"), ("que", "sch"))
    return routed.select("conv_id", "turn", "route")


def _option_sql(options, strict=True):
    pairs = [(a, c) for a, c in ALIASES.items() if c in options] + [(o.lower(), o) for o in options]
    test = "regexp_matches(low, '\\b{0}\\b')" if strict else "contains(low, '{0}')"
    return "CASE " + " ".join(f"WHEN {test.format(p)} THEN '{v}'" for p, v in pairs) + " END"


def slots_sql(strict=True):
    return f"""{ASKED_SQL}, lowered AS (SELECT question_id, question, lower(question) AS low FROM asked),
    raw AS (SELECT question_id, question, low, {_option_sql(SEGMENTS, strict)} AS condition, {_option_sql(PRIORITIES, strict)} AS admission_type, {_option_sql(STATUSES, strict)} AS result,
        TRY_CAST(regexp_extract(low, '(older than |above age |aged? over ?|aged? > ?)(\\d+)', 2) AS BIGINT) AS older,
        TRY_CAST(regexp_extract(low, '(younger than |below age |aged? under ?|aged? < ?)(\\d+)', 2) AS BIGINT) AS younger,
        nullif(regexp_extract(low, 'dr\\.?\\s+([a-z0-9#]+)', 1), '') AS d, contains(low, 'this week') AS week FROM lowered),
    slots AS (SELECT question_id, condition, admission_type, result, older, younger,
        CASE WHEN d IS NOT NULL THEN upper(d[1:1]) || d[2:] END AS doctor, week,
        CASE WHEN contains(low, 'average') AND contains(low, 'stay') THEN 'average'
             WHEN contains(low, 'how many') OR starts_with(trim(low), 'count') THEN 'count' WHEN d IS NOT NULL THEN 'doctor'
             WHEN condition IS NOT NULL OR admission_type IS NOT NULL OR older IS NOT NULL OR younger IS NOT NULL OR week OR contains(low, 'recent') THEN 'list'
             ELSE 'none' END AS template FROM raw)"""


def slots(spark, sf, strict=True):
    return ask.extract_slots(
        asked(spark, sf), "question", SEGMENTS, PRIORITIES, STATUSES, ALIASES, NAMED, strict=strict
    ).drop("question")


SLOT_COLUMNS = "question_id, condition, admission_type, result, older, younger, doctor, CAST(week AS BIGINT) AS week, template"


def _slot_query(strict):
    def run(spark, sf):
        return slots(spark, sf, strict).withColumn("week", F.col("week").cast("bigint"))

    return run


query("x18_slots", f"WITH {slots_sql()} SELECT {SLOT_COLUMNS} FROM slots")(_slot_query(True))
query("x18_slots_loose", f"WITH {slots_sql(False)} SELECT {SLOT_COLUMNS} FROM slots")(_slot_query(False))


def _facts(spark, sf):
    """Fact with doctor keys and stays, and the doctor dimension."""
    flat = cut(admissions(spark, sf).withColumn("stay_days", length_of_stay("admitted", "discharged")))
    doctors = cut(build_dimension(flat, "doctor", "doctor_id"))
    return attach_key(flat, "doctor", doctors, "doctor_id"), doctors


FACTS_SQL = f"""{ADMISSIONS_SQL}, facts AS MATERIALIZED (SELECT *, CASE WHEN discharged IS NOT NULL THEN greatest(date_diff('day', admitted, discharged), 0) END AS stay_days FROM admissions)"""


def fit_sql(strict, lists=False):
    cat = "(s.{0} IS NULL OR s.{0} = f.{0})"
    parts = [cat.format("condition"), cat.format("admission_type")]
    ages = ["(s.older IS NULL OR f.age > s.older)", "(s.younger IS NULL OR f.age < s.younger)"]
    if strict or lists:
        parts += [cat.format("result"), *ages]
    else:
        parts.append("(s.template <> 'count' OR " + cat.format("result") + ")")
    return " AND ".join(parts)


def numbers_sql(strict):
    return f"""numbers AS (SELECT s.question_id, s.template, CASE WHEN s.template = 'average' THEN avg(stay_days) END AS avg_stay,
        CASE WHEN s.template = 'count' THEN CAST(count(f.admission_id) AS BIGINT) END AS patients
        FROM slots s LEFT JOIN facts f ON {fit_sql(strict)} WHERE s.template IN ('average', 'count') GROUP BY s.question_id, s.template)"""


def lists_sql(strict):
    week = f"(NOT s.week OR f.admitted >= DATE '{TODAY}' - 7)"
    named = f"contains(lower(f.doctor), lower(s.doctor))" + (f" AND {fit_sql(True, True)} AND {week}" if strict else "")
    return f"""lists AS (SELECT * FROM (SELECT s.question_id, s.template, f.admission_id, f.patient_name, f.age, f.gender, f.condition, f.admission_type, f.admitted,
            row_number() OVER (PARTITION BY s.question_id ORDER BY f.admitted DESC, f.admission_id) AS rank
        FROM slots s JOIN facts f ON (s.template = 'list' AND {fit_sql(True, True)} AND {week}) OR (s.template = 'doctor' AND {named}))
        WHERE rank <= 200)"""


def _number_query(strict):
    def run(spark, sf):
        fact, _doctors = _facts(spark, sf)
        return rounded(ask.answer_numbers(slots(spark, sf, strict), fact, strict), 4, "avg_stay")

    return run


def _list_query(strict):
    def run(spark, sf):
        fact, doctors = _facts(spark, sf)
        rows = ask.answer_lists(slots(spark, sf, strict), fact, doctors, TODAY, strict)
        return rows.drop("result").withColumns({"admitted": F.col("admitted").cast("string"), "rank": F.col("rank").cast("bigint")})

    return run


for _strict, _suffix in ((True, ""), (False, "_loose")):
    _base = f"WITH {slots_sql(_strict)}, {FACTS_SQL}"
    query(
        f"x19_answer_numbers{_suffix}",
        f"{_base}, {numbers_sql(_strict)} SELECT question_id, template, round(avg_stay, 4) AS avg_stay, patients FROM numbers",
    )(_number_query(_strict))
    query(
        f"x19_answer_lists{_suffix}",
        f"""{_base}, {lists_sql(_strict)} SELECT question_id, template, admission_id, patient_name, age, gender, condition, admission_type,
            CAST(admitted AS VARCHAR) AS admitted, CAST(rank AS BIGINT) AS rank FROM lists""",
    )(_list_query(_strict))


@query(
    "x20_answer_text",
    f"""WITH {slots_sql()}, {FACTS_SQL}, {numbers_sql(True)}, {lists_sql(True)}, k AS (SELECT question_id, count(*) AS n FROM lists GROUP BY 1)
        SELECT s.question_id AS question_id, s.template AS template, CAST(s.template <> 'none' AS BIGINT) AS success,
          CASE WHEN s.template = 'average' THEN 'Computes the average length of stay in days' || coalesce(' for ' || condition || ' patients', '')
                 || ' Result: ' || coalesce(CAST(round(avg_stay, 4) AS VARCHAR), 'None')
               WHEN s.template = 'count' THEN 'Counts admissions matching the requested filters. Result: ' || CAST(patients AS VARCHAR)
               WHEN s.template = 'none' THEN NULL WHEN k.n IS NULL THEN 'No matching records were found.'
               ELSE CASE s.template WHEN 'list' THEN 'Lists admissions matching the requested filters.'
                      ELSE 'Lists patients whose doctor''s name contains ''' || doctor || '''.' END || ' Found ' || CAST(k.n AS VARCHAR) || ' matching record(s).' END AS answer
        FROM slots s LEFT JOIN numbers USING (question_id) LEFT JOIN k ON s.question_id = k.question_id""",
)
def _(spark, sf):
    fact, doctors = _facts(spark, sf)
    s = cut(slots(spark, sf))
    out = ask.summarise(s, ask.answer_numbers(s, fact), ask.list_sizes(s, fact, doctors, TODAY))
    return out.withColumn("success", F.col("success").cast("bigint"))
