"""Queries: sources, projections, quality, joins, aggregates, sort and limit."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import arrays as arr
from tidemill.functions import scalars as sc
from tidemill.operators import aggregates as agg
from tidemill.operators import ordering, quality, star
from tidemill.plans.registry import query
from tidemill.plans.views import (
    ADMISSIONS_SQL, DELIVERIES_SQL, EMPLOYEES_SQL, admissions, day, deliveries, employees, table,
)
from tidemill.session import scratch_path
from tidemill.sources import files

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
MODELS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def text(column):
    return F.col(column).cast("string")


# ---- sources and sinks


@query(
    "s1_csv_scan",
    """SELECT o_orderkey, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority
       FROM orders""",
)
def _(spark, sf):
    path = scratch_path(spark, "orders-csv")
    rows = table(spark, sf, "orders").withColumn("o_orderdate", day("o_orderdate"))
    files.write_csv(rows.select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"), path)
    back = files.read_csv(
        spark, path, "o_orderkey bigint, o_totalprice double, o_orderdate date, o_orderpriority string"
    )
    return back.withColumn("o_orderdate", text("o_orderdate"))


@query(
    "s2_csv_sink",
    f"""WITH {ADMISSIONS_SQL}
        SELECT admission_id, CAST(discharged AS VARCHAR) AS discharged, billing FROM admissions""",
)
def _(spark, sf):
    path = scratch_path(spark, "admissions-csv")
    files.write_csv(admissions(spark, sf).select("admission_id", "discharged", "billing"), path)
    back = files.read_csv(spark, path, "admission_id bigint, discharged date, billing double")
    return back.withColumn("discharged", text("discharged"))


@query(
    "s3_document_scan",
    """SELECT 'Doc ' || CAST(item_id AS VARCHAR) AS title,
              CAST(length('# Doc ' || CAST(item_id AS VARCHAR) || chr(10) || text) AS BIGINT) AS chars
       FROM benchmark""",
)
def _(spark, sf):
    path = scratch_path(spark, "corpus")
    header = F.concat(F.lit("# Doc "), text("item_id"), F.lit("\n"), F.col("text"))
    # the sink ends each file with a line break of its own
    table(spark, sf, "benchmark").select("item_id", header.alias("value")).write.partitionBy("item_id").text(path)
    found = files.read_documents(spark, path)
    return found.select("title", (F.length("text") - 1).cast("bigint").alias("chars"))


@query(
    "s4_json_records",
    """SELECT p_type AS model, p_brand AS brand, CAST(count(*) AS BIGINT) AS parts, max(p_retailprice) AS top_price
       FROM part GROUP BY ALL""",
)
def _(spark, sf):
    path = scratch_path(spark, "metrics-json")
    rows = (
        table(spark, sf, "part")
        .groupBy(F.col("p_type").alias("model"), F.col("p_brand").alias("brand"))
        .agg(F.count(F.lit(1)).alias("parts"), F.max("p_retailprice").alias("top_price"))
    )
    files.write_json(rows, path)
    return files.read_json(spark, path, "model string, brand string, parts bigint, top_price double")


STAR_SQL = f"""
{ADMISSIONS_SQL},
clean AS (
  SELECT DISTINCT admission_id, age, condition, admitted, discharged, round(billing, 2) AS billing,
         'Customer#' || doctor[10:] AS doctor, hospital, insurer, admission_type, result,
         CASE WHEN discharged IS NOT NULL
              THEN greatest(date_diff('day', admitted, discharged), 0) END AS stay_days
  FROM admissions
),
doctors AS (SELECT doctor AS name, row_number() OVER (ORDER BY doctor) AS doctor_id FROM (SELECT DISTINCT doctor FROM clean)),
hospitals AS (SELECT hospital AS name, row_number() OVER (ORDER BY hospital) AS hospital_id FROM (SELECT DISTINCT hospital FROM clean)),
providers AS (SELECT insurer AS name, row_number() OVER (ORDER BY insurer) AS provider_id FROM (SELECT DISTINCT insurer FROM clean))"""


def load(spark, sf):
    return star.load_star(admissions(spark, sf), scratch_path(spark, "star"))


@query(
    "s5_star_load",
    f"""WITH {STAR_SQL}
        SELECT admission_id, doctor_id, hospital_id, provider_id, CAST(stay_days AS BIGINT) AS stay_days, billing
        FROM clean JOIN doctors ON doctor = doctors.name JOIN hospitals ON hospital = hospitals.name
        JOIN providers ON insurer = providers.name""",
)
def _(spark, sf):
    fact = load(spark, sf).admissions
    return fact.select(
        "admission_id", "doctor_id", "hospital_id", "provider_id", F.col("stay_days").cast("bigint").alias("stay_days"), "billing"
    )


# ---- projection, filter, cast, scalar functions


@query("p1_project_drop", "SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag", "l_tax").drop("l_tax")


@query(
    "p2_position_slice",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM
       (SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS i FROM orders) WHERE i >= 2 AND i < 5""",
)
def _(spark, sf):
    cols = ["o_orderkey", "o_custkey", "o_orderstatus"]
    rows = table(spark, sf, "orders").select(*cols, "o_totalprice")
    return ordering.slice_rows(rows, "o_totalprice", "o_orderkey", start=2, stop=5, columns=cols)


@query("p2_label_slice", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey BETWEEN 5 AND 6")
def _(spark, sf):
    return ordering.slice_labels(table(spark, sf, "orders"), "o_orderkey", 5, 6).select("o_orderkey", "o_totalprice")


@query(
    "p3_filter",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_quantity > 30 AND l_discount >= 0.05",
)
def _(spark, sf):
    kept = table(spark, sf, "lineitem").filter((F.col("l_quantity") > 30) & (F.col("l_discount") >= 0.05))
    return kept.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("p4_trim_rename", "SELECT n_nationkey AS nation_id, n_name AS nation FROM nation")
def _(spark, sf):
    untidy = table(spark, sf, "nation").select(F.col("n_nationkey").alias(" key "), F.col("n_name").alias("nation  "))
    return sc.strip_names(untidy, {"key": "nation_id"})


@query(
    "p5_coerce",
    """SELECT event_id, TRY_CAST(raw AS BIGINT) AS k FROM
       (SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE props->>'$.k' END AS raw FROM events)
       WHERE TRY_CAST(raw AS BIGINT) IS NOT NULL""",
)
def _(spark, sf):
    raw = F.when(F.col("event_type") == "error", "n/a").otherwise(F.get_json_object("props", "$.k"))
    rows = table(spark, sf, "events").select("event_id", sc.coerce(raw, "bigint").alias("k"))
    return quality.drop_nulls(rows, ["k"])


TITLE_SQL = (
    "array_to_string(list_transform(regexp_extract_all(trim({0}), '[A-Za-z]+|[^A-Za-z]+'), "
    "lambda x: upper(x[1:1]) || lower(x[2:])), '')"
)


@query(
    "p6_normalise_text",
    f"""SELECT o_orderkey, {TITLE_SQL.format("'  ' || o_orderpriority || ' '")} AS priority,
               {TITLE_SQL.format("o_orderstatus || chr(39) || lower(o_orderpriority)")} AS mixed FROM orders""",
)
def _(spark, sf):
    padded = F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))
    mixed = F.concat("o_orderstatus", F.lit("'"), F.lower("o_orderpriority"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        sc.title_case(F.trim(padded)).alias("priority"),
        sc.title_case(F.trim(mixed)).alias("mixed"),
    )


@query(
    "p7_month_start",
    f"""WITH {DELIVERIES_SQL} SELECT region, model, CAST(make_date(year, month, 1) AS VARCHAR) AS start FROM deliveries""",
)
def _(spark, sf):
    return deliveries(spark, sf).select("region", "model", sc.month_start("year", "month").cast("string").alias("start"))


@query(
    "p8_calendar",
    """SELECT o_orderkey, CAST(quarter(o_orderdate) AS BIGINT) AS quarter, CAST(weekofyear(o_orderdate) AS BIGINT) AS week,
              CAST(quarter(o_orderdate) = 4 AS BIGINT) AS is_q4, round((month(o_orderdate) - 1) / 11.0, 6) AS year_progress
       FROM orders""",
)
def _(spark, sf):
    rows = sc.calendar_features(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")
    return rows.select(
        "o_orderkey",
        *[F.col(c).cast("bigint").alias(c) for c in ("quarter", "week", "is_q4")],
        F.round("year_progress", 6).alias("year_progress"),
    )


@query(
    "p9_length_of_stay",
    f"""WITH {ADMISSIONS_SQL} SELECT admission_id,
        CAST(CASE WHEN discharged IS NOT NULL THEN greatest(date_diff('day', admitted, discharged), 0) END AS BIGINT) AS stay_days
        FROM admissions""",
)
def _(spark, sf):
    stay = sc.length_of_stay("admitted", "discharged").cast("bigint").alias("stay_days")
    return admissions(spark, sf).select("admission_id", stay)


@query("p10_money", "SELECT l_orderkey, l_linenumber, round_even(l_extendedprice * (1 - l_discount) * 100, 0) / 100 AS net FROM lineitem")
def _(spark, sf):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", sc.money(net).alias("net"))


@query(
    "p11_ratio_features",
    f"""WITH {DELIVERIES_SQL} SELECT region, model, CAST(date AS VARCHAR) AS date,
        round(price * range_km, 3) AS price_x_range, battery_kwh * range_km AS battery_x_range,
        round(CASE WHEN battery_kwh = 0 THEN NULL ELSE range_km / battery_kwh END, 6) AS range_per_kwh,
        production - deliveries AS made_minus_sold, round(stations / (deliveries + 1), 6) AS stations_per_sale
        FROM deliveries""",
)
def _(spark, sf):
    rows = sc.ratio_features(deliveries(spark, sf))
    return rows.select(
        "region", "model", text("date").alias("date"), F.round("price_x_range", 3).alias("price_x_range"),
        "battery_x_range", F.round("range_per_kwh", 6).alias("range_per_kwh"), "made_minus_sold",
        F.round("stations_per_sale", 6).alias("stations_per_sale"),
    )


@query("p12_log1p", "SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS log_price FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.round(F.log1p("o_totalprice"), 6).alias("log_price"))


@query(
    "p13_number_band",
    """SELECT c_custkey, CASE WHEN v < 0 THEN 'negative' WHEN v = 0 THEN 'zero' WHEN v <= 10 THEN 'small positive'
              ELSE 'large positive' END AS band
       FROM (SELECT c_custkey, floor(c_acctbal / 100) AS v FROM customer)""",
)
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", sc.number_band(F.floor(F.col("c_acctbal") / 100)).alias("band"))


@query(
    "p14_safe_divide",
    """SELECT l_orderkey, l_linenumber, round(CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity / l_discount END, 6) AS ratio
       FROM lineitem""",
)
def _(spark, sf):
    rows = sc.safe_divide(table(spark, sf, "lineitem"), "l_quantity", "l_discount")
    return rows.select("l_orderkey", "l_linenumber", F.round("ratio", 6).alias("ratio"))


@query(
    "p15_clip",
    "SELECT c_custkey, greatest(c_acctbal, 0.0) AS floor_zero, least(greatest(c_acctbal, 0.0), 1.0) AS unit FROM customer",
)
def _(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", sc.clip("c_acctbal", low=0.0).alias("floor_zero"), sc.clip("c_acctbal", 0.0, 1.0).alias("unit")
    )


@query(
    "p16_array_columns",
    """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
       SELECT vec_id, round(v[3], 6) AS third, round(v[-1], 6) AS last, round(list_sum(v[3:5]), 6) AS slice_sum,
              CAST(len(list_filter(v, lambda x: x > 0)) AS BIGINT) AS positives, CAST(len(v) // 8 AS BIGINT) AS rows,
              round(list_sum(v[9:16]), 6) AS second_row, round(list_max(v) / 255.0, 8) AS scaled_max,
              CAST(len(v) AS BIGINT) AS flat
       FROM e""",
)
def _(spark, sf):
    v = arr.doubles("embedding")
    grid = arr.reshape(v, 8)
    return table(spark, sf, "embeddings").select(
        "vec_id",
        F.round(arr.element(v, 2), 6).alias("third"),
        F.round(arr.element(v, -1), 6).alias("last"),
        F.round(arr.total(arr.cut_slice(v, 2, 5)), 6).alias("slice_sum"),
        F.size(arr.where(v, lambda x: x > 0)).cast("bigint").alias("positives"),
        F.size(grid).cast("bigint").alias("rows"),
        F.round(arr.total(grid[1]), 6).alias("second_row"),
        F.round(F.array_max(arr.scale(v, 1 / 255.0)), 8).alias("scaled_max"),
        F.size(arr.flatten(grid)).cast("bigint").alias("flat"),
    )


@query(
    "p17_formats",
    "SELECT o_orderkey, strftime(o_orderdate, '%b %Y') AS label, printf('%.2f', o_totalprice) AS price FROM orders",
)
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", sc.month_label("o_orderdate").alias("label"), sc.fixed_text("o_totalprice").alias("price")
    )


# ---- missing data, quality, profiling

EMPLOYEE_COLUMNS = ["employee_id", "name", "department", "salary", "age", "performance"]


@query(
    "q1_null_counts",
    f"WITH {EMPLOYEES_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM employees" for c in EMPLOYEE_COLUMNS
    ),
)
def _(spark, sf):
    return quality.null_counts(employees(spark, sf))


@query(
    "q2_duplicate_rows",
    """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM
       (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_returnflag, l_linestatus)""",
)
def _(spark, sf):
    return quality.duplicate_count(table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus"))


@query(
    "q3_drop_duplicates",
    f"""WITH {STAR_SQL} SELECT admission_id, doctor, billing, CAST(admitted AS VARCHAR) AS admitted FROM clean""",
)
def _(spark, sf):
    flat = admissions(spark, sf)
    # the same stays once more in another spelling: equal only after cleaning
    shouted = flat.withColumns({"doctor": F.concat(F.lit(" "), F.upper("doctor")), "hospital": F.concat("hospital", F.lit("  "))})
    cleaned = star.clean_admissions(flat.unionByName(shouted))
    return cleaned.select("admission_id", "doctor", "billing", text("admitted").alias("admitted"))


@query(
    "q4_fill_median",
    f"""WITH {EMPLOYEES_SQL} SELECT employee_id,
        coalesce(salary, (SELECT quantile_cont(salary, 0.5) FROM employees)) AS salary,
        coalesce(performance, (SELECT quantile_cont(performance, 0.5) FROM employees)) AS performance FROM employees""",
)
def _(spark, sf):
    return quality.fill_median(employees(spark, sf), ["salary", "performance"]).select("employee_id", "salary", "performance")


@query(
    "q5_fill_mean",
    f"""WITH {EMPLOYEES_SQL} SELECT employee_id,
        CAST(coalesce(age, (SELECT round_even(avg(age), 0) FROM employees)) AS BIGINT) AS age FROM employees""",
)
def _(spark, sf):
    return quality.fill_mean_rounded(employees(spark, sf), "age").select("employee_id", "age")


@query(
    "q6_drop_nulls",
    f"""WITH {EMPLOYEES_SQL}
        SELECT 'any' AS rule, employee_id FROM employees WHERE salary IS NOT NULL AND age IS NOT NULL AND performance IS NOT NULL
        UNION ALL SELECT 'salary' AS rule, employee_id FROM employees WHERE salary IS NOT NULL""",
)
def _(spark, sf):
    rows = employees(spark, sf)
    whole = quality.drop_nulls(rows).select(F.lit("any").alias("rule"), "employee_id")
    return whole.unionByName(quality.drop_nulls(rows, ["salary"]).select(F.lit("salary").alias("rule"), "employee_id"))


FENCE_SQL = """WITH b AS (SELECT quantile_cont(value, {lo}) AS lo, quantile_cont(value, {hi}) AS hi FROM events)
    SELECT event_id, value FROM events, b WHERE value BETWEEN lo - 1.5 * (hi - lo) AND hi + 1.5 * (hi - lo)"""


@query("q7_outlier_fence", FENCE_SQL.format(lo=0.01, hi=0.99))
def _(spark, sf):
    return quality.outlier_fence(table(spark, sf, "events"), "value").select("event_id", "value")


@query("q7_quartile_fence", FENCE_SQL.format(lo=0.25, hi=0.75))
def _(spark, sf):
    return quality.outlier_fence(table(spark, sf, "events"), "value", 0.25, 0.75).select("event_id", "value")


@query(
    "q8_cardinality",
    f"WITH {ADMISSIONS_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_values,
            CAST(count(*) AS BIGINT) AS rows FROM admissions"""
        for c in ("doctor", "hospital", "condition", "admitted")
    ),
)
def _(spark, sf):
    return quality.cardinality(admissions(spark, sf), ["doctor", "hospital", "condition", "admitted"])


@query(
    "q8_repeated_names",
    f"""WITH {ADMISSIONS_SQL} SELECT CAST(count(*) AS BIGINT) AS repeated FROM
        (SELECT patient_name FROM admissions GROUP BY 1 HAVING count(*) > 1)""",
)
def _(spark, sf):
    return quality.repeated_values(admissions(spark, sf), "patient_name")


@query(
    "q9_value_catalogue",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS type, string_agg(v, '|' ORDER BY v) AS samples FROM
            (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM orders ORDER BY v LIMIT 10)"""
        for c, t in (("o_orderpriority", "string"), ("o_orderstatus", "string"), ("o_custkey", "bigint"))
    )
    + ")",
)
def _(spark, sf):
    cat = quality.value_catalogue(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus", "o_custkey"])
    return cat.withColumn("samples", F.array_join("samples", "|"))


@query(
    "q9_enum_values",
    " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS \"column\", {c} AS value FROM orders" for c in ("o_orderpriority", "o_orderstatus")
    ),
)
def _(spark, sf):
    return quality.enum_values(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"])


@query(
    "q10_integrity",
    f"""WITH {ADMISSIONS_SQL}
        SELECT 'not_null' AS rule, 'discharged' AS "column", CAST(admission_id AS VARCHAR) AS value FROM admissions WHERE discharged IS NULL
        UNION ALL SELECT 'unique', 'p_name', p_name FROM part GROUP BY p_name HAVING count(*) > 1
        UNION ALL SELECT 'foreign_key', 'c_custkey', CAST(c_custkey AS VARCHAR) FROM customer
                  WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def _(spark, sf):
    missing = quality.not_null_violations(admissions(spark, sf), "admission_id", ["doctor", "admitted", "discharged"])
    twice = quality.unique_violations(table(spark, sf, "part"), "p_name")
    dangling = quality.foreign_key_violations(
        table(spark, sf, "customer"), "c_custkey", table(spark, sf, "supplier"), "s_suppkey"
    )
    return missing.unionByName(twice).unionByName(dangling)


# ---- joins


@query(
    "j1_fact_dimension",
    f"""WITH {STAR_SQL} SELECT admission_id, condition, CAST(admitted AS VARCHAR) AS admitted, doctor FROM (
        SELECT * FROM clean WHERE doctor ILIKE '%OMER#00000012%' ORDER BY admitted DESC, admission_id LIMIT 200)""",
)
def _(spark, sf):
    loaded = load(spark, sf)
    rows = star.by_dimension_name(loaded.admissions, loaded.doctors, "doctor_id", "OMER#00000012")
    return rows.select("admission_id", F.upper("condition").alias("condition"), text("admitted").alias("admitted"), "doctor")


@query(
    "j2_dimension_build",
    f"WITH {STAR_SQL} SELECT doctor_id, name FROM doctors",
)
def _(spark, sf):
    return star.build_dimension(star.clean_admissions(admissions(spark, sf)), "doctor", "doctor_id")


@query(
    "j3_key_lookup",
    """WITH dim AS (SELECT s_name AS name, row_number() OVER (ORDER BY s_name) AS supplier_id FROM (SELECT DISTINCT s_name FROM supplier))
       SELECT c_custkey, supplier_id FROM customer LEFT JOIN dim ON replace(c_name, 'Customer', 'Supplier') = dim.name""",
)
def _(spark, sf):
    dim = star.build_dimension(table(spark, sf, "supplier"), "s_name", "supplier_id")
    fact = table(spark, sf, "customer").select(
        "c_custkey", F.replace("c_name", F.lit("Customer"), F.lit("Supplier")).alias("supplier")
    )
    return star.attach_key(fact, "supplier", dim, "supplier_id")


@query(
    "j4_merge_answers",
    """WITH q AS (SELECT conv_id * 1000 + turn AS question_id, text, role FROM conversations),
       d AS (SELECT question_id, contains(text, 'the ') AS success, 'n=' || CAST(length(text) AS VARCHAR) AS answer FROM q WHERE role <> 'system'),
       p AS (SELECT question_id, contains(text, ' de ') AS success, 'see ' || role AS answer FROM q WHERE role <> 'assistant')
       SELECT coalesce(d.question_id, p.question_id) AS question_id,
         CASE WHEN d.question_id IS NOT NULL AND p.question_id IS NOT NULL THEN
                CASE WHEN d.success AND p.success THEN 'Data: ' || d.answer || chr(10) || chr(10) || 'Policy: ' || p.answer
                     WHEN d.success THEN 'Data: ' || d.answer WHEN p.success THEN 'Policy: ' || p.answer
                     ELSE 'Neither the database nor the policy documents could answer this.' END
              WHEN d.question_id IS NOT NULL THEN CASE WHEN d.success THEN d.answer ELSE 'no data' END
              ELSE CASE WHEN p.success THEN p.answer ELSE 'I couldn''t find that in the policy documents.' END END AS final_answer
       FROM d FULL JOIN p ON d.question_id = p.question_id""",
)
def _(spark, sf):
    q = table(spark, sf, "conversations").withColumn("question_id", F.col("conv_id") * 1000 + F.col("turn"))
    data = q.filter(F.col("role") != "system").select(
        "question_id", F.contains("text", F.lit("the ")).alias("success"),
        F.concat(F.lit("n="), F.length("text").cast("string")).alias("answer"), F.lit("no data").alias("error"),
    )
    policy = q.filter(F.col("role") != "assistant").select(
        "question_id", F.contains("text", F.lit(" de ")).alias("success"),
        F.concat(F.lit("see "), "role").alias("answer"), F.lit(None).cast("string").alias("error"),
    )
    return star.merge_answers(data, policy)


# ---- aggregations


@query(
    "a1_group_means",
    f"""WITH {EMPLOYEES_SQL} SELECT department, round(avg(salary), 4) AS avg_salary, round(avg(performance), 4) AS avg_performance
        FROM employees WHERE age > 25 AND employee_id > 0 GROUP BY department""",
)
def _(spark, sf):
    rows = employees(spark, sf).filter((F.col("age") > 25) & (F.col("employee_id") > 0))
    means = agg.group_means(rows, "department", avg_salary="salary", avg_performance="performance")
    return means.withColumns({c: F.round(c, 4) for c in ("avg_salary", "avg_performance")})


@query(
    "a2_yearly_sums",
    f"""WITH {DELIVERIES_SQL} SELECT year, CAST(sum(deliveries) AS BIGINT) AS deliveries, CAST(sum(production) AS BIGINT) AS production,
        round(sum(deliveries) / 1e6, 6) AS deliveries_millions, round(sum(co2), 2) AS co2 FROM deliveries GROUP BY year""",
)
def _(spark, sf):
    sums = agg.yearly_sums(
        deliveries(spark, sf),
        {"deliveries": F.col("deliveries"), "production": F.col("production"), "co2": F.col("co2")},
    )
    return sums.select(
        "year", "deliveries", "production", F.round(F.col("deliveries") / 1e6, 6).alias("deliveries_millions"),
        F.round("co2", 2).alias("co2"),
    )


def _pivot_sql(column, values, cell):
    return ", ".join(f"{cell.format(c=column, v=v)} AS \"{v}\"" for v in values)


SUM_CELL = "CAST(coalesce(sum(deliveries) FILTER ({c} = '{v}'), 0) AS BIGINT)"


@query("a3_pivot_region", f"WITH {DELIVERIES_SQL} SELECT year, {_pivot_sql('region', REGIONS, SUM_CELL)} FROM deliveries GROUP BY year")
def _(spark, sf):
    return agg.pivot_sum(deliveries(spark, sf), "year", "region", "deliveries", REGIONS)


@query("a3_pivot_model", f"WITH {DELIVERIES_SQL} SELECT year, {_pivot_sql('model', MODELS, SUM_CELL)} FROM deliveries GROUP BY year")
def _(spark, sf):
    return agg.pivot_sum(deliveries(spark, sf), "year", "model", "deliveries", MODELS)


@query(
    "a4_pivot_mean",
    f"WITH {DELIVERIES_SQL} SELECT year, {_pivot_sql('month', range(1, 13), 'round(avg(deliveries) FILTER ({c} = {v}), 4)')} FROM deliveries GROUP BY year",
)
def _(spark, sf):
    wide = agg.pivot_mean(deliveries(spark, sf), "year", "month", "deliveries", range(1, 13))
    return wide.select("year", *[F.round(F.col(str(m)), 4).alias(str(m)) for m in range(1, 13)])


STAY_SQL = f"""WITH {STAR_SQL}
    SELECT condition, round(avg(stay_days), 4) AS avg_stay_days, CAST(count(*) AS BIGINT) AS patients
    FROM clean WHERE admission_type = '1-URGENT' GROUP BY condition"""


def stay_by_condition(spark, sf):
    """Average length of stay and number of urgent admissions per condition.

    The cleaned rows are those of the loaded fact; no dimension is needed, and the filter runs below the removal of duplicates.
    """
    clean = star.clean_admissions(admissions(spark, sf))
    return (
        clean.filter(F.col("admission_type") == "1-Urgent")
        .groupBy(F.upper("condition").alias("condition"))
        .agg(F.round(F.avg("stay_days"), 4).alias("avg_stay_days"), F.count(F.lit(1)).alias("patients"))
    )


query("a5_stay_by_condition", STAY_SQL)(stay_by_condition)


@query(
    "a5_filtered_scalars",
    f"""WITH {ADMISSIONS_SQL} SELECT round(avg(CASE WHEN discharged IS NOT NULL THEN greatest(date_diff('day', admitted, discharged), 0) END), 4) AS avg_stay,
        CAST(count(*) AS BIGINT) AS patients FROM admissions WHERE condition = 'BUILDING' AND result = 'F'""",
)
def _(spark, sf):
    rows = admissions(spark, sf).filter((F.col("condition") == "BUILDING") & (F.col("result") == "F"))
    return rows.agg(
        F.round(F.avg(sc.length_of_stay("admitted", "discharged")), 4).alias("avg_stay"), F.count(F.lit(1)).alias("patients")
    )


def _describe_sql(source, columns):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
            round(min({c}), 4) AS min, round(max({c}), 4) AS max, round(quantile_cont({c}, 0.5), 4) AS median,
            round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 4) AS iqr FROM {source}"""
        for c in columns
    )


@query("a6_describe", f"WITH {EMPLOYEES_SQL} " + _describe_sql("employees", ["salary", "performance"]))
def _(spark, sf):
    d = agg.describe(employees(spark, sf), ["salary", "performance"])
    return d.select("column", "n", *[F.round(c, 4).alias(c) for c in ("mean", "std", "min", "max", "median", "iqr")])


@query("a6_describe_lines", _describe_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def _(spark, sf):
    d = agg.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return d.select("column", "n", *[F.round(c, 4).alias(c) for c in ("mean", "std", "min", "max", "median", "iqr")])


# white space as Unicode defines it, spelled out for engines whose \s is ASCII only
BLANKS = r"[\s\x0b\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
SPARK_BLANKS = r"(?U)\s+"


@query(
    "a7_word_counts",
    f"""SELECT value, CAST(count(*) AS BIGINT) AS n FROM
        (SELECT unnest(regexp_split_to_array(lower(text), '{BLANKS}')) AS value FROM documents) WHERE value <> '' GROUP BY value""",
)
def _(spark, sf):
    return agg.word_counts(table(spark, sf, "documents"), "text", SPARK_BLANKS)


@query("a7_value_counts", "SELECT event_type AS value, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")
def _(spark, sf):
    return agg.value_counts(table(spark, sf, "events"), "event_type")


@query(
    "a8_long_words",
    f"""SELECT DISTINCT word FROM (SELECT unnest(regexp_split_to_array(lower(text), '{BLANKS}')) AS word FROM documents)
        WHERE length(word) > 5""",
)
def _(spark, sf):
    return agg.long_words(table(spark, sf, "documents"), "text", 5, SPARK_BLANKS)


CORR_COLUMNS = ["deliveries", "production", "price", "battery_kwh", "range_km", "co2", "stations"]


@query(
    "a9_correlations",
    f"WITH {DELIVERIES_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM deliveries"
        for i, a in enumerate(CORR_COLUMNS) for b in CORR_COLUMNS[i + 1 :]
    ),
)
def _(spark, sf):
    return agg.correlations(deliveries(spark, sf), CORR_COLUMNS).withColumn("r", F.round("r", 6))


HISTOGRAM_SQL = """WITH {view}, s AS (SELECT min({c}) AS lo, max({c}) AS hi, count({c}) AS n, (max({c}) - min({c})) / {k}.0 AS w FROM {t}),
    bins AS (SELECT unnest(range({k})) AS bin),
    counted AS (SELECT CAST(least(floor(({c} - lo) / w), {k} - 1) AS BIGINT) AS bin, count(*) AS n FROM {t}, s WHERE {c} IS NOT NULL GROUP BY 1)
    SELECT bins.bin AS bin, round(lo + w * bins.bin, 4) AS low, CAST(coalesce(counted.n, 0) AS BIGINT) AS n,
           round(coalesce(counted.n, 0) / (s.n * w), 9) AS density
    FROM bins LEFT JOIN counted ON bins.bin = counted.bin, s"""


def _histogram(df, column, bins):
    h = agg.histogram(df, column, bins, density=True)
    return h.select("bin", F.round("low", 4).alias("low"), "n", F.round("density", 9).alias("density"))


@query("a10_histogram", HISTOGRAM_SQL.format(view=EMPLOYEES_SQL, c="salary", t="employees", k=6))
def _(spark, sf):
    return _histogram(employees(spark, sf), "salary", 6)


@query("a10_histogram_lines", HISTOGRAM_SQL.format(view="one AS (SELECT 1)", c="l_extendedprice", t="lineitem", k=40))
def _(spark, sf):
    return _histogram(table(spark, sf, "lineitem"), "l_extendedprice", 40)


@query(
    "a11_density",
    f"""WITH {EMPLOYEES_SQL}, s AS (SELECT min(salary) - 5000 AS a, (max(salary) - min(salary) + 10000) / 199.0 AS step, count(salary) AS n,
        stddev_samp(salary) * pow(count(salary), -0.2) AS h FROM employees),
        grid AS (SELECT unnest(range(200)) AS point)
        SELECT point, round(max(a + point * step), 4) AS x,
               round(1e6 * sum(exp(-0.5 * pow((a + point * step - salary) / h, 2)) / (n * h * sqrt(2 * pi()))), 6) AS density
        FROM grid, s, employees WHERE salary IS NOT NULL GROUP BY point""",
)
def _(spark, sf):
    d = agg.kernel_density(employees(spark, sf), "salary")
    return d.select(
        F.col("point").cast("bigint").alias("point"), F.round("x", 4).alias("x"), F.round(F.col("density") * 1e6, 6).alias("density")
    )


@query(
    "a12_error_metrics",
    """WITH e AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 2000 AS p FROM lineitem),
       m AS (SELECT l_returnflag, count(*) AS n, avg(abs(y - p)) AS mae, avg((y - p) * (y - p)) AS mse, var_pop(y) AS v,
             avg(abs((y - p) / y)) * 100 AS mape FROM e GROUP BY 1)
       SELECT l_returnflag, CAST(n AS BIGINT) AS n, round(mae, 3) AS mae, round(mse / 1e6, 5) AS mse, round(sqrt(mse), 3) AS rmse,
              round(1 - mse / v, 6) AS r2, round(1 - (mse / v) * (n - 1) / (n - 3), 6) AS adj_r2, round(mape, 4) AS mape FROM m""",
)
def _(spark, sf):
    e = table(spark, sf, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2000).alias("p")
    )
    m = agg.error_metrics(e, "y", "p", by=["l_returnflag"], features=2)
    return m.select(
        "l_returnflag", "n", F.round("mae", 3).alias("mae"), F.round(F.col("mse") / 1e6, 5).alias("mse"),
        F.round("rmse", 3).alias("rmse"), F.round("r2", 6).alias("r2"), F.round("adj_r2", 6).alias("adj_r2"),
        F.round("mape", 4).alias("mape"),
    )


@query(
    "a13_load_statistics",
    f"""WITH {STAR_SQL} SELECT 'admissions' AS "table", CAST(count(*) AS BIGINT) AS rows FROM clean
        UNION ALL SELECT 'doctors', count(*) FROM doctors UNION ALL SELECT 'hospitals', count(*) FROM hospitals
        UNION ALL SELECT 'insurance_providers', count(*) FROM providers
        UNION ALL SELECT 'documents', count(DISTINCT doc_id) FROM documents""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").agg(F.count_distinct("doc_id").alias("rows"))
    return load(spark, sf).counts().unionByName(docs.select(F.lit("documents").alias("table"), "rows"))


# ---- sort, limit, top-k


@query(
    "l1_sorted_head",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ordering.top_rows(rows, F.desc("o_totalprice"), "o_orderkey", n=50)


@query(
    "l2_top_k",
    """SELECT p_brand AS brand, round(sum(l_extendedprice), 2) AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey
       GROUP BY p_brand ORDER BY sum(l_extendedprice) DESC LIMIT 20""",
)
def _(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("brand"))
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_extendedprice")
    sums = (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("brand")
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
    )
    return ordering.top_rows(sums, F.desc("revenue"), "brand", n=20)


@query(
    "l3_result_cap",
    "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 200",
)
def _(spark, sf):
    return ordering.capped(table(spark, sf, "orders").select("o_orderkey").orderBy("o_orderkey"), asked=50_000)


@query(
    "l4_first_per_group",
    """SELECT o_orderpriority, o_orderkey, rank FROM (SELECT o_orderpriority, o_orderkey,
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS rank FROM orders) WHERE rank <= 300""",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderpriority", "o_orderdate", "o_orderkey")
    return ordering.first_per_group(rows, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], 300).drop("o_orderdate")


# ---- user functions: chained frame transforms and column lambdas


def apply_twice(fn, df):
    """Apply a frame transform to its own result."""
    return df.transform(fn).transform(fn)


@query(
    "u1_chained_transforms",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice * 1.5 * 1.5, 4) AS price,
              array_to_string(list_transform(string_split(l_returnflag || '-' || l_linestatus, '-'), lambda x: lower(x)), '+') AS flags FROM lineitem""",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"), "l_returnflag", "l_linestatus")
    raised = apply_twice(lambda df: df.withColumn("price", F.col("price") * 1.5), rows)
    flags = F.transform(F.split(F.concat_ws("-", "l_returnflag", "l_linestatus"), "-"), F.lower)
    return raised.select("l_orderkey", "l_linenumber", F.round("price", 4).alias("price"), F.array_join(flags, "+").alias("flags"))
