"""Queries: statistical tests, probability tables, sampling and drift."""

from __future__ import annotations

from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import functions as F

from tidemill.operators import stats
from tidemill.plans.registry import query
from tidemill.plans.tables import BLANKS, SPARK_BLANKS
from tidemill.plans.timeline import rounded
from tidemill.plans.views import EMPLOYEES_SQL, employees, table


@query(
    "h1_group_t_tests",
    f"""WITH {EMPLOYEES_SQL}, g AS (SELECT department, count(salary) AS n, avg(salary) AS m, stddev_samp(salary) AS s FROM employees GROUP BY 1)
        SELECT department, CAST(n AS BIGINT) AS n, round(m, 4) AS mean, CAST(n - 1 AS BIGINT) AS df,
               round((m - (SELECT avg(salary) FROM employees)) / (s / sqrt(n)), 6) AS t FROM g""",
)
def _(spark, sf):
    t = stats.group_t_tests(employees(spark, sf), "department", "salary")
    return rounded(t.select("department", "n", F.round("mean", 4).alias("mean"), "df", "t"), 6, "t")


@query("h1_group_p_values")
def _(spark, sf):
    return stats.group_t_tests(employees(spark, sf), "department", "salary").select("department", "t", "p")


@query(
    "h2_pearson",
    """SELECT CAST(count(*) AS BIGINT) AS n, round(corr(l_quantity, l_extendedprice), 8) AS r,
       round(corr(l_quantity, l_extendedprice) * sqrt((count(*) - 2) / (1 - pow(corr(l_quantity, l_extendedprice), 2))), 4) AS t FROM lineitem""",
)
def _(spark, sf):
    t = stats.pearson_test(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return t.select("n", F.round("r", 8).alias("r"), F.round("t", 4).alias("t"))


@query("h2_pearson_p")
def _(spark, sf):
    return stats.pearson_test(employees(spark, sf), "salary", "age")


@query(
    "h3_ks_exponential",
    """WITH v AS (SELECT value, row_number() OVER (ORDER BY value) AS r, count(*) OVER () AS n,
         1 - exp(-value / (SELECT avg(value) FROM events)) AS c FROM events)
       SELECT round(max(greatest(abs(c - (r - 1) / n), abs(r / n - c))), 8) AS statistic, CAST(max(n) AS BIGINT) AS n FROM v""",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    mean = events.agg(F.avg("value")).scalar()
    return rounded(stats.ks_statistic(events, "value", lambda v: 1 - F.exp(-v / mean)), 8, "statistic")


@query("h3_ks_normal")
def _(spark, sf):
    prices = table(spark, sf, "orders").select(F.col("o_totalprice").alias("v"))
    moments = prices.agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).first()
    return KolmogorovSmirnovTest.test(prices, "v", "norm", float(moments["m"]), float(moments["s"]))


PSI_SQL = """WITH b AS (SELECT value FROM events WHERE ts < TIMESTAMP '2024-01-08'),
    q AS (SELECT quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM b),
    bins AS (SELECT unnest(range(10)) AS bin),
    ex AS (SELECT CAST(len(list_filter(e, lambda x: x <= value)) AS BIGINT) AS bin, count(*) / (SELECT count(*) FROM b) AS s FROM b, q GROUP BY 1),
    base AS (SELECT bins.bin AS bin, coalesce(s, 0) + 1e-10 AS s FROM bins LEFT JOIN ex ON bins.bin = ex.bin),
    act AS (SELECT {key} AS k, CAST(len(list_filter(e, lambda x: x <= value)) AS BIGINT) AS bin, count(*) AS n FROM events, q WHERE {where} GROUP BY 1, 2),
    tot AS (SELECT k, sum(n) AS t FROM act GROUP BY 1),
    psi AS (SELECT tot.k AS k, sum((coalesce(n, 0) / t + 1e-10 - s) * ln((coalesce(n, 0) / t + 1e-10) / s)) AS psi
            FROM tot JOIN base ON true LEFT JOIN act ON act.k = tot.k AND act.bin = base.bin GROUP BY tot.k)
    {tail}"""
STATUS = "CASE WHEN psi > 0.2 THEN 'Major' WHEN psi > 0.1 THEN 'Minor' ELSE 'Stable' END AS status"
CUT = "2024-01-08"


@query(
    "h4_stability_index",
    PSI_SQL.format(
        key="event_type", where="ts >= TIMESTAMP '2024-01-08'",
        tail=f"SELECT k AS event_type, round(psi, 6) AS psi, {STATUS} FROM psi",
    ),
)
def _(spark, sf):
    events = table(spark, sf, "events")
    old, new = events.filter(F.col("ts") < CUT), events.filter(F.col("ts") >= CUT)
    return rounded(stats.psi_by_period(old, new, "value", by=["event_type"]), 6, "psi")


@query(
    "h4_weekly_monitor",
    PSI_SQL.format(
        key="CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS BIGINT)", where="true",
        tail=f"""SELECT k AS week, round(psi, 6) AS psi, {STATUS},
            CAST(psi > 0.2 AND coalesce(lag(psi) OVER (ORDER BY k), 0) > 0.2 AS BIGINT) AS retrain FROM psi""",
    ),
)
def _(spark, sf):
    events = table(spark, sf, "events")
    weeks = events.withColumn("week", F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 7))
    psi = stats.psi_by_period(events.filter(F.col("ts") < CUT), weeks, "value", by=["week"])
    out = stats.consecutive_alerts(psi, "week")
    return rounded(out.withColumn("retrain", F.col("retrain").cast("bigint")), 6, "psi")


def _mixed_sql(seed):
    first = f"(((rep + {seed}) * 1103515245 + 12345) % 2147483648)"
    second = f"((xor({first}, {first} >> 13) * 69069 + 1) % 2147483648)"
    return f"xor({second}, {second} >> 15)"


def _permuted_sql(source):
    """`x` of the rows of `source (rep, j, x, k0 … k3)` after one pass of the permutation of 0..n-1."""
    h = "((({x} % 2147483647) * 48271 + ({x} // 2147483647) * 69621 + {k}) % 2147483647)"
    mixed = lambda x, k: "((xor({h}, {h} >> 15) * 16807) % 2147483647)".format(h=h.format(x=x, k=k))
    rows = f"SELECT *, x // pr AS a, x % pr AS b FROM {source}, sides"
    for side, other, key, part in (("a", "b", "k0", "pl"), ("b", "a", "k1", "pr"), ("a", "b", "k2", "pl"), ("b", "a", "k3", "pr")):
        rows = f"SELECT * REPLACE (xor({side}, {mixed(other, key)} % {part}) AS {side}) FROM ({rows})"
    return f"SELECT rep, j, a * pr + b AS x, k0, k1, k2, k3 FROM ({rows})"


DRAWS_SQL = f"""WITH RECURSIVE p AS (SELECT o_totalprice AS v, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders),
    sides AS (SELECT count(*) AS n, CAST(2 ** (greatest(length(bin(count(*) - 1)), 2) // 2) AS BIGINT) AS pl,
        CAST(2 ** (greatest(length(bin(count(*) - 1)), 2) - greatest(length(bin(count(*) - 1)), 2) // 2) AS BIGINT) AS pr FROM p),
    begun AS (SELECT rep, unnest(range(30)) AS j, {", ".join(f"{_mixed_sql(7 + 1000003 * i)} AS k{i}" for i in range(4))}
        FROM (SELECT unnest(range(5000)) AS rep)),
    placed AS (SELECT rep, j, j AS x, k0, k1, k2, k3 FROM begun),
    walk AS (({_permuted_sql("placed")}) UNION ALL ({_permuted_sql("(SELECT w.* FROM walk w, sides s WHERE w.x >= s.n)")})),
    m AS (SELECT rep, avg(v) AS mean FROM walk JOIN p ON p.i = x GROUP BY rep)
"""


@query("h5_sampling_means", DRAWS_SQL + "SELECT rep, round(mean, 4) AS mean FROM m")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    return rounded(stats.sampling_means(orders, "o_totalprice", "o_orderkey"), 4, "mean")


@query(
    "h5_sampling_summary",
    DRAWS_SQL + """SELECT CAST(count(*) AS BIGINT) AS replicates, round(avg(mean), 4) AS mean_of_means, round(stddev_pop(mean), 4) AS std_of_means,
        round((SELECT avg(o_totalprice) FROM orders), 4) AS mu, round((SELECT stddev_pop(o_totalprice) FROM orders) / sqrt(30), 4) AS theory FROM m""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    means = stats.sampling_means(orders, "o_totalprice", "o_orderkey")
    out = stats.sampling_summary(means, orders, "o_totalprice")
    return rounded(out, 4, "mean_of_means", "std_of_means", "mu", "theory")


JOINT_SQL = """t AS (SELECT sum(n) AS t FROM c), pa AS (SELECT a, sum(n) / max(t) AS p_a FROM c, t GROUP BY a),
    pb AS (SELECT b, sum(n) / max(t) AS p_b FROM c, t GROUP BY b)
    SELECT a, b, CAST(n AS BIGINT) AS n, round(p_a, 8) AS p_a, round(p_b, 8) AS p_b, round(n / t, 8) AS p_ab,
           round(n / t / p_a, 8) AS p_b_given_a, round(n / t / (p_a * p_b), 6) AS lift, round(n / t - p_a * p_b, 8) AS gap
    FROM c JOIN pa USING (a) JOIN pb USING (b), t"""


def _joint(df):
    out = rounded(df, 8, "p_a", "p_b", "p_ab", "p_b_given_a", "gap")
    return rounded(out, 6, "lift").select("a", "b", "n", "p_a", "p_b", "p_ab", "p_b_given_a", "lift", "gap")


@query("h6_joint_probability", "WITH c AS (SELECT o_orderpriority AS a, o_orderstatus AS b, count(*) AS n FROM orders GROUP BY ALL), " + JOINT_SQL)
def _(spark, sf):
    return _joint(stats.joint_table(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus"))


@query(
    "h6_ordered_pairs",
    """WITH s AS (SELECT event_type AS a, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events),
       c AS (SELECT a, b, count(*) AS n FROM s WHERE b IS NOT NULL GROUP BY ALL), """ + JOINT_SQL,
)
def _(spark, sf):
    return _joint(stats.ordered_pairs(table(spark, sf, "events"), ["user_id"], "ts", "event_id", "event_type"))


@query(
    "h7_word_posterior",
    f"""WITH d AS (SELECT doc_id, text, quality AS y FROM documents JOIN labels USING (doc_id)),
        s AS (SELECT sum(y) AS pos, count(*) AS n FROM d),
        w AS (SELECT DISTINCT doc_id, y, unnest(regexp_split_to_array(lower(text), '{BLANKS}')) AS word FROM d),
        c AS (SELECT word, sum(y) AS pos, count(*) AS docs FROM w WHERE word <> '' GROUP BY word)
        SELECT word, CAST(docs AS BIGINT) AS docs, round(c.pos / s.pos * (s.pos / n) / (c.pos / s.pos * (s.pos / n)
               + (docs - c.pos) / (n - s.pos) * (1 - s.pos / n)), 8) AS posterior FROM c, s""",
)
def _(spark, sf):
    out = stats.word_posteriors(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id", "text", "quality", SPARK_BLANKS)
    return rounded(out, 8, "posterior")
