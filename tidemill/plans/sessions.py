"""Queries: session history, repeat suppression and drift, on tables and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import sessions, stats
from tidemill.plans.registry import query
from tidemill.plans.statistics import CUT, PSI_SQL, STATUS
from tidemill.plans.timeline import rounded
from tidemill.plans.views import table
from tidemill.session import scratch_path
from tidemill.streaming import drift, stateful
from tidemill.streaming.runner import read_stream, run_available, write_slices

HISTORY_SQL = """WITH k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations)
    SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position FROM k WHERE r <= {n}"""


@query("r1_history", HISTORY_SQL.format(n=4))
def _(spark, sf):
    rows = sessions.recent_history(table(spark, sf, "conversations"), "conv_id", ["turn"], turns=2)
    return rows.withColumn("position", F.col("position").cast("bigint"))


@query("r1_history_stream", HISTORY_SQL.format(n=4))
def _(spark, sf):
    talk = table(spark, sf, "conversations")
    path = scratch_path(spark, "talk")
    files = write_slices(talk, path, "turn", 3)
    stream = stateful.history_stream(read_stream(spark, path, talk.schema, files), "conv_id", "turn", "role", "text", turns=2)
    written = run_available(stream, scratch_path(spark, "history"), "update")
    return stateful.history_rows(written, "conv_id").withColumn("position", F.col("position").cast("bigint"))


# the stored time per row by recursion over each key's rows in time order
REPEAT_SQL = """WITH RECURSIVE o AS MATERIALIZED (SELECT user_id, event_type, event_id, epoch_us(ts) AS t,
        row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS i FROM events),
    f(user_id, event_type, event_id, i, stored, repeat) AS (
        SELECT user_id, event_type, event_id, i, t, 0 FROM o WHERE i = 1
        UNION ALL
        SELECT o.user_id, o.event_type, o.event_id, o.i, CASE WHEN o.t - f.stored > {ttl}000000 THEN o.t ELSE f.stored END,
               CASE WHEN o.t - f.stored > {ttl}000000 THEN 0 ELSE 1 END
        FROM f JOIN o ON o.user_id = f.user_id AND o.event_type = f.event_type AND o.i = f.i + 1)
    SELECT event_id, user_id, event_type, CAST(repeat AS BIGINT) AS repeat{extra} FROM f"""
KEYS = ["user_id", "event_type"]
AT = ", CAST(stored AS BIGINT) AS answered_at"


def _suppressed(spark, sf, ttl):
    rows = sessions.suppress_repeats(table(spark, sf, "events"), KEYS, "ts", "event_id", ttl)
    return rows.withColumn("answered_at", F.unix_micros("answered_at"))


@query("r2_repeats", REPEAT_SQL.format(ttl=300, extra=AT))
def _(spark, sf):
    return _suppressed(spark, sf, 300)


@query("r2_repeats_daily", REPEAT_SQL.format(ttl=86400, extra=AT))
def _(spark, sf):
    return _suppressed(spark, sf, 86400)


@query("r2_repeats_stream", REPEAT_SQL.format(ttl=86400, extra=""))
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    path = scratch_path(spark, "events")
    files = write_slices(events, path, "ts", 4)
    stream = stateful.suppress_stream(read_stream(spark, path, events.schema, files), KEYS, "ts", "event_id", 86400)
    return run_available(stream, scratch_path(spark, "repeats"), "append").drop("batch")


@query(
    "r3_drift_stream",
    PSI_SQL.format(
        key="CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS BIGINT)", where="true",
        tail=f"""SELECT CAST(DATE '2024-01-01' + CAST(k * 7 AS INTEGER) AS VARCHAR)[1:10] AS week_start, round(psi, 6) AS psi, {STATUS},
            CAST(psi > 0.2 AND coalesce(lag(psi) OVER (ORDER BY k), 0) > 0.2 AS BIGINT) AS retrain FROM psi""",
    ),
)
def _(spark, sf):
    events = table(spark, sf, "events").select("ts", "value")
    baseline = events.filter(F.col("ts") < CUT)
    edges = stats.decile_edges(baseline, "value")
    path = scratch_path(spark, "events")
    files = write_slices(events, path, "ts", 4)
    # weeks start on Mondays: the epoch was a Thursday
    stream = drift.weekly_bins(read_stream(spark, path, events.schema, files), "ts", "value", edges, "4 days")
    counts = drift.latest_counts(run_available(stream, scratch_path(spark, "drift"), "update"))
    out = drift.drift_from_counts(counts, baseline, "value", edges)
    out = out.withColumns({"week_start": F.col("week_start").cast("date").cast("string"), "retrain": F.col("retrain").cast("bigint")})
    return rounded(out, 6, "psi")
