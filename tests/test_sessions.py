"""Session history and repeat suppression, on tables and as streams."""

from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.operators import sessions
from tidemill.streaming import stateful
from tidemill.streaming.runner import read_stream, run_available, write_slices

START = dt.datetime(2024, 1, 1)


def brute(rows, ttl):
    stored, out = {}, {}
    for key, at, i in sorted(rows, key=lambda r: (r[1], r[2])):
        if key in stored and at - stored[key] <= ttl:
            out[i] = (1, stored[key])
        else:
            stored[key] = at
            out[i] = (0, at)
    return out


@pytest.mark.parametrize("spans", [1, 2, 64, None])
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 300)), min_size=1, max_size=80))
def test_repeats_match_a_plain_loop(spark, spans, events):
    rows = [(k, t * 7, i) for i, (k, t) in enumerate(events)]
    df = spark.createDataFrame([(k, START + dt.timedelta(seconds=t), i) for k, t, i in rows], "k string, ts timestamp_ntz, id int")
    out = sessions.suppress_repeats(df, ["k"], "ts", "id", ttl=50, spans=spans)
    base = int((START - dt.datetime(1970, 1, 1)).total_seconds())
    got = {r["id"]: (r["repeat"], r["s"] - base) for r in out.withColumn("s", F.unix_seconds("answered_at")).collect()}
    assert got == brute(rows, 50)


def test_null_key_is_one_key(spark):
    df = spark.createDataFrame([(None, START, 1), (None, START + dt.timedelta(seconds=5), 2)], "k string, ts timestamp_ntz, id int")
    assert {r["id"]: r["repeat"] for r in sessions.suppress_repeats(df, ["k"], "ts", "id", 50).collect()} == {1: 0, 2: 1}


def test_history_keeps_the_newest(spark):
    df = spark.range(40).select((F.col("id") % 2).alias("s"), F.col("id").alias("turn"))
    rows = sessions.recent_history(df, "s", ["turn"]).filter("s = 1").orderBy("position").collect()
    assert [r["turn"] for r in rows] == list(range(17, 41, 2)) and [r["position"] for r in rows] == list(range(1, 13))


def test_message_key(spark):
    df = spark.createDataFrame([(7, "  Hello THERE ")], "s int, m string")
    assert df.select(sessions.message_key("s", "m")).first()[0] == "7:hello there"


def batches(spark, path, rows, schema, sizes):
    at = 0
    for n in sizes:
        spark.createDataFrame(rows[at : at + n], schema).coalesce(1).write.mode("append").parquet(path)
        at += n


def test_repeat_stream_across_batches_and_late_rows(spark, tmp_path):
    sec = lambda s: START + dt.timedelta(seconds=s)
    rows = [("a", sec(0), 1), ("a", sec(250), 2), ("b", sec(10), 3), ("a", sec(301), 4), ("a", sec(600), 5), ("b", sec(4000), 6), ("c", sec(4100), 8), ("a", sec(5), 7)]
    path = str(tmp_path / "in")
    schema = "k string, ts timestamp_ntz, id int"
    batches(spark, path, rows, schema, [3, 2, 1, 1, 1])
    stream = stateful.suppress_stream(read_stream(spark, path, spark.read.parquet(path).schema, 1), ["k"], "ts", "id", 300)
    out = run_available(stream, str(tmp_path / "out"), "append", str(tmp_path / "state"))
    # the last row lies an hour behind the watermark and is dropped
    assert {r["id"]: r["repeat"] for r in out.collect()} == {1: 0, 2: 1, 3: 0, 4: 0, 5: 1, 6: 0, 8: 0}


def test_history_stream_across_batches(spark, tmp_path):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(9)]
    path = str(tmp_path / "in")
    batches(spark, path, rows, "s int, turn long, role string, text string", [4, 4, 1])
    stream = stateful.history_stream(read_stream(spark, path, spark.read.parquet(path).schema, 1), "s", "turn", "role", "text", turns=2)
    written = run_available(stream, str(tmp_path / "out"), "update", str(tmp_path / "state"))
    assert written.select("batch").distinct().count() == 3
    got = stateful.history_rows(written, "s").orderBy("position").collect()
    assert [r["text"] for r in got] == ["m5", "m6", "m7", "m8"]


def test_late_rows_repeat_only_what_is_near_and_keep_the_stored_time(spark, tmp_path):
    rows = [("a", START + dt.timedelta(seconds=s), i) for i, s in enumerate((1000, 1400, 1050, 1500, 1200))]
    path = str(tmp_path / "in")
    batches(spark, path, rows, "k string, ts timestamp_ntz, id int", [1] * 5)
    stream = stateful.suppress_stream(read_stream(spark, path, spark.read.parquet(path).schema, 1), ["k"], "ts", "id", 300)
    out = run_available(stream, str(tmp_path / "out"), "append", str(tmp_path / "state"))
    assert {r["id"]: r["repeat"] for r in out.collect()} == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1}


def test_rows_without_a_time_are_no_repeats(spark, tmp_path):
    rows = [("a", START, 0), ("a", None, 1), ("b", None, 2), ("a", START + dt.timedelta(seconds=5), 3)]
    path = str(tmp_path / "in")
    batches(spark, path, rows, "k string, ts timestamp_ntz, id int", [3, 1])
    stream = stateful.suppress_stream(read_stream(spark, path, spark.read.parquet(path).schema, 1), ["k"], "ts", "id", 300)
    out = run_available(stream, str(tmp_path / "out"), "append", str(tmp_path / "state"))
    assert {r["id"]: r["repeat"] for r in out.collect()} == {0: 0, 1: 0, 2: 0, 3: 1}


def test_slices_keep_rows_without_order(spark, tmp_path):
    df = spark.createDataFrame([(i, i if i % 5 else None) for i in range(21)], "id int, at int")
    write_slices(df, str(tmp_path / "s"), "at", 3)
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "s")).collect()) == list(range(21))
    write_slices(df.filter("at IS NULL"), str(tmp_path / "n"), "at", 3)
    assert spark.read.parquet(str(tmp_path / "n")).count() == 5


def test_groups_of_a_batch_are_worked_on_together():
    calls = []

    def count(pdf, starts):
        calls.append(len(starts))
        return pdf

    frames = [pd.DataFrame({"k": [1, 1, 2, 3, None]}), pd.DataFrame({"k": [None, 4, 5]})]
    out = pd.concat(sessions._each_group(["k"], count)(iter(frames)))
    assert calls == [3, 2, 1] and out["k"].tolist()[:4] == [1, 1, 2, 3]


def test_rows_before_1970_are_no_repeats_of_nothing(spark):
    at = dt.datetime(1960, 1, 1)
    df = spark.createDataFrame([("a", at + dt.timedelta(seconds=s), s) for s in (0, 5, 100)], "k string, ts timestamp_ntz, id int")
    assert {r["id"]: r["repeat"] for r in sessions.suppress_repeats(df, ["k"], "ts", "id", 50).collect()} == {0: 0, 5: 1, 100: 0}


def test_repeat_stream_calls_python_by_shard_not_by_key(spark, tmp_path):
    rows = [(None if k == 7 else k, START + dt.timedelta(seconds=40 * t), 300 * t + k) for t in range(4) for k in range(300)]
    path = str(tmp_path / "in")
    batches(spark, path, rows, "k long, ts timestamp_ntz, id int", [600, 600])
    stream = stateful.suppress_stream(read_stream(spark, path, spark.read.parquet(path).schema, 1), ["k"], "ts", "id", 50, shards=4)
    out = run_available(stream, str(tmp_path / "out"), "append", str(tmp_path / "state")).collect()
    assert {r["id"]: r["repeat"] for r in out} == {i: (i // 300) % 2 for _, _, i in rows}
    assert {r["k"] for r in out if r["id"] % 300 == 7} == {None}
    states = spark.read.format("statestore").load(str(tmp_path / "state"))
    assert states.count() <= 4
