"""Small literal frames with known answers, and properties checked against NumPy."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.functions import arrays as arr
from tidemill.functions import scalars as sc
from tidemill.operators import aggregates as agg
from tidemill.operators import ordering, quality, star, stats
from tidemill.sources import files


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


STAFF = [
    (1, "Ada", "IT", 70000.0, 30.0, 4.0), (2, "Bo", "IT", 90000.0, 45.0, None), (3, "Cy", "HR", None, 28.0, 3.0),
    (4, "Di", "HR", 50000.0, None, 3.5), (5, "Ed", "Ops", 60000.0, 37.0, 4.5),
]


@pytest.fixture(scope="module")
def staff(spark):
    return spark.createDataFrame(STAFF, "id int, name string, department string, salary double, age double, performance double")


def test_cleaning_leaves_no_nulls(staff):
    filled = quality.fill_mean_rounded(quality.fill_median(staff, ["salary"]), "age")
    clean = quality.drop_nulls(filled, ["performance"])
    assert {r["column"]: r["nulls"] for r in quality.null_counts(clean).collect()} == dict.fromkeys(staff.columns, 0)
    rows = {r["id"]: r for r in clean.collect()}
    assert set(rows) == {1, 3, 4, 5}
    assert rows[3]["salary"] == 65000.0 and rows[4]["age"] == 35.0


def test_group_means_sorted(staff):
    rows = agg.group_means(staff, "department", avg_salary="salary").collect()
    assert [r["department"] for r in rows] == ["IT", "Ops", "HR"]


def test_title_case_starts_words_after_any_non_letter(spark):
    df = spark.createDataFrame([("o'brien MC-donald 3RD",), ("élan VITAL",), ("",)], "s string")
    assert [r[0] for r in df.select(sc.title_case("s")).collect()] == ["O'Brien Mc-Donald 3Rd", "Élan Vital", ""]


def test_number_band(spark):
    df = spark.createDataFrame([(-5,), (0,), (7,), (42,), (None,)], "n int")
    assert [r[0] for r in df.select(sc.number_band("n")).collect()] == ["negative", "zero", "small positive", "large positive", None]


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 0, "x"), (6, 3, "y")], "a int, b int, s string")
    assert [r["ratio"] for r in sc.safe_divide(df, "a", "b").collect()] == [None, 2.0]
    with pytest.raises(TypeError):
        sc.safe_divide(df, "a", "s")


def test_money_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,)], "x double")
    assert [r[0] for r in df.select(sc.money("x")).collect()] == [0.12, 0.38, 2.5]


def test_length_of_stay(spark):
    d = dt.date
    df = spark.createDataFrame([(d(2024, 1, 3), d(2024, 1, 1)), (d(2024, 1, 1), d(2024, 1, 5)), (d(2024, 1, 1), None)], "a date, b date")
    assert [r[0] for r in df.select(sc.length_of_stay("a", "b")).collect()] == [0, 4, None]


def test_vector_columns(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 2.0])], "v array<double>, w array<double>")
    r = one(df.select(arr.norm("v"), arr.dot("v", "w"), arr.element("v", 9), arr.mean_square("v", "w")))
    assert tuple(r) == (5.0, 11.0, None, 4.0)


def test_joint_and_bayes(spark):
    r = one(spark.range(1).select(stats.bayes(F.lit(0.3), F.lit(0.8), F.lit(0.05))))
    assert r[0] == pytest.approx(0.24 / 0.275)


def test_p_values_match_known_points(spark):
    df = spark.createDataFrame([(2.228, 10.0), (0.0, 5.0), (-2.086, 20.0)], "t double, n double")
    got = [r[0] for r in df.select(stats.two_sided_p("t", "n")).collect()]
    assert got == pytest.approx([0.05, 1.0, 0.05], abs=2e-4)


def test_error_metrics(spark):
    y, p = [3.0, -0.5, 2.0, 7.0], [2.5, 0.0, 2.0, 8.0]
    r = one(agg.error_metrics(spark.createDataFrame(list(zip(y, p)), "y double, p double"), "y", "p", features=1))
    assert r["mae"] == 0.5 and r["mse"] == 0.375 and r["r2"] == pytest.approx(0.948608137)
    assert r["adj_r2"] == pytest.approx(1 - (1 - r["r2"]) * 3 / 2)


def test_constant_column_histogram(spark):
    rows = agg.histogram(spark.createDataFrame([(2.0,)] * 5, "x double"), "x", 3).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [5, 0, 0]


def test_histogram_closes_last_bin(spark):
    values = [0.0, 1.0, 2.0, 3.0, 3.0, 9.0]
    rows = agg.histogram(spark.createDataFrame([(v,) for v in values], "x double"), "x", 3).orderBy("bin").collect()
    assert [r["n"] for r in rows] == list(np.histogram(values, 3)[0])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = ordering.quantile_values(df, "x", [0.0, 0.01, 0.25, 0.5, 0.9, 1.0])
    assert got == pytest.approx(list(np.quantile(values, [0.0, 0.01, 0.25, 0.5, 0.9, 1.0])))


def test_quantiles_per_group_with_hot_value(spark):
    rows = [("hot", 1.0)] * 400 + [("hot", 2.0)] * 5 + [("cold", float(i)) for i in range(9)] + [(None, 4.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(6)
    got = {r["g"]: r["value"] for r in ordering.quantiles(df, ["x"], [0.5], by=["g"]).collect()}
    assert got == {"hot": 1.0, "cold": 4.0, None: 4.0}


def test_global_index_is_dense_and_ordered(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k")).repartition(7)
    rows = ordering.global_index(df, F.desc("k"), name="i", start=1, total="n").collect()
    assert sorted((r["i"], r["k"]) for r in rows) == [(i + 1, 999 - i) for i in range(1000)]
    assert {r["n"] for r in rows} == {1000}


def test_folds_cover_rows_once(spark):
    df = spark.range(23)
    sizes = [r["count"] for r in ordering.contiguous_folds(df, "id").groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [5, 5, 5, 4, 4]
    tests = ordering.expanding_folds(df, "id").filter("role = 'test'").groupBy("fold").agg(F.min("id"), F.max("id")).orderBy("fold")
    assert [tuple(r)[1:] for r in tests.collect()] == [(8, 10), (11, 13), (14, 16), (17, 19), (20, 22)]


def test_result_cap(spark):
    assert ordering.capped(spark.range(900), 50_000).count() == 200
    assert ordering.capped(spark.range(900), 7).count() == 7


def test_star_load_refreshes(spark, tmp_path):
    schema = (
        "admission_id bigint, patient_name string, age bigint, gender string, condition string, admitted date, doctor string, "
        "hospital string, insurer string, billing double, admission_type string, discharged date, result string"
    )
    d = dt.date(2024, 5, 1)
    row = (1, " ann LEE ", 40, "FEMALE", "asthma", d, "dr o'neil", " St Mary ", "Acme", 10.129, "urgent", d + dt.timedelta(3), "normal")
    same = (1, "Ann Lee", 40, "female", "ASTHMA", d, "Dr O'Neil", "St Mary", "Acme", 10.13, "URGENT", d + dt.timedelta(3), "NORMAL")
    flat = spark.createDataFrame([row, same], schema)
    for _ in range(2):
        loaded = star.load_star(flat, str(tmp_path / "star"))
        r = one(loaded.admissions)
        assert (r["doctor_id"], r["hospital_id"], r["provider_id"], r["stay_days"], r["billing"]) == (1, 1, 1, 3, 10.13)
        assert one(loaded.doctors)["name"] == "Dr O'Neil"


def test_document_reader_titles_and_skips(spark, tmp_path):
    (tmp_path / "visitor_policy.md").write_text("# Visitor Policy\n\nBe kind.")
    (tmp_path / "night_shift.txt").write_bytes(b"no title \xff here")
    (tmp_path / "scan.pdf").write_bytes(b"%PDF")
    docs = {r["doc_id"]: r for r in files.read_documents(spark, str(tmp_path)).collect()}
    assert docs["visitor_policy"]["title"] == "Visitor Policy"
    assert docs["night_shift"]["title"] == "Night Shift" and docs["night_shift"]["text"] == "no title  here"
    skipped = [r["path"].rsplit("/", 1)[1] for r in files.skipped_files(spark, str(tmp_path)).collect()]
    assert skipped == ["scan.pdf"]


def test_next_value_crosses_time_units(spark):
    t = dt.datetime
    rows = [("a", t(2024, 1, 1, 5), 1, "x"), ("a", t(2024, 1, 1, 6), 2, "y"), ("a", t(2024, 1, 9, 1), 3, "z"), ("b", t(2024, 1, 2), 4, "w")]
    df = spark.createDataFrame(rows, "g string, ts timestamp_ntz, id int, v string")
    got = {r["id"]: r["nx"] for r in stats.next_value(df, ["g"], "ts", "id", "v", "nx").collect()}
    assert got == {1: "y", 2: "z", 3: None, 4: None}


def test_integrity_rules(spark):
    fact = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, k int")
    dim = spark.createDataFrame([(10, "a"), (11, "a")], "k int, name string")
    assert [r["value"] for r in quality.foreign_key_violations(fact, "k", dim, "k").collect()] == ["99"]
    assert [r["value"] for r in quality.unique_violations(dim, "name").collect()] == ["a"]
    assert [r["value"] for r in quality.not_null_violations(fact, "id", ["k"]).collect()] == ["3"]


def test_merge_answers(spark):
    cols = "question_id int, success boolean, answer string, error string"
    data = spark.createDataFrame([(1, True, "5", None), (2, False, None, "bad"), (3, False, None, None)], cols)
    policy = spark.createDataFrame([(1, True, "rule", None), (3, False, None, "none"), (4, True, "alone", None)], cols)
    got = {r[0]: r[1] for r in star.merge_answers(data, policy).collect()}
    assert got == {
        1: "Data: 5\n\nPolicy: rule", 2: "bad", 3: "Neither the database nor the policy documents could answer this.", 4: "alone",
    }


def test_psi_flags_a_shift(spark):
    base = spark.range(1000).select((F.col("id") / 10).alias("x"))
    moved = base.select((F.col("x") + 40).alias("x"))
    same, shifted = (one(stats.psi_by_period(base, d, "x")) for d in (base, moved))
    assert same["status"] == "Stable" and same["psi"] == pytest.approx(0, abs=1e-9)
    assert shifted["status"] == "Major"


def test_retrain_needs_two_weeks(spark):
    df = spark.createDataFrame([(1, 0.3), (2, 0.1), (3, 0.25), (4, 0.4)], "week int, psi double")
    assert [r["retrain"] for r in stats.consecutive_alerts(df, "week").orderBy("week").collect()] == [0, 0, 0, 1]
    dated = spark.sql("SELECT date'2024-01-01' + INTERVAL 7 DAY * w AS week, 0.3 AS psi FROM VALUES (0), (1), (3), (4) AS t(w)")
    dated = dated.withColumn("week", dated["week"].cast("date"))
    assert [r["retrain"] for r in stats.consecutive_alerts(dated, "week").orderBy("week").collect()] == [0, 1, 0, 1]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 31, 100, 1000])
def test_permutations_of_row_numbers(spark, n):
    keys = [F.lit(k).cast("long") for k in (12345, 678, 91011, 1213)]
    got = [r["p"] for r in spark.range(n).select(stats.permuted(F.col("id"), keys, n).alias("p")).collect()]
    assert sorted(got) == list(range(n))
    assert n < 8 or got != list(range(n))


def test_permutations_beyond_32_bits(spark):
    n = (1 << 41) + 12345
    keys = [F.lit(k).cast("long") for k in (5, 6, 7, 8)]
    rows = spark.range(0, n, n // 5000).select(F.col("id"), stats.permuted(F.col("id"), keys, n).alias("p")).collect()
    p = [r["p"] for r in rows]
    assert len(set(p)) == len(p) and min(p) >= 0 and max(p) < n and max(p) > n * 0.99
    assert sum(v % 2 for v in p) / len(p) == pytest.approx(0.5, abs=0.05)


def test_subsamples_are_distinct_rows(spark):
    df = spark.createDataFrame([(i, float(2**i)) for i in range(12)], "k int, v double")
    means = stats.sampling_means(df, "v", "k", replicates=400, size=5).collect()
    assert len(means) == 400 and all(bin(round(r["mean"] * 5)).count("1") == 5 for r in means)
    seen = set()
    for r in means:
        seen |= {i for i in range(12) if round(r["mean"] * 5) >> i & 1}
    assert seen == set(range(12))
    assert {r["mean"] for r in stats.sampling_means(df, "v", "k", replicates=3, size=50).collect()} == {(2**12 - 1) / 12}
    assert stats.sampling_means(df.limit(0), "v", "k").count() == 0


@pytest.mark.parametrize("kind", ["normal", "tailed", "hot"])
def test_density_against_all_terms(spark, kind):
    draw = np.random.default_rng(3)
    x = {"normal": draw.normal(5e6, 2e3, 700), "tailed": draw.standard_cauchy(700) * 1e3, "hot": draw.choice([0.0, 1.0, 9e3], 700)}[kind]
    rows = agg.kernel_density(spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double"), "v", 50).orderBy("point").collect()
    grid = np.linspace(x.min() - 5000, x.max() + 5000, 50)
    h = x.std(ddof=1) * len(x) ** -0.2
    want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert np.allclose([r["x"] for r in rows], grid)
    assert np.abs(np.array([r["density"] for r in rows]) - want).max() < 1e-12 / h


def test_density_without_spread_or_values(spark):
    df = spark.createDataFrame([(None,), (2.0,), (2.0,)], "v double")
    for given in (df, df.limit(2)):
        rows = agg.kernel_density(given, "v", 4, 3.0).orderBy("point").collect()
        assert [(r["x"], r["density"]) for r in rows] == [(-1.0, None), (1.0, None), (3.0, None), (5.0, None)]
    assert agg.kernel_density(df.filter("v IS NULL"), "v", 4).count() == 0


def test_correlation_of_a_constant_column_is_nan(spark):
    df = spark.createDataFrame([(1, 2.0, 4.0), (1, 3.0, 6.0), (1, 5.0, 10.0), (1, None, 3.0)], "a int, b double, c double")
    rows = {(r["x"], r["y"]): r["r"] for r in agg.correlations(df, ["a", "b", "c"]).collect()}
    assert np.isnan(rows["a", "b"]) and np.isnan(rows["a", "c"]) and abs(rows["b", "c"] - 1) < 1e-12
    assert one(agg.correlations(df.filter("b > 9"), ["a", "b"]))["r"] is None
    tested = one(stats.pearson_test(df, "a", "b"))
    assert np.isnan(tested["r"]) and tested["p"] is None
