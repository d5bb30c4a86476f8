"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.harness import compare

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# estimators that take long and have no SQL; covered by tests of their own
SLOW = {"m8_boosted_trees", "m9_search", "m10_learning_curve", "c1_kmeans_inertia", "m9_cross_validation"}


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["condition", "avg_stay_days", "patients"]
    assert df.count() == 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, con, name):
    ok, message = compare(spark, sf, name, QUERIES[name], ORACLES[name], con)
    assert ok, message


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_gives_rows(spark, sf, name):
    ok, message = compare(spark, sf, name, QUERIES[name], None)
    assert ok, message
