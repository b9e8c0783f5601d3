"""Every registered query against its SQL, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as entry
from moodtape.plans.catalog import QUERIES
from tests.oracle_compare import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_equals_sql(spark, sf, con, name):
    sql = entry.oracle_sql()[name]
    assert compare(spark, name, entry.queries()[name], sql, sf, con) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"ticker", "optimal_lag_days", "optimal_lag_corr", "sample_size"} <= set(df.columns)


LAZY = [n for n in QUERIES if not re.match("stream_|upsert_|sql_scan|article_json|feed_xml|price_files", n)]


@pytest.mark.parametrize("name", LAZY)
def test_no_pairing_of_everything_and_no_python(spark, sf, name):
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert ("Python" in plan or "MapInPandas" in plan) == (name == "batch_scoring")
