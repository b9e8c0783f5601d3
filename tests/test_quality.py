import datetime as dt

import pytest

from pyspark.sql import functions as F

from moodtape.operators import quality
from tests.conftest import rows

DAY = dt.date(2026, 1, 5)


def dates(spark, *extra):
    return spark.createDataFrame([(DAY,), *[(d,) for d in extra]], "run_date date")


def prices(spark, n, close=10.0, pct=1.0):
    return spark.createDataFrame(
        [(f"T{i}", DAY, close, pct) for i in range(n)], "ticker string, trade_date date, close_price double, pct_change double"
    )


def raw(spark, n, text="long enough text", tickers=5, source="news"):
    return spark.createDataFrame(
        [(f"T{i % tickers}", source, DAY, text) for i in range(n)],
        "ticker string, source string, collected_date date, raw_text string",
    )


def scored(spark, n, pos=0.5, neg=0.3, neu=0.2, compound=0.2):
    return spark.createDataFrame(
        [(DAY, pos, neg, neu, compound) for _ in range(n)],
        "scored_date date, score_positive double, score_negative double, score_neutral double, compound_score double",
    )


def daily(spark, n, score=0.5):
    return spark.createDataFrame([(f"T{i}", DAY, score) for i in range(n)], "ticker string, sentiment_date date, avg_sentiment_score double")


def verdict(df, name):
    row = {r["name"]: r for r in df.collect()}[name]
    return row["passed"], row["value"]


@pytest.mark.parametrize("n,ok", [(19, False), (20, True)])
def test_price_row_count(spark, n, ok):
    assert verdict(quality.price_checks(prices(spark, n), dates(spark)), "price_row_count") == (ok, float(n))


@pytest.mark.parametrize("close,null_ok,positive_ok", [(None, False, True), (0.0, True, False), (-1.0, True, False), (0.01, True, True)])
def test_close(spark, close, null_ok, positive_ok):
    checks = quality.price_checks(prices(spark, 2, close), dates(spark))
    assert verdict(checks, "price_no_null_close")[0] == null_ok
    assert verdict(checks, "price_positive_values")[0] == positive_ok


@pytest.mark.parametrize("pct,ok", [(30.0, True), (-30.0, True), (30.0001, False), (-31.0, False), (None, True)])
def test_extreme_change_only_warns(spark, pct, ok):
    checks = quality.price_checks(prices(spark, 25, pct=pct), dates(spark))
    assert verdict(checks, "price_pct_change_range")[0] == ok
    assert quality.require(checks)


@pytest.mark.parametrize("n,ok", [(9, False), (10, True)])
def test_article_count(spark, n, ok):
    assert verdict(quality.raw_checks(raw(spark, n), dates(spark)), "sentiment_row_count") == (ok, float(n))


@pytest.mark.parametrize("text,ok", [("x" * 9, False), ("x" * 10, True), (None, False)])
def test_empty_text(spark, text, ok):
    assert verdict(quality.raw_checks(raw(spark, 10, text), dates(spark)), "sentiment_no_empty_text")[0] == ok


@pytest.mark.parametrize("tickers,ok", [(4, False), (5, True)])
def test_coverage(spark, tickers, ok):
    checks = quality.raw_checks(raw(spark, 20, tickers=tickers), dates(spark))
    assert verdict(checks, "sentiment_ticker_coverage") == (ok, float(tickers))
    assert verdict(checks, "sentiment_multiple_sources") == (True, 1.0)


@pytest.mark.parametrize("n,ok", [(4, False), (5, True)])
def test_scored_count(spark, n, ok):
    assert verdict(quality.scored_checks(scored(spark, n), dates(spark)), "scored_row_count") == (ok, float(n))


@pytest.mark.parametrize("neu,ok", [(0.2, True), (0.209, True), (0.211, False), (0.189, False)])
def test_probability_sum(spark, neu, ok):
    assert verdict(quality.scored_checks(scored(spark, 5, neu=neu), dates(spark)), "scored_probability_sum")[0] == ok


@pytest.mark.parametrize("compound,ok", [(1.0, True), (-1.0, True), (1.0001, False), (-1.0001, False)])
def test_ranges(spark, compound, ok):
    assert verdict(quality.scored_checks(scored(spark, 5, compound=compound), dates(spark)), "scored_compound_range")[0] == ok
    assert verdict(quality.daily_checks(daily(spark, 3, compound), dates(spark)), "daily_agg_score_range")[0] == ok


@pytest.mark.parametrize("n,ok", [(2, False), (3, True)])
def test_daily_count(spark, n, ok):
    assert verdict(quality.daily_checks(daily(spark, n), dates(spark)), "daily_agg_row_count") == (ok, float(n))


def test_empty_tables_fail(spark):
    none = [f(spark, 1).limit(0) for f in (prices, raw, scored, daily)]
    checks = quality.all_checks(*none, dates(spark))
    got = {r["name"]: r for r in checks.collect()}
    assert len(got) == 13
    failed = {n for n, r in got.items() if r["critical"] and not r["passed"]}
    assert failed == {
        "price_row_count", "sentiment_row_count", "sentiment_ticker_coverage", "scored_row_count",
        "scored_probability_sum", "daily_agg_row_count",
    }
    assert got["scored_probability_sum"]["value"] is None
    with pytest.raises(quality.QualityError, match="price_row_count"):
        quality.require(checks)


def test_report_per_date(spark):
    other = DAY + dt.timedelta(days=1)
    checks = quality.all_checks(prices(spark, 20), raw(spark, 10), scored(spark, 5), daily(spark, 3), dates(spark, other))
    got = {r["run_date"]: r for r in quality.report(checks).collect()}
    assert (got[DAY]["passed"], got[DAY]["failed"], got[DAY]["critical_failures"], got[DAY]["pipeline_ok"]) == (13, 0, "", True)
    assert not got[other]["pipeline_ok"] and "daily_agg_row_count" in got[other]["critical_failures"]


@pytest.mark.parametrize("sizes,stale,ok", [([10, 50], 0, True), ([9, 10], 1, False), ([], 0, True)])
def test_publish_gate(spark, sizes, stale, ok):
    df = spark.createDataFrame([(n,) for n in sizes], "sample_size int")
    assert tuple(quality.publish_gate(df).first()) == (stale, ok)


def test_found_days_equal_given_days(spark):
    prices = spark.createDataFrame(
        [("A", "2024-01-01", 1.0, 50.0), ("B", "2024-01-04", None, 1.0), ("B", "2024-01-04", -1.0, None)],
        "ticker string, trade_date string, close_price double, pct_change double",
    ).withColumn("trade_date", F.to_date("trade_date"))
    raw = spark.createDataFrame(
        [("news", "A", "2024-01-03", "short"), ("news", "B", "2024-01-06", "long enough text")],
        "source string, ticker string, collected_date string, raw_text string",
    ).withColumn("collected_date", F.to_date("collected_date"))
    daily = spark.createDataFrame([("A", "2024-01-03", 2.0), ("A", "2024-01-09", 0.0)], "ticker string, sentiment_date string, avg_sentiment_score double")
    daily = daily.withColumn("sentiment_date", F.to_date("sentiment_date"))
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-06')) AS run_date")
    expected = quality.collection_checks(prices, raw, days).unionByName(quality.daily_checks(daily, days))
    assert rows(quality.found_days_checks(prices, raw, daily=daily)) == rows(expected)
    assert quality.found_days_checks(prices.limit(0), raw.limit(0)).count() == 0
