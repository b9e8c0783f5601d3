"""Properties of physical plans that matter at size."""

import re

from pyspark.sql import functions as F

from moodtape.operators import correlation, daily, dedup, quality, scoring
from moodtape.plans import views
from moodtape.sources import star
from moodtape.sources.tables import Tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(plan, name):
    return len(re.findall(rf"(?m)^[\s:+\-|]*(?:\*\(\d+\) )?{name}\b", plan))


def stored(spark, tmp_path, sf):
    tables = Tables(spark, str(tmp_path / "t")).create()
    tables.append("daily_sentiment", star.daily(spark, sf))
    tables.append("price_daily", star.prices(spark, sf))
    return tables


def test_correlation_over_stored_tables(spark, sf, tmp_path):
    t = stored(spark, tmp_path, sf)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(
            correlation.lag_correlation(t.read("daily_sentiment"), t.read("price_daily"), "2024-01-30", 10)
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert nodes(plan, "Window") == 1
    assert nodes(plan, "Exchange") == 3
    # The date range prunes partitions on both sides, not only the one it is written for.
    assert "sentiment_date#" in plan and len(re.findall(r"PartitionFilters: \[[^\]]*>= 2024-01-20", plan)) >= 2
    assert "engagement_weighted_score" not in plan and "close_price" not in plan


def test_backfill_groups_reuse_the_partitioning(spark, sf, tmp_path):
    t = stored(spark, tmp_path, sf)
    plan = plan_of(
        correlation.backfill_correlation(t.read("daily_sentiment"), t.read("price_daily"), "2024-01-10", "2024-01-30")
    )
    after_window = plan[: plan.index("Window")]
    assert "Exchange" not in after_window


def test_first_per_key_limits_groups_before_the_shuffle(spark, sf):
    plan = plan_of(dedup.first_per_key(star.raw_articles(spark, sf), ["source", "source_id", "ticker"], ["id"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    full = dedup.first_per_full_key(star.raw_articles(spark, sf), ["source", "source_id", "ticker"], ["id"])
    assert "Partial" in plan_of(full)


def test_ticker_lookup_reaches_the_scan(spark, sf, tmp_path):
    t = stored(spark, tmp_path, sf)
    plan = plan_of(views.sentiment_history(t.read("daily_sentiment"), "2024-01-30", 5, "NATION_3"))
    assert "EqualTo(ticker,NATION_3)" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*sentiment_date[^\]]*>= 2024-01-25", plan)
    assert "sentiment_std" not in plan


def test_top_k_is_a_top_k(spark, sf, tmp_path):
    t = stored(spark, tmp_path, sf)
    corr = correlation.correlation_rows(t.read("daily_sentiment"), t.read("price_daily"), "2024-01-30")
    assert "TakeOrderedAndProject" in plan_of(views.top_findings(corr, "2024-01-30"))


def test_checks_read_each_table_once(spark, sf):
    scored = star.scored_articles(spark, sf)
    dates = quality.run_dates(star.daily(spark, sf), "sentiment_date")
    plan = plan_of(quality.scored_checks(scored, dates))
    assert nodes(plan, "FileScan") == 2  # the scored table and the dates


def test_daily_roll_up_aggregates_before_its_only_shuffle(spark, sf):
    plan = plan_of(daily.daily_sentiment(star.scored_articles(spark, sf)))
    assert nodes(plan, "Exchange") == 1
    assert "partial_count" in plan[plan.index("Exchange"):]


def test_cleaning_runs_once(spark, sf):
    raw = star.documents(spark, sf).select(
        "*", F.lit("A").alias("ticker"), F.lit("news").alias("source"), F.lit(0).alias("upvotes")
    )
    none = raw.limit(0).select(F.col("id").alias("raw_id"))
    plan = plan_of(scoring.score_articles(raw, none))
    assert plan.count("regexp_replace(CASE WHEN") == 1
