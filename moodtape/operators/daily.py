"""Daily sentiment per ticker and the counts around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtape.functions.numeric import engagement_weight, mean_4dp, round_half_up, weighted_mean

# Source codes, and the fewest articles a day needs to count.
SOURCES = ("news", "google_news", "yahoo_finance")
MIN_MENTIONS = 2


def daily_measures() -> list:
    """The aggregates of one (ticker, day) group, shared by the batch and the streaming form."""
    weight = engagement_weight("upvotes")
    return [
        F.count(F.lit(1)).alias("total_mentions"),
        *[F.count_if(F.col("source") == s).alias(f"{s}_mentions") for s in SOURCES],
        round_half_up(mean_4dp("compound_score"), 4).alias("avg_sentiment_score"),
        round_half_up(weighted_mean("compound_score", weight), 4).alias("engagement_weighted_score"),
        round_half_up(mean_4dp("score_positive"), 4).alias("positive_ratio"),
        round_half_up(mean_4dp("score_negative"), 4).alias("negative_ratio"),
        round_half_up(mean_4dp("score_neutral"), 4).alias("neutral_ratio"),
        round_half_up(F.stddev_samp("compound_score"), 4).alias("sentiment_std"),
    ]


def daily_sentiment(scored: DataFrame, raw: DataFrame | None = None, min_mentions: int = MIN_MENTIONS) -> DataFrame:
    """One row per ticker and day with at least ``min_mentions`` articles, all days in one job.

    Scored rows carry source and upvotes; for a scored table without them pass
    ``raw`` and they are joined in by id.  Every aggregate merges partial
    results, so only one row per group and map task is shuffled.
    """
    if raw is not None:
        extra = raw.select(F.col("id").alias("raw_id"), "source", "upvotes")
        scored = scored.drop("source", "upvotes").join(extra, "raw_id")
    grouped = scored.groupBy("ticker", F.col("scored_date").alias("sentiment_date")).agg(*daily_measures())
    return grouped.filter(F.col("total_mentions") >= min_mentions)


def counts_by_ticker(rows: DataFrame, tickers: DataFrame) -> DataFrame:
    """Rows per tracked ticker, zero where there are none."""
    counted = rows.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))
    return tickers.select("ticker").join(counted, "ticker", "left").select("ticker", F.coalesce("n", F.lit(0)).alias("n"))


def busiest(counts: DataFrame) -> DataFrame:
    """Tickers with any rows, most first."""
    return counts.filter("n > 0").orderBy(F.desc("n"), "ticker")


def counts_by_source(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*by, "source").agg(F.count(F.lit(1)).alias("n"))
