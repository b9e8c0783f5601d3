"""Stored views and the served queries, as functions from frames to a frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtape.operators.correlation import joined_series
from moodtape.operators.dedup import first_per_key

# Fixed value: look-back of the overview.
OVERVIEW_DAYS = 30

SENTIMENT_FIELDS = [
    "avg_sentiment_score",
    "engagement_weighted_score",
    "total_mentions",
    "positive_ratio",
    "negative_ratio",
]
CORRELATION_FIELDS = [
    "analysis_date",
    "optimal_lag_days",
    "optimal_lag_corr",
    "corr_lag_0d",
    "corr_lag_1d",
    "corr_lag_2d",
    "corr_lag_3d",
    "corr_lag_7d",
    "sample_size",
]


def _since(as_of: str, days: int) -> Column:
    """First day of a look-back of ``days`` that ends at ``as_of``."""
    if days < 1:
        raise ValueError(f"days must be at least 1, got {days}")
    return F.date_sub(F.to_date(F.lit(as_of)), days)


def _only(df: DataFrame, column: str, value: str | None) -> DataFrame:
    return df if value is None else df.filter(F.col(column) == value)


def _ticker(code: str | None) -> str | None:
    return None if code is None else code.upper()


class UnknownTickerError(LookupError):
    """A ticker that is not tracked."""


def tracked_ticker(tickers: DataFrame, code: str) -> str:
    """The ticker as it is stored, whatever its case; one that is not in the dimension is refused."""
    upper = code.upper()
    if tickers.filter(F.col("ticker") == upper).isEmpty():
        raise UnknownTickerError(f"ticker {code!r} is not tracked")
    return upper


def _of_ticker(df: DataFrame, code: str | None, tickers: DataFrame | None) -> DataFrame:
    """The rows of one ticker, or all; with the dimension at hand an unknown one is refused."""
    if code is not None and tickers is not None:
        tracked_ticker(tickers, code)
    return _only(df, "ticker", _ticker(code))


def _newest_first(df: DataFrame, single: str | None, key: str, day: str) -> DataFrame:
    return df.orderBy(F.desc(day)) if single is not None else df.orderBy(key, F.desc(day))


# --- views ---------------------------------------------------------------------


def sentiment_price(daily: DataFrame, prices: DataFrame) -> DataFrame:
    """Sentiment next to price, with the returns of the next one and two joined rows."""
    ahead = Window.partitionBy("ticker").orderBy("date")
    return joined_series(daily, prices).select(
        "ticker",
        "date",
        "avg_sentiment_score",
        "engagement_weighted_score",
        "total_mentions",
        "positive_ratio",
        "negative_ratio",
        "sentiment_std",
        "close_price",
        F.col("pct_change").alias("price_change_pct"),
        "volume",
        "intraday_range",
        F.lead("pct_change", 1).over(ahead).alias("next_day_return"),
        F.lead("pct_change", 2).over(ahead).alias("next_2day_return"),
    )


def latest_correlations(correlations: DataFrame, tickers: DataFrame) -> DataFrame:
    """All tickers on the newest analysis date of the table, strongest first."""
    # A scalar subquery, not a join: its value prunes the table's days at the scan.
    newest = correlations.agg(F.max("analysis_date")).scalar()
    current = correlations.where(F.col("analysis_date") == newest)
    named = current.join(tickers.select("ticker", "company_name", "sector"), "ticker")
    return named.orderBy(F.abs("optimal_lag_corr").desc_nulls_last(), "ticker")


def sector_sentiment(daily: DataFrame, prices: DataFrame, tickers: DataFrame) -> DataFrame:
    """Sentiment, mentions and return per sector and day."""
    rows = joined_series(
        daily.select("ticker", "sentiment_date", "avg_sentiment_score", "total_mentions"),
        prices.select("ticker", "trade_date", "pct_change"),
    )
    return (
        rows.join(tickers.select("ticker", "sector"), "ticker")
        .groupBy("sector", F.col("date").alias("sentiment_date"))
        .agg(
            F.count_distinct("ticker").alias("stocks_tracked"),
            F.avg("avg_sentiment_score").alias("avg_sector_sentiment"),
            F.sum("total_mentions").alias("total_sector_mentions"),
            F.avg("pct_change").alias("avg_sector_return"),
        )
    )


# --- served queries ------------------------------------------------------------


def active_tickers(tickers: DataFrame) -> DataFrame:
    return tickers.filter("is_active").select("ticker", "company_name", "sector", "industry").orderBy("ticker")


def sentiment_history(
    daily: DataFrame, as_of: str, days: int = 30, ticker: str | None = None, tickers: DataFrame | None = None
) -> DataFrame:
    """Daily sentiment of one ticker, or of all, over the look-back."""
    rows = _of_ticker(daily, ticker, tickers).filter(F.col("sentiment_date") >= _since(as_of, days))
    out = rows.select("ticker", F.col("sentiment_date").alias("date"), *SENTIMENT_FIELDS)
    return _newest_first(out, ticker, "ticker", "date")


def latest_sentiment(daily: DataFrame, ticker: str | None = None, tickers: DataFrame | None = None) -> DataFrame:
    """The newest day of one ticker, or of each."""
    rows = daily.select("ticker", F.col("sentiment_date").alias("date"), *SENTIMENT_FIELDS)
    if ticker is not None:
        return _of_ticker(rows, ticker, tickers).orderBy(F.desc("date")).limit(1)
    return first_per_key(rows, ["ticker"], [F.desc("date")])


def price_history(
    prices: DataFrame, as_of: str, days: int = 30, ticker: str | None = None, tickers: DataFrame | None = None
) -> DataFrame:
    rows = _of_ticker(prices, ticker, tickers).filter(F.col("trade_date") >= _since(as_of, days))
    out = rows.select("ticker", F.col("trade_date").alias("date"), "close_price", "pct_change", "volume")
    return _newest_first(out, ticker, "ticker", "date")


def latest_correlation(correlations: DataFrame, tickers: DataFrame, ticker: str | None = None) -> DataFrame:
    """The newest correlation row of one ticker, or of each (its own newest date)."""
    named = correlations.join(tickers.select("ticker", "company_name"), "ticker").select(
        "ticker", "company_name", *CORRELATION_FIELDS
    )
    if ticker is not None:
        return _of_ticker(named, ticker, tickers).orderBy(F.desc("analysis_date")).limit(1)
    return first_per_key(named, ["ticker"], [F.desc("analysis_date")])


def top_correlations(correlations: DataFrame, tickers: DataFrame, k: int = 10) -> DataFrame:
    if k < 1:
        raise ValueError(f"k must be at least 1, got {k}")
    return latest_correlations(correlations, tickers).limit(k)


def sector_history(sectors: DataFrame, as_of: str, days: int = 30, sector: str | None = None) -> DataFrame:
    rows = _only(sectors, "sector", sector).filter(F.col("sentiment_date") >= _since(as_of, days))
    return _newest_first(rows, sector, "sector", "sentiment_date")


def sentiment_price_series(
    daily: DataFrame, prices: DataFrame, as_of: str, days: int = 30, ticker: str | None = None
) -> DataFrame:
    """Sentiment and price side by side, oldest first."""
    recent = _only(daily, "ticker", _ticker(ticker)).filter(F.col("sentiment_date") >= _since(as_of, days))
    out = joined_series(recent, prices).select("ticker", "date", *SENTIMENT_FIELDS, "close_price", "pct_change")
    return out.orderBy("ticker", "date")


def sector_overview(sectors: DataFrame, as_of: str, days: int = OVERVIEW_DAYS) -> DataFrame:
    """Unweighted mean over the daily sector values of the look-back, best mood first."""
    return (
        sectors.filter(F.col("sentiment_date") >= _since(as_of, days))
        .groupBy("sector")
        .agg(
            F.avg("avg_sector_sentiment").alias("avg_sentiment"),
            F.avg("avg_sector_return").alias("avg_return"),
            F.sum("total_sector_mentions").alias("total_mentions"),
        )
        .orderBy(F.desc_nulls_last("avg_sentiment"))
    )


def freshness(prices: DataFrame, daily: DataFrame, correlations: DataFrame) -> DataFrame:
    """The newest date of each table, in one row."""
    newest = [
        (prices, "trade_date", "latest_price_date"),
        (daily, "sentiment_date", "latest_sentiment_date"),
        (correlations, "analysis_date", "latest_correlation_date"),
    ]
    rows = [
        df.agg(*[(F.max(day) if n == name else F.lit(None).cast("date")).alias(n) for _, _, n in newest])
        for df, day, name in newest
    ]
    stacked = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return stacked.agg(*[F.max(n).alias(n) for _, _, n in newest])


def period_summary(
    daily: DataFrame,
    prices: DataFrame,
    correlations: DataFrame,
    as_of: str,
    days: int = 30,
    ticker: str | None = None,
) -> DataFrame:
    """Mean sentiment, mentions and mean return over the look-back, with the newest optimal lag."""
    series = sentiment_price_series(daily, prices, as_of, days, ticker)
    means = series.groupBy("ticker").agg(
        F.avg("avg_sentiment_score").alias("avg_sentiment"),
        F.sum("total_mentions").alias("total_mentions"),
        F.avg("pct_change").alias("avg_daily_return"),
    )
    newest = first_per_key(
        _only(correlations, "ticker", _ticker(ticker)).select(
            "ticker", "analysis_date", "optimal_lag_days", "optimal_lag_corr"
        ),
        ["ticker"],
        [F.desc("analysis_date")],
    ).drop("analysis_date")
    return means.join(newest, "ticker", "left")


def top_findings(correlations: DataFrame, run_date: str, k: int = 3) -> DataFrame:
    """The strongest correlations of one run with their direction."""
    rows = correlations.filter(F.col("analysis_date") == F.to_date(F.lit(run_date)))
    ranked = rows.orderBy(F.abs("optimal_lag_corr").desc_nulls_last(), "ticker").limit(k)
    direction = F.when(F.col("optimal_lag_corr") > 0, "positive").otherwise("negative")
    return ranked.select(
        "ticker", "optimal_lag_days", "optimal_lag_corr", "sample_size", direction.alias("direction")
    )


def run_totals(prices: DataFrame, raw: DataFrame, scored: DataFrame, correlations: DataFrame, run_date: str) -> DataFrame:
    """How many rows a run left in each table, articles split by source."""
    day = F.to_date(F.lit(run_date))

    def total(df: DataFrame, name: str, column: str) -> DataFrame:
        counted = df.filter(F.col(column) == day).agg(F.count(F.lit(1)).alias("total"))
        return counted.select(F.lit(name).alias("measure"), "total")

    articles = (
        raw.filter(F.col("collected_date") == day)
        .groupBy(F.concat(F.lit("articles "), F.col("source")).alias("measure"))
        .agg(F.count(F.lit(1)).alias("total"))
    )
    return (
        total(prices, "price rows", "trade_date")
        .unionByName(articles)
        .unionByName(total(scored, "scored articles", "scored_date"))
        .unionByName(total(correlations, "correlated tickers", "analysis_date"))
    )
