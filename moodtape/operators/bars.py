"""Raw bars to daily price rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodtape.functions.numeric import change_pct, round_half_even, spread_pct

# Shortest fetch window in days, so that the first kept bar has a
# predecessor even after a long weekend.
MIN_BUFFER_DAYS = 5


def price_rows(bars: DataFrame, series: Sequence[str] = ("ticker",)) -> DataFrame:
    """Daily rows with percent change and range, for all tickers in one pass.

    ``series`` names the columns that make up one fetched series.  A series has
    one bar per day, so the window group is bounded by the calendar however much
    of the table one ticker holds.  The first bar of a series has no change and
    is dropped.
    """
    prior = F.lag("close").over(Window.partitionBy(*series).orderBy("date"))
    has_adjusted = "adj_close" in bars.columns
    adjusted = F.coalesce("adj_close", "close") if has_adjusted else F.col("close")
    keep = [c for c in series if c != "ticker"]
    return bars.select(
        "ticker",
        *keep,
        F.col("date").cast("date").alias("trade_date"),
        *[round_half_even(c, 4).alias(f"{c}_price") for c in ("open", "high", "low", "close")],
        round_half_even(adjusted, 4).alias("adj_close"),
        F.coalesce(F.col("volume").cast("bigint"), F.lit(0).cast("bigint")).alias("volume"),
        round_half_even(change_pct("close", prior), 4).alias("pct_change"),
        round_half_even(spread_pct("high", "low"), 4).alias("intraday_range"),
    ).dropna(subset=["pct_change"])


def fetch_start(run_date: str, lookback_days: int = 1):
    """First day a fetch for ``run_date`` must cover."""
    return F.date_sub(F.to_date(F.lit(run_date)), max(lookback_days + 1, MIN_BUFFER_DAYS))


def keep_start(run_date: str, lookback_days: int = 1):
    """First day whose rows are kept from that fetch."""
    return F.date_sub(F.to_date(F.lit(run_date)), max(lookback_days - 1, 0))


def collect_prices(bars: DataFrame, run_date: str, lookback_days: int = 1, keep_to: str | None = None) -> DataFrame:
    """Price rows a run contributes: change over the buffered window, then the kept days.

    There is no upper bound unless ``keep_to`` is given, so a late run also
    brings in the days after ``run_date``.
    """
    window = bars.filter(F.col("date").cast("date") >= fetch_start(run_date, lookback_days))
    rows = price_rows(window).filter(F.col("trade_date") >= keep_start(run_date, lookback_days))
    return rows if keep_to is None else rows.filter(F.col("trade_date") <= F.to_date(F.lit(keep_to)))
