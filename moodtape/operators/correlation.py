"""Lagged correlation of sentiment with returns, for one day or a range of days.

Lags count rows of the joined series, that is days with both sentiment and a
price, not calendar days.  A lag cannot look back past the start of the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from moodtape.functions.numeric import pearson, round_half_up

# Lags in rows, rolling length in rows, fewest rows for a result,
# look-back in days.
LAGS = (0, 1, 2, 3, 7)
ROLLING_ROWS = 30
MIN_SAMPLE = 10
LOOKBACK_DAYS = 90


def joined_series(daily: DataFrame, prices: DataFrame) -> DataFrame:
    """Sentiment and price of the same ticker and day."""
    left = daily.withColumnRenamed("sentiment_date", "date")
    right = prices.withColumnRenamed("trade_date", "date")
    return left.join(right, ["ticker", "date"])


def _series(daily: DataFrame, prices: DataFrame, first: Column, last: Column) -> DataFrame:
    days = daily.filter(F.col("sentiment_date").between(first, last))
    return joined_series(
        days.select("ticker", "sentiment_date", "avg_sentiment_score"),
        prices.select("ticker", "trade_date", "pct_change"),
    ).select("ticker", "date", F.col("avg_sentiment_score").alias("x"), F.col("pct_change").alias("y"))


def _by_row(*keys: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("date")


def _rolling_mean(c: str, *keys: str) -> Column:
    return F.avg(c).over(_by_row(*keys).rowsBetween(1 - ROLLING_ROWS, 0))


def _complete_rows(series: DataFrame, keys: Sequence[str], rolling_x: Column, rolling_y: Column) -> DataFrame:
    """Lags and rolling means within each key group, then the rows with both values.

    Lags and rolling means see all joined rows; the incomplete ones are left out
    only afterwards.  All of it is one window, so one sort.
    """
    return series.select(
        *keys,
        "y",
        *[(F.lag("x", k).over(_by_row(*keys)) if k else F.col("x")).alias(f"x{k}") for k in LAGS],
        rolling_x.alias("rolling_x"),
        rolling_y.alias("rolling_y"),
    ).filter(F.col("x0").isNotNull() & F.col("y").isNotNull())


def _correlations() -> list[Column]:
    return [
        *[round_half_up(pearson(f"x{k}", "y"), 6).alias(f"corr_lag_{k}d") for k in LAGS],
        round_half_up(F.avg("rolling_x"), 4).alias("rolling_30d_avg_sent"),
        round_half_up(F.avg("rolling_y"), 4).alias("rolling_30d_price_ret"),
        F.count(F.lit(1)).alias("sample_size"),
    ]


def lag_correlation(
    daily: DataFrame,
    prices: DataFrame,
    run_date: str,
    lookback_days: int = LOOKBACK_DAYS,
    min_sample: int = MIN_SAMPLE,
) -> DataFrame:
    """Correlations at every lag for the window that ends on ``run_date``.

    A window group is one ticker with one row per day: as long as the calendar,
    no longer.  ``sample_size`` counts complete lag-0 pairs.
    """
    end = F.to_date(F.lit(run_date))
    series = _series(daily, prices, F.date_sub(end, lookback_days), end)
    rows = _complete_rows(series, ["ticker"], _rolling_mean("x", "ticker"), _rolling_mean("y", "ticker"))
    found = rows.groupBy("ticker").agg(*_correlations())
    return found.filter(F.col("sample_size") >= min_sample).select(
        "ticker", end.alias("analysis_date"), *found.columns[1:]
    )


def optimal_lag(correlations: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """Add the lag with the largest absolute correlation and its value.

    Lags are tried in order and only a strictly larger value wins, so a tie goes
    to the shorter lag; with no correlation at all the answer is lag 0, value 0.
    """
    tried = ", ".join(f"struct({k} AS lag, corr_lag_{k}d AS r)" for k in lags)
    best = F.expr(
        f"""aggregate(filter(array({tried}), t -> t.r IS NOT NULL AND NOT isnan(t.r)),
                      struct(0 AS lag, 0.0D AS r),
                      (a, t) -> if(abs(t.r) > abs(a.r), t, a))"""
    )
    return correlations.withColumn("_best", best).select(
        "*", F.col("_best.lag").alias("optimal_lag_days"), round_half_up("_best.r", 6).alias("optimal_lag_corr")
    ).drop("_best")


def correlation_rows(daily: DataFrame, prices: DataFrame, run_date: str, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows of the correlation table for one analysis date."""
    return optimal_lag(lag_correlation(daily, prices, run_date, lookback_days))


def largest_samples(correlations: DataFrame, k: int = 5) -> DataFrame:
    return correlations.orderBy(F.desc("sample_size"), "ticker").limit(k)


#: Both series are stored with four decimals; in these units their sums are whole numbers, exact in a double to 2**53.
UNITS = 10_000.0


def _running_sums(series: DataFrame) -> DataFrame:
    """For every row the sums over it and all rows of its ticker before, of what each lag's correlation is made of.

    ``n``, ``x``, ``y``, ``xx``, ``yy``, ``xy`` with the lag count complete pairs; ``all_x`` and ``n_x`` (and y's) all
    values, ``roll_x`` and ``roll_y`` the full rolling means of complete rows.
    """
    by = _by_row("ticker")
    so_far = by.rowsBetween(Window.unboundedPreceding, 0)
    complete = F.col("x").isNotNull() & F.col("y").isNotNull()
    rows = series.select(
        "ticker",
        "date",
        *[F.round(F.col(c) * UNITS).alias(c) for c in ("x", "y")],
        F.row_number().over(by).alias("nth"),
    )
    rows = rows.select(
        "*",
        complete.alias("complete"),
        *[F.when(complete, F.lag("x", k).over(by) if k else F.col("x")).alias(f"x{k}") for k in LAGS],
        *[F.when(complete, _rolling_mean(c, "ticker")).alias(f"rolling_{c}") for c in ("x", "y")],
        F.lag("date").over(by).alias("date_before"),
        F.lead("date").over(by).alias("date_after"),
    )

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value).over(so_far), F.lit(0.0))

    sums = [total(F.col(c)).alias(f"all_{c}") for c in ("x", "y")]
    sums += [F.count(c).over(so_far).cast("double").alias(f"n_{c}") for c in ("x", "y")]
    sums += [total(F.col(f"rolling_{c}")).alias(f"roll_{c}") for c in ("x", "y")]
    for k in LAGS:
        x, y = F.col(f"x{k}"), F.when(F.col(f"x{k}").isNotNull(), F.col("y"))
        for name, value in (("n", F.when(x.isNotNull(), 1.0)), ("x", x), ("y", y), ("xx", x * x), ("yy", y * y), ("xy", x * y)):
            sums.append(total(value).alias(f"{name}_{k}"))
    return rows.select("*", *sums)


def _sum_names() -> list[str]:
    return [f"{name}_{k}" for k in LAGS for name in ("n", "x", "y", "xx", "yy", "xy")]


def backfill_correlation(
    daily: DataFrame,
    prices: DataFrame,
    start: str,
    end: str,
    lookback_days: int = LOOKBACK_DAYS,
    min_sample: int = MIN_SAMPLE,
) -> DataFrame:
    """``lag_correlation`` for every day from ``start`` to ``end``, in one job.

    A date's window runs from its first row a to its last row b, and what a
    correlation needs of it are sums over pairs within, so differences of running
    sums: those up to b less those up to the row before a (with lag k, k rows
    later, as the first k rows of a window have no value so far back).  A row is
    the last one for the dates up to the next row, and the first one for the dates
    since the look-back left the row before, so a date takes two rows however far
    it looks back.  Only the short series is shuffled, by ticker.

    A rolling mean is that of the whole series from a window's 30th row on; for the
    up to 29 rows before it is a running mean from a, made from running sums too.
    Values count with four decimals, as both tables store them, so sums are exact.
    """
    first, last = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    series = _series(daily, prices, F.date_sub(first, lookback_days), last)
    by = _by_row("ticker")
    rows = _running_sums(series)
    few = ROLLING_ROWS - 1

    # What a window that starts at this row leaves out, and its first rows.
    def before(name: str, later: int) -> Column:
        held = F.lag(name).over(by) if later == 0 else F.lead(name, later - 1).over(by) if later > 1 else F.col(name)
        return F.coalesce(held, F.lit(0.0)).alias(f"out_{name}")

    kept = F.struct("date", "complete", "all_x", "all_y", "n_x", "n_y")
    rows = rows.select(
        "*",
        *[before(name, int(name.rsplit("_", 1)[1])) for name in _sum_names()],
        *[before(f"roll_{c}", few).alias(f"out_roll_{c}") for c in ("x", "y")],
        *[before(name, 0) for name in ("all_x", "all_y", "n_x", "n_y")],
        F.collect_list(kept).over(by.rowsBetween(0, few - 1)).alias("next_rows"),
    )

    def early(day: Column) -> Column:
        """The sums of running means over the complete ones of the first rows up to the day."""

        def mean(r: Column, c: str) -> Column:
            return (r[f"all_{c}"] - F.col(f"out_all_{c}")) / (r[f"n_{c}"] - F.col(f"out_n_{c}"))

        here = F.filter("next_rows", lambda r: r.complete & (r.date <= day))
        none = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
        return F.aggregate(here, none, lambda a, r: F.struct((a.x + mean(r, "x")).alias("x"), (a.y + mean(r, "y")).alias("y")))

    def days(since: Column, until: Column, is_last: bool) -> Column:
        since, until = F.greatest(first, F.col("date"), since), F.least(last, F.date_add("date", lookback_days), until)
        every = F.when(since <= until, F.sequence(since, until)).otherwise(F.array().cast("array<date>"))
        means = F.lit(None).cast("struct<x: double, y: double>")
        return F.transform(
            every, lambda d: F.struct(d.alias("analysis_date"), F.lit(is_last).alias("is_last"), (means if is_last else early(d)).alias("early"))
        )

    as_last = days(first, F.coalesce(F.date_sub("date_after", 1), last), True)
    as_first = days(F.coalesce(F.date_add("date_before", lookback_days + 1), first), last, False)
    events = rows.withColumn("event", F.explode(F.concat(as_last, as_first))).select("*", "event.*")

    is_last = F.col("is_last")
    found = events.groupBy("ticker", "analysis_date").agg(
        F.sum(F.when(is_last, F.col("nth")).otherwise(1 - F.col("nth"))).alias("rows"),
        *[F.sum(F.when(is_last, F.col(c)).otherwise(-F.col(f"out_{c}"))).alias(c) for c in _sum_names() + ["roll_x", "roll_y"]],
        *[F.sum(f"early.{c}").alias(f"early_{c}") for c in ("x", "y")],
    )

    def correlation(k: int) -> Column:
        n, x, y, xx, yy, xy = [F.col(f"{name}_{k}") for name in ("n", "x", "y", "xx", "yy", "xy")]
        spread = (n * xx - x * x) * (n * yy - y * y)
        known = (F.col("rows") > k) & (n * xx > x * x) & (n * yy > y * y)
        return F.when(known, round_half_up((n * xy - x * y) / F.sqrt(spread), 6)).alias(f"corr_lag_{k}d")

    def rolling(c: str) -> Column:
        total = F.col(f"early_{c}") + F.when(F.col("rows") > few, F.col(f"roll_{c}")).otherwise(0.0)
        return round_half_up(total / F.col("n_0") / UNITS, 4)

    return found.filter(F.col("n_0") >= min_sample).select(
        "ticker",
        "analysis_date",
        *[correlation(k) for k in LAGS],
        rolling("x").alias("rolling_30d_avg_sent"),
        rolling("y").alias("rolling_30d_price_ret"),
        F.col("n_0").cast("long").alias("sample_size"),
    )
