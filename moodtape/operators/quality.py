"""Data-quality checks: one aggregate pass per table, for any number of run dates."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtape.functions.text import MIN_VALID_TEXT
from moodtape.operators.correlation import MIN_SAMPLE


@dataclass(frozen=True)
class Check:
    """One rule: the measured column must be at least, at most or below a bound."""

    name: str
    measure: str
    rule: str  # ">=", "=" or "<"
    bound: float
    critical: bool
    message: str  # printf pattern over the measured value


# Rule names, bounds, severities and message texts.
PRICE_CHECKS = [
    Check("price_row_count", "rows", ">=", 20, True, "%d rows (need >=20 tickers)"),
    Check("price_no_null_close", "null_close", "=", 0, True, "%d null close prices"),
    Check("price_positive_values", "non_positive", "=", 0, True, "%d rows with close_price <= 0"),
    Check("price_pct_change_range", "extreme", "=", 0, False, "%d rows with |pct_change| > 30%%"),
]
RAW_CHECKS = [
    Check("sentiment_row_count", "rows", ">=", 10, True, "%d posts collected (need >=10)"),
    Check("sentiment_no_empty_text", "empty_text", "=", 0, False, "%d records with empty text"),
    Check("sentiment_multiple_sources", "sources", ">=", 1, False, "%d distinct sources"),
    Check("sentiment_ticker_coverage", "tickers", ">=", 5, True, "%d tickers have sentiment data (need >=5)"),
]
SCORED_CHECKS = [
    Check("scored_row_count", "rows", ">=", 5, True, "%d scored records (need >=5)"),
    Check("scored_probability_sum", "sum_error", "<", 0.01, True, "avg probability sum error: %.6f (need <0.01)"),
    Check("scored_compound_range", "out_of_range", "=", 0, True, "%d records with compound_score outside [-1, 1]"),
]
DAILY_CHECKS = [
    Check("daily_agg_row_count", "rows", ">=", 3, True, "%d tickers aggregated (need >=3)"),
    Check("daily_agg_score_range", "out_of_range", "=", 0, True, "%d rows with avg_sentiment outside [-1,1]"),
]
PCT_LIMIT = 30


def run_dates(df: DataFrame, column: str) -> DataFrame:
    """The distinct run dates found in a frame."""
    return df.select(F.col(column).cast("date").alias("run_date")).distinct()


def one_date(df: DataFrame, run_date: str) -> DataFrame:
    return df.sparkSession.range(1).select(F.to_date(F.lit(run_date)).alias("run_date"))


def _outside_unit(c: str) -> Column:
    return (F.col(c) < -1.0) | (F.col(c) > 1.0)


def _price_measures(prices: DataFrame) -> DataFrame:
    return prices.groupBy(F.col("trade_date").alias("run_date")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("close_price").isNull()).alias("null_close"),
        F.count_if(F.col("close_price") <= 0).alias("non_positive"),
        F.count_if(F.abs("pct_change") > PCT_LIMIT).alias("extreme"),
    )


def _raw_measures(raw: DataFrame) -> DataFrame:
    """Two steps: the distinct counts then run over the few (day, source, ticker) groups."""
    empty = F.col("raw_text").isNull() | (F.length("raw_text") < MIN_VALID_TEXT)
    groups = raw.groupBy(F.col("collected_date").cast("date").alias("run_date"), "source", "ticker").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(empty).alias("n_empty")
    )
    return groups.groupBy("run_date").agg(
        F.sum("n").alias("rows"),
        F.sum("n_empty").alias("empty_text"),
        F.count_distinct("source").alias("sources"),
        F.count_distinct("ticker").alias("tickers"),
    )


def _scored_measures(scored: DataFrame) -> DataFrame:
    total = F.col("score_positive") + F.col("score_negative") + F.col("score_neutral")
    return scored.groupBy(F.col("scored_date").alias("run_date")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.abs(total - 1.0)).alias("sum_error"),
        F.count_if(_outside_unit("compound_score")).alias("out_of_range"),
    )


def _daily_measures(daily: DataFrame) -> DataFrame:
    return daily.groupBy(F.col("sentiment_date").alias("run_date")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(_outside_unit("avg_sentiment_score")).alias("out_of_range"),
    )


def _result(check: Check, value: Column) -> Column:
    """The outcome of one check.  A date without rows counts as zero; its mean error is unknown."""
    if check.rule != "<":
        value = F.coalesce(value, F.lit(0.0))
    bound = F.lit(float(check.bound))
    passed = {">=": value >= bound, "=": value == bound, "<": value < bound}[check.rule]
    shown = value if check.rule == "<" else value.cast("bigint")
    message = F.when(value.isNull(), F.lit("no rows")).otherwise(F.format_string(check.message, shown))
    return F.struct(
        F.lit(check.name).alias("name"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        F.lit(check.critical).alias("critical"),
        message.alias("message"),
        value.alias("value"),
    )


def _results(measures: DataFrame, dates: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per run date and check."""
    per_date = dates.join(measures, "run_date", "left")
    return per_date.select("run_date", F.inline(F.array(*[_result(c, F.col(c.measure).cast("double")) for c in checks])))


def found_days_checks(prices: DataFrame, raw: DataFrame, scored: DataFrame | None = None, daily: DataFrame | None = None) -> DataFrame:
    """All checks for every day from the first to the last that prices or raw articles hold, days without rows included.

    The days come from the measured rows, so no table is read a second time for its days.
    """
    parts = {"prices": (_price_measures(prices), PRICE_CHECKS), "raw": (_raw_measures(raw), RAW_CHECKS)}
    if scored is not None:
        parts["scored"] = (_scored_measures(scored), SCORED_CHECKS)
    if daily is not None:
        parts["daily"] = (_daily_measures(daily), DAILY_CHECKS)
    rows = [
        m.select("run_date", F.struct(*[c for c in m.columns if c != "run_date"]).alias(name)) for name, (m, _) in parts.items()
    ]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    # One row a day from here on.
    measured = together.groupBy(F.col("run_date").cast("date").alias("run_date")).agg(
        *[F.first(name, ignorenulls=True).alias(name) for name in parts]
    )
    collected = measured.filter(F.col("prices").isNotNull() | F.col("raw").isNotNull())
    until = F.coalesce(F.date_sub(F.lead("run_date").over(Window.orderBy("run_date")), 1), F.col("run_date"))
    days = collected.withColumn("until", until).withColumn("day", F.explode(F.sequence("run_date", "until")))
    there = F.col("day") == F.col("run_date")  # the others are days between, without rows
    results = [
        _result(c, F.when(there, F.col(f"{name}.{c.measure}")).cast("double")) for name, (_, checks) in parts.items() for c in checks
    ]
    return days.select(F.col("day").alias("run_date"), F.inline(F.array(*results)))


def price_checks(prices: DataFrame, dates: DataFrame) -> DataFrame:
    return _results(_price_measures(prices), dates, PRICE_CHECKS)


def raw_checks(raw: DataFrame, dates: DataFrame) -> DataFrame:
    return _results(_raw_measures(raw), dates, RAW_CHECKS)


def scored_checks(scored: DataFrame, dates: DataFrame) -> DataFrame:
    return _results(_scored_measures(scored), dates, SCORED_CHECKS)


def daily_checks(daily: DataFrame, dates: DataFrame) -> DataFrame:
    return _results(_daily_measures(daily), dates, DAILY_CHECKS)


def collection_checks(prices: DataFrame, raw: DataFrame, dates: DataFrame) -> DataFrame:
    return price_checks(prices, dates).unionByName(raw_checks(raw, dates))


def scoring_checks(scored: DataFrame, daily: DataFrame, dates: DataFrame) -> DataFrame:
    return scored_checks(scored, dates).unionByName(daily_checks(daily, dates))


def all_checks(prices: DataFrame, raw: DataFrame, scored: DataFrame, daily: DataFrame, dates: DataFrame) -> DataFrame:
    return collection_checks(prices, raw, dates).unionByName(scoring_checks(scored, daily, dates))


def report(checks: DataFrame) -> DataFrame:
    """Per run date: checks passed and failed, the critical failures, and the verdict."""
    failed_critical = ~F.col("passed") & F.col("critical")
    names = F.array_sort(F.collect_list(F.when(failed_critical, F.col("name"))))
    return checks.groupBy("run_date").agg(
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.array_join(names, ",").alias("critical_failures"),
        (F.count_if(failed_critical) == 0).alias("pipeline_ok"),
    )


class QualityError(ValueError):
    """A critical check failed."""


def require(checks: DataFrame) -> list:
    """Fetch the few check rows of a run and stop it on a critical failure."""
    rows = checks.collect()
    failures = sorted(f"{r['run_date']} {r['name']}: {r['message']}" for r in rows if r["critical"] and not r["passed"])
    if failures:
        raise QualityError("critical data-quality failures: " + "; ".join(failures))
    return rows


def publish_gate(correlations: DataFrame) -> DataFrame:
    """Rows too thin to publish, and whether publishing is blocked.  An error stays an error."""
    thin = F.count_if(F.col("sample_size") < MIN_SAMPLE)
    return correlations.agg(thin.alias("stale_rows"), (thin == 0).alias("may_publish"))


def row_probe(df: DataFrame) -> DataFrame:
    """How many rows a dimension holds; zero means it was never set up."""
    return df.agg(F.count(F.lit(1)).alias("n"))
