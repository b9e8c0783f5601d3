"""The daily job and its backfill over a range of days."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtape.dimensions import HOLIDAYS, keywords_or_ticker, seed_keywords, trading_rows
from moodtape.operators import articles, bars, correlation, daily, quality, scoring
from moodtape.plans import views
from moodtape.sources import landing
from moodtape.sources.files import Files
from moodtape.sources.tables import Tables


log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Landing:
    """Where the files of each kind land; a missing path means none are expected.

    Below a path there is one folder per run date, ``run_date=YYYY-MM-DD``.  Under
    ``records`` the collected article records are landed in turn, as JSON.
    """

    bars: str | None = None
    feeds: str | None = None
    ticker_feeds: str | None = None
    json_articles: str | None = None
    json_multi_line: bool = False  # whether JSON articles are arrays over several lines
    records: str | None = None


#: The kinds of files a run collects, each for itself.
KINDS = ("bars", "feeds", "ticker_feeds", "json_articles")


def _of(path: str, run_date: str) -> str:
    return f"{path.rstrip('/')}/run_date={run_date}"


def _on(df: DataFrame, column: str, run_date: str) -> DataFrame:
    return df.filter(F.col(column) == F.to_date(F.lit(run_date)))


def collect_prices(tables: Tables, place: Landing, run_date: str, lookback_days: int = 1) -> int:
    # Only the run's own folder is read, so an odd file of another run can't break this one.
    landed = landing.read_bar_files(tables.spark, _of(place.bars, run_date), place.bars)
    return tables.insert("price_daily", bars.collect_prices(landed, run_date, lookback_days))


def article_records(
    tables: Tables, place: Landing, run_date: str, ingest_ts: dt.datetime, keywords: DataFrame | None = None
) -> DataFrame:
    """Records of all three kinds of landed articles in one frame."""
    spark = tables.spark
    day, now = F.to_date(F.lit(run_date)), F.lit(ingest_ts).cast("timestamp")
    frames = []
    if place.feeds:
        known = keywords_or_ticker(tables.read("tickers"), keywords if keywords is not None else seed_keywords(spark))
        items = landing.read_feed_items(spark, _of(place.feeds, run_date))
        frames.append(articles.feed_records(items, known, day, now))
    if place.ticker_feeds:
        items = landing.read_ticker_feed_items(spark, _of(place.ticker_feeds, run_date))
        frames.append(articles.ticker_feed_records(items, day, now))
    if place.json_articles:
        found = landing.read_json_articles(spark, _of(place.json_articles, run_date), place.json_multi_line)
        frames.append(articles.json_records(found, day, now))
    if not frames:
        raise ValueError("no article landing folder given")
    records = frames[0]
    for more in frames[1:]:
        records = records.unionByName(more)
    return records


def collect_articles(tables: Tables, place: Landing, run_date: str, ingest_ts: dt.datetime, **kw) -> int:
    records = article_records(tables, place, run_date, ingest_ts, **kw)
    if place.records:
        landing.write_article_records(records, place.records, run_date)
    return tables.insert("raw_sentiment", records)


def landed_kinds(tables: Tables, place: Landing, run_date: str) -> tuple[Landing, list[str]]:
    """The places that have a folder for the day, and the kinds that are expected but have none."""
    files = Files(tables.spark)
    missing = [k for k in KINDS if getattr(place, k) and not files.exists(_of(getattr(place, k), run_date))]
    return replace(place, **dict.fromkeys(missing)), missing


def collect(tables: Tables, place: Landing, run_date: str, ingest_ts: dt.datetime, lookback_days: int = 1) -> list[str]:
    """Collect every kind of file that landed; the kinds that did not.  Whether the rest will do is for the checks to say."""
    there, missing = landed_kinds(tables, place, run_date)
    if there.bars:
        collect_prices(tables, there, run_date, lookback_days)
    if there.feeds or there.ticker_feeds or there.json_articles:
        collect_articles(tables, there, run_date, ingest_ts)
    if missing:
        log.warning("nothing landed on %s of: %s", run_date, ", ".join(missing))
    return missing


def score(tables: Tables, run_date: str, load_scorer: Callable[[], scoring.Scorer] | None = None) -> int:
    """Score what the day collected and roll the day up."""
    # An article is scored under the date it was collected on, so one day of each table is enough.
    failed = tables.spark.sparkContext.accumulator(0)
    fresh = scoring.score_articles(
        tables.read("raw_sentiment"),
        _on(tables.read("sentiment_scored"), "scored_date", run_date),
        run_date,
        load_scorer,
        failed=failed,
    )
    n = tables.append("sentiment_scored", fresh)
    if failed.value:
        log.warning("%d texts of %s could not be scored and stay unscored", failed.value, run_date)
    rows = daily.daily_sentiment(_on(tables.read("sentiment_scored"), "scored_date", run_date))
    tables.replace("daily_sentiment", rows, ["ticker", "sentiment_date"])
    return n


def correlate(tables: Tables, run_date: str, lookback_days: int = correlation.LOOKBACK_DAYS) -> int:
    rows = correlation.correlation_rows(
        tables.read("daily_sentiment"), tables.read("price_daily"), run_date, lookback_days
    )
    return tables.replace("sentiment_price_correlation", rows, ["ticker", "analysis_date"])


def collection_gate(tables: Tables, run_date: str) -> list:
    checks = quality.collection_checks(
        _on(tables.read("price_daily"), "trade_date", run_date),
        _on(tables.read("raw_sentiment"), "collected_date", run_date),
        quality.one_date(tables.read("tickers"), run_date),
    )
    return quality.require(checks)


def scoring_gate(tables: Tables, run_date: str) -> list:
    checks = quality.scoring_checks(
        _on(tables.read("sentiment_scored"), "scored_date", run_date),
        _on(tables.read("daily_sentiment"), "sentiment_date", run_date),
        quality.one_date(tables.read("tickers"), run_date),
    )
    return quality.require(checks)


def run_daily(
    tables: Tables,
    place: Landing,
    run_date: str | None = None,
    lookback_days: int = 1,
    ingest_ts: dt.datetime | None = None,
    load_scorer: Callable[[], scoring.Scorer] | None = None,
    holidays: Sequence[str] = HOLIDAYS,
) -> dict | None:
    """Collect, check, score, check, correlate.  Yesterday unless a date is given.

    Returns the run's totals and strongest findings as frames, or None on a
    market holiday.  A failed critical check raises and stops the run.
    """
    run_date = run_date or (dt.date.today() - dt.timedelta(days=1)).isoformat()
    if run_date in holidays:
        return None
    ingest_ts = ingest_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    collect(tables, place, run_date, ingest_ts, lookback_days)
    collection_gate(tables, run_date)
    score(tables, run_date, load_scorer)
    scoring_gate(tables, run_date)
    correlate(tables, run_date)
    tables.register()
    correlations = tables.read("sentiment_price_correlation")
    return {
        "totals": views.run_totals(
            tables.read("price_daily"), tables.read("raw_sentiment"), tables.read("sentiment_scored"), correlations, run_date
        ),
        "findings": views.top_findings(correlations, run_date),
    }


def backfill(
    tables: Tables,
    start: str,
    end: str,
    place: Landing | None = None,
    ingest_ts: dt.datetime | None = None,
    collect_lookback_days: int = 1,
    load_scorer: Callable[[], scoring.Scorer] | None = None,
    lookback_days: int = correlation.LOOKBACK_DAYS,
    holidays: Sequence[str] = HOLIDAYS,
) -> dict:
    """Collect, score, roll up and correlate every day of a range, each step after collection as one job.

    With ``place`` the files that landed on the trading days of the range are
    collected first, day by day and kind by kind, as inserts of a day read that
    day's folders only; without it the prices and articles already stored are
    taken.  A day that fails a critical check is left out from then on and the
    others go on, as each day stands for itself.  The days left out are in the
    result, as are the kinds of files that had not landed on a day; why a day was
    left out is in ``quality.report``.
    """
    first, last = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    not_landed: dict[str, list[str]] = {}
    if place is not None:
        ingest_ts = ingest_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        day, until = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
        while day <= until:
            run_date = day.isoformat()
            if day.weekday() < 5 and run_date not in holidays:
                missing = collect(tables, place, run_date, ingest_ts, collect_lookback_days)
                if missing:
                    not_landed[run_date] = missing
            day += dt.timedelta(days=1)

    def in_range(name: str, column: str) -> DataFrame:
        return tables.read(name).filter(F.col(column).between(first, last))

    every_day = tables.spark.range(1).select(F.explode(F.sequence(first, last)).alias("run_date"))
    calendar = trading_rows(every_day, "run_date", list(holidays))

    def good(checks: DataFrame) -> list[dt.date]:
        """The days that pass, one small row each; as literals they prune the scans that follow."""
        return [r["run_date"] for r in quality.report(checks).filter("pipeline_ok").collect()]

    collected = good(
        quality.collection_checks(
            in_range("price_daily", "trade_date"), in_range("raw_sentiment", "collected_date"), calendar
        )
    )
    raw = tables.read("raw_sentiment").filter(F.col("collected_date").isin(collected))
    scored = tables.append(
        "sentiment_scored", scoring.score_articles(raw, in_range("sentiment_scored", "scored_date"), None, load_scorer)
    )
    rolled = tables.replace(
        "daily_sentiment",
        daily.daily_sentiment(in_range("sentiment_scored", "scored_date")),
        ["ticker", "sentiment_date"],
    )
    passed = good(
        quality.all_checks(
            in_range("price_daily", "trade_date"),
            in_range("raw_sentiment", "collected_date"),
            in_range("sentiment_scored", "scored_date"),
            in_range("daily_sentiment", "sentiment_date"),
            calendar,
        )
    )
    found = correlation.optimal_lag(
        correlation.backfill_correlation(
            tables.read("daily_sentiment"), tables.read("price_daily"), start, end, lookback_days
        )
    ).filter(F.col("analysis_date").isin(passed))
    correlated = tables.replace("sentiment_price_correlation", found, ["ticker", "analysis_date"])
    left_out = sorted(r["run_date"].isoformat() for r in calendar.collect() if r["run_date"] not in set(passed))
    return {"scored": scored, "aggregated": rolled, "correlated": correlated, "left_out": left_out, "not_landed": not_landed}
