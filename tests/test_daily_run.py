"""Landed files of every kind, the daily job over them, and the backfill."""

import datetime as dt
import json

import pytest

from moodtape.operators import articles, correlation, quality
from moodtape.plans import daily_run
from moodtape.schemas import TABLES
from moodtape.sources import landing
from moodtape.sources.tables import Tables
from moodtape.dimensions import seed_keywords
from pyspark.sql import functions as F

NOW = dt.datetime(2026, 3, 1, 12, 0, 0)
RUN = "2026-02-20"
TICKERS = [r for r in ("RELIANCE TCS INFY WIPRO NTPC SBIN MARUTI ONGC TECHM HCLTECH HDFCBANK ICICIBANK KOTAKBANK AXISBANK "
                       "TMCV HYUNDAI BAJAJ-AUTO M&M SUNPHARMA GOLDBEES SILVERBEES BANKBEES").split()]


def item(title, summary="", link="", guid=None, date="Fri, 20 Feb 2026 09:00:00 +0530", author=None, source=None):
    parts = [f"<title>{title}</title>", f"<description>{summary}</description>", f"<link>{link}</link>", f"<pubDate>{date}</pubDate>"]
    if guid:
        parts.append(f"<guid>{guid}</guid>")
    if author:
        parts.append(f"<author>{author}</author>")
    if source:
        parts.append(f'<source url="http://s">{source}</source>')
    return "<item>" + "".join(parts) + "</item>"


def feed(path, title, items):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(
        f'<?xml version="1.0"?><rss><channel><title>{title}</title>{"".join(items)}</channel></rss>', encoding="utf-8"
    )


def test_bar_files_by_name_and_column_order(spark, tmp_path):
    (tmp_path / "M&M_2026-02-20.csv").write_text("Date,Close,High,Low,Open,Volume\n2026-02-19,2.0,3.0,1.0,1.5,10\n2026-02-20,2.5,3.0,1.0,1.5,\n")
    (tmp_path / "BAJAJ-AUTO_2026-02-20.csv").write_text("Date,Close,High,Low,Open,Volume\n2026-02-19,7.0,8.0,6.0,6.5,3.0\n")
    got = landing.read_bar_files(spark, str(tmp_path)).orderBy("ticker", "date").collect()
    assert [(r["ticker"], r["date"].day, r["open"], r["close"], r["volume"], r["adj_close"]) for r in got] == [
        ("BAJAJ-AUTO", 19, 6.5, 7.0, 3, None), ("M&M", 19, 1.5, 2.0, 10, None), ("M&M", 20, 1.5, 2.5, None, None),
    ]
    assert {str(r["run_date"]) for r in got} == {"2026-02-20"}


def test_two_level_columns_are_flattened(spark):
    df = spark.sql("select named_struct('X.NS', 1.0D) AS `Adj Close`, date'2026-01-01' AS Date")
    flat = landing.snake_names(df)
    assert flat.columns == ["adj_close", "date"] and flat.first()["adj_close"] == 1.0


def test_feed_records(spark, tmp_path):
    feed(tmp_path / "a.xml", "Feed A", [
        item("Tata gains &amp; Reliance falls", "&lt;p&gt;big &lt;b&gt;day&lt;/b&gt;&lt;/p&gt;", "http://x/1", "id1"),
        item("Infosys results beat estimates", link="http://x/2", author="Ann", date="nonsense"),
        item("Jio short", "x"),
        item("Nothing about anybody in here at all", link="http://x/3"),
    ])
    feed(tmp_path / "b.xml", "Feed B", [item("Tata again, other text here", link="http://y/1", guid="id1")])
    items = landing.read_feed_items(spark, str(tmp_path))
    got = articles.feed_records(items, seed_keywords(spark), F.lit(RUN), F.lit(NOW)).collect()
    by_id = {r["source_id"]: r for r in got}
    assert set(by_id) == {"id1_TCS", "id1_TMCV", "id1_RELIANCE", "http://x/2_INFY"}
    first = by_id["id1_TCS"]
    assert first["raw_text"] == "Tata gains & Reliance falls big day"  # feed a comes first
    assert first["author"] == "Feed A" and by_id["http://x/2_INFY"]["author"] == "Ann"
    assert first["published_at"] == dt.datetime(2026, 2, 20, 9) and by_id["http://x/2_INFY"]["published_at"] == NOW
    assert first["source"] == "news" and first["upvotes"] == 0 and str(first["collected_date"]) == RUN


def test_ticker_feed_records(spark, tmp_path):
    feed(tmp_path / "ticker=M%26M" / "f.xml", "q", [
        item("Mahindra sells more cars", link="http://g/1", source="The Paper"), item("fourteen chars", link="l"), item("fifteen chars!!", link="m"),
    ])
    got = articles.ticker_feed_records(landing.read_ticker_feed_items(spark, str(tmp_path)), F.lit(RUN), F.lit(NOW)).collect()
    assert {(r["source_id"], r["author"]) for r in got} == {("http://g/1_M&M", "The Paper"), ("m_M&M", "Google News")}


def test_json_records(spark, tmp_path):
    folder = tmp_path / "ticker=TCS"
    folder.mkdir()
    found = [
        {"id": "1", "content": {"title": "TCS wins a deal", "summary": "", "description": "a large one", "pubDate": "2026-02-20T10:20:30Z",
                                "provider": {"displayName": "Wire"}, "canonicalUrl": {"url": "http://u/1"}}},
        {"title": "Flat article shape", "summary": "text", "pubDate": "junk", "provider": "Plain", "canonicalUrl": "http://u/2"},
        {"id": "3", "content": {"title": "No provider at all", "provider": {}}},
        {"id": "1", "content": {"title": "Repeats the first id", "summary": "later"}},
        {"id": "5", "content": {"title": "short"}},
    ]
    (folder / "a.json").write_text(json.dumps(found))
    got = articles.json_records(landing.read_json_articles(spark, str(tmp_path), multi_line=True), F.lit(RUN), F.lit(NOW)).collect()
    by_id = {r["source_id"]: r for r in got}
    assert set(by_id) == {"1_TCS", "http://u/2_TCS", "3_TCS"}
    assert by_id["1_TCS"]["raw_text"] == "TCS wins a deal a large one" and by_id["1_TCS"]["author"] == "Wire"
    assert by_id["1_TCS"]["published_at"] == dt.datetime(2026, 2, 20, 10, 20, 30) and by_id["1_TCS"]["url"] == "http://u/1"
    flat = by_id["http://u/2_TCS"]
    assert flat["author"] == "Yahoo Finance" and flat["url"] == "http://u/2" and flat["published_at"] == NOW
    assert by_id["3_TCS"]["author"] == "Yahoo Finance" and by_id["3_TCS"]["url"] == ""


def test_landed_records_round_trip(spark, tmp_path):
    row = [("news", "1", "A", NOW, dt.date(2026, 2, 20), "text", None, 0, "u")]
    df = spark.createDataFrame(row, "source string, source_id string, ticker string, published_at timestamp, collected_date date, raw_text string, author string, upvotes int, url string")
    landing.write_article_records(df, str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out")).first()
    assert back["source_id"] == "1" and back["author"] is None and str(back["run_date"]) == "2026-02-20"


def land_everything(root, run_date, n_tickers=22):
    day = dt.date.fromisoformat(run_date)
    bars = root / "bars" / f"run_date={run_date}"
    bars.mkdir(parents=True)
    for k, t in enumerate(TICKERS[:n_tickers]):
        lines = ["date,open,high,low,close,volume"]
        for i in range(4, -1, -1):
            d = day - dt.timedelta(days=i)
            p = 100 + k + (d.toordinal() * (k + 3)) % 7
            lines.append(f"{d},{p},{p + 2},{p - 1},{p + 1},{1000 + i}")
        (bars / f"{t}_{run_date}.csv").write_text("\n".join(lines) + "\n")
    words = ["profits surge", "shares fall", "steady quarter", "record growth", "heavy losses"]
    feed(root / "feeds" / f"run_date={run_date}" / "f.xml", "Feed", [
        item(f"{name} {words[(i + day.day) % 5]} on {run_date}", link=f"http://f/{run_date}/{i}")
        for i, name in enumerate(["Tata", "Infosys", "Reliance", "WIPRO", "NTPC", "SBI"])
    ])
    for i, t in enumerate(("TCS", "INFY", "RELIANCE", "WIPRO", "NTPC", "SBIN")):
        feed(root / "ticker_feeds" / f"run_date={run_date}" / f"ticker={t}" / "f.xml", "q",
             [item(f"{t} {words[(i * 2 + day.day) % 5]} {run_date}", link=f"http://t/{run_date}/{i}")])
        folder = root / "json" / f"run_date={run_date}" / f"ticker={t}"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text(json.dumps({"id": f"{run_date}{t}", "content": {"title": f"{t} {words[(i + day.day * 2) % 5]} again"}}))
    return daily_run.Landing(str(root / "bars"), str(root / "feeds"), str(root / "ticker_feeds"), str(root / "json"))


def content(tables, name):
    stamps = {"ingested_at", "scored_at", "computed_at", "added_at", "published_at"}
    cols = [c for c in TABLES[name].schema.names if c not in stamps]
    return sorted((tuple(r) for r in tables.read(name).select(*cols).collect()), key=repr)


def test_daily_job_and_backfill(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "tables")).create()
    place = None
    days = [f"2026-02-{d:02d}" for d in range(16, 19)]
    for d in days:
        place = land_everything(tmp_path / "landing", d)
        out = daily_run.run_daily(tables, place, d, ingest_ts=NOW)
    totals = {r["measure"]: r["total"] for r in out["totals"].collect()}
    assert totals["price rows"] == 22 and totals["articles news"] == 7
    assert totals["articles google_news"] == totals["articles yahoo_finance"] == 6 and totals["scored articles"] == 19
    assert totals["correlated tickers"] == 0 and out["findings"].count() == 0  # three days are too few
    before = {n: content(tables, n) for n in TABLES}

    # A second run of the same day changes nothing.
    daily_run.run_daily(tables, place, days[-1], ingest_ts=NOW)
    assert {n: content(tables, n) for n in TABLES} == before

    # The set-based backfill over the same collected rows gives the same tables.
    again = Tables(spark, str(tmp_path / "again")).create()
    again.append("price_daily", tables.read("price_daily"))
    again.append("raw_sentiment", tables.read("raw_sentiment"))
    done = daily_run.backfill(again, days[0], days[-1])
    assert done["scored"] == len(before["sentiment_scored"])
    assert {n: content(again, n) for n in TABLES} == before

    # So does the backfill that collects the landed files itself; a day without files is reported.
    landed = Tables(spark, str(tmp_path / "landed")).create()
    done = daily_run.backfill(landed, days[0], "2026-02-19", place, NOW)
    assert done["left_out"] == ["2026-02-19"]
    assert {n: content(landed, n) for n in TABLES} == before


def test_backfill_correlations_equal_daily_ones(spark, sf, tmp_path):
    from moodtape.sources import star

    tables = Tables(spark, str(tmp_path / "t")).create("daily_sentiment", "price_daily", "sentiment_price_correlation")
    tables.append("daily_sentiment", star.daily(spark, sf))
    tables.append("price_daily", star.prices(spark, sf))
    for d in ("2024-01-24", "2024-01-26", "2024-01-30"):
        daily_run.correlate(tables, d, 25)
    loop = {(r["ticker"], r["analysis_date"]): tuple(r)[2:12] for r in tables.read("sentiment_price_correlation").collect()}
    filled = correlation.optimal_lag(
        correlation.backfill_correlation(tables.read("daily_sentiment"), tables.read("price_daily"), "2024-01-24", "2024-01-30", 25)
    ).select(*tables.read("sentiment_price_correlation").columns[:-1])
    job = {(r["ticker"], r["analysis_date"]): tuple(r)[2:] for r in filled.collect()}
    assert loop and {k: v for k, v in job.items() if k[1].day in (24, 26, 30)} == loop


def test_holiday_is_skipped(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    assert daily_run.run_daily(tables, daily_run.Landing(), "2026-12-25") is None


def test_too_few_prices_stop_the_run(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "tables")).create()
    place = land_everything(tmp_path / "landing", RUN, n_tickers=19)
    with pytest.raises(quality.QualityError, match="price_row_count"):
        daily_run.run_daily(tables, place, RUN, ingest_ts=NOW)
    assert tables.read("sentiment_scored").count() == 0


def test_kinds_are_collected_each_for_itself(spark, tmp_path):
    import dataclasses
    import shutil

    place = None
    for d in ("2026-02-17", "2026-02-18"):
        place = land_everything(tmp_path / "landing", d)
    place = dataclasses.replace(place, records=str(tmp_path / "records"))
    shutil.rmtree(f"{place.json_articles}/run_date=2026-02-18")
    tables = Tables(spark, str(tmp_path / "tables")).create()
    done = daily_run.backfill(tables, "2026-02-17", "2026-02-19", place, NOW)
    assert done["not_landed"] == {"2026-02-18": ["json_articles"], "2026-02-19": ["bars", "feeds", "ticker_feeds", "json_articles"]}
    assert done["left_out"] == ["2026-02-19"]
    kinds = tables.read("raw_sentiment").groupBy("collected_date", "source").count().collect()
    assert {(r["collected_date"].day, r["source"]) for r in kinds} == {(17, "news"), (17, "google_news"), (17, "yahoo_finance"), (18, "news"), (18, "google_news")}
    assert tables.read("price_daily").select("trade_date").distinct().count() >= 2
    landed = spark.read.json(place.records)
    assert landed.count() == tables.read("raw_sentiment").count()
    assert set(articles.RECORD) <= set(landed.columns)


def test_unknown_tickers_are_refused(spark, sf):
    from moodtape.plans import views
    from moodtape.sources import star

    daily_rows, tickers = star.daily(spark, sf), star.tickers(spark, sf)
    known = views.sentiment_history(daily_rows, "2024-01-30", ticker="nation_3", tickers=tickers)
    assert {r["ticker"] for r in known.collect()} == {"NATION_3"}
    prices, none = star.prices(spark, sf), spark.createDataFrame([], TABLES["sentiment_price_correlation"].schema)
    for served in (
        lambda: views.sentiment_history(daily_rows, "2024-01-30", ticker="XX", tickers=tickers),
        lambda: views.latest_sentiment(daily_rows, "XX", tickers),
        lambda: views.price_history(prices, "2024-01-30", ticker="XX", tickers=tickers),
        lambda: views.latest_correlation(none, tickers, "XX"),
    ):
        with pytest.raises(views.UnknownTickerError, match="XX"):
            served()
