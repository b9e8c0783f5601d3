"""The registered queries: each operator run over the star-schema tables."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtape.dimensions import keywords_or_ticker, tracked, trading_rows, vendor_symbol
from moodtape.functions.numeric import round_half_up
from moodtape.functions.text import WORD, clean_html, clean_text, clean_text_rows
from moodtape.operators import articles, bars, correlation, daily, dedup, matching, quality, scoring
from moodtape.plans import views
from moodtape.session import shuffles_dropped, work_path
from moodtape.sources import landing, star
from moodtape.sources.tables import Tables
from moodtape.streaming import articles as streams

AS_OF = "2024-01-30"
SPLIT_DAY = "2024-01-15"
BACKFILL_START, BACKFILL_LOOKBACK = "2024-01-08", 20
TABLE_START = "2024-01-24"
TICKER = "NATION_7"
SECTOR = "ASIA"

# Words that occur in the documents, so that the scorer has something to count.
DOCUMENT_LEXICON = scoring.Lexicon(
    positive={"that": 1.0, "with": 1.0, "avec": 1.0, "mit": 1.0, "pour": 2.0, "para": 2.0},
    negative={"was": 1.0, "are": 1.0, "pas": 1.0, "nicht": 2.0, "no": 2.0},
)


def _correlations(spark: SparkSession, d: str) -> DataFrame:
    """A correlation table of several analysis dates."""
    found = correlation.backfill_correlation(star.daily(spark, d), star.prices(spark, d), TABLE_START, AS_OF)
    return correlation.optimal_lag(found)


def _sectors(spark: SparkSession, d: str) -> DataFrame:
    return views.sector_sentiment(star.daily(spark, d), star.prices(spark, d), star.tickers(spark, d))


def _days_of(*tables: tuple[DataFrame, str]) -> DataFrame:
    """Every day from the first to the last one that any of the tables holds, days without rows included."""
    days = reduce(DataFrame.union, [quality.run_dates(df, column) for df, column in tables])
    return days.agg(F.explode(F.sequence(F.min("run_date"), F.max("run_date"))).alias("run_date"))


def _stable(df: DataFrame, *columns: str) -> DataFrame:
    """Means of unrounded means differ in the last bits with the summing order; show ten decimals."""
    return df.withColumns({c: round_half_up(c, 10) for c in columns})


# --- prices, scores, correlation -------------------------------------------------


def price_bars(spark, d):
    return star.prices(spark, d)


def price_files(spark, d):
    """Bars landed as CSV files and read back."""
    path = work_path(spark, "bars")
    landing.write_bar_files(star.bars(spark, d).withColumn("run_date", F.to_date(F.lit(AS_OF))), path)
    return bars.price_rows(landing.read_bar_files(spark, path), ("ticker", "run_date")).drop("run_date")


def price_collection(spark, d):
    """The rows one run contributes, with the symbol the vendor knows the ticker by."""
    rows = bars.collect_prices(star.bars(spark, d), AS_OF, 14)
    return rows.select(vendor_symbol().alias("symbol"), "ticker", "trade_date", "close_price", "pct_change")


def sentiment_daily(spark, d):
    return star.daily(spark, d)


def sentiment_daily_joined(spark, d):
    """The roll-up for a scored table that has to fetch source and upvotes by id."""
    scored = star.scored_articles(spark, d).drop("source", "upvotes")
    return daily.daily_sentiment(scored, star.raw_articles(spark, d))


def weighted_sentiment(spark, d):
    return star.daily(spark, d).select("ticker", "sentiment_date", "engagement_weighted_score")


def lag_correlation(spark, d):
    return correlation.lag_correlation(star.daily(spark, d), star.prices(spark, d), AS_OF)


def optimal_lag(spark, d):
    return correlation.correlation_rows(star.daily(spark, d), star.prices(spark, d), AS_OF)


def largest_samples(spark, d):
    return correlation.largest_samples(optimal_lag(spark, d)).select("ticker", "optimal_lag_days", "sample_size")


def backfill_correlation(spark, d):
    found = correlation.backfill_correlation(
        star.daily(spark, d), star.prices(spark, d), BACKFILL_START, AS_OF, BACKFILL_LOOKBACK
    )
    return correlation.optimal_lag(found)


# --- views and served queries ------------------------------------------------------


def sentiment_price_view(spark, d):
    return views.sentiment_price(star.daily(spark, d), star.prices(spark, d))


def latest_correlations(spark, d):
    return views.latest_correlations(_correlations(spark, d), star.tickers(spark, d))


def sector_sentiment(spark, d):
    return _stable(_sectors(spark, d), "avg_sector_sentiment", "avg_sector_return")


def sector_overview(spark, d):
    return _stable(views.sector_overview(_sectors(spark, d), AS_OF), "avg_sentiment", "avg_return")


def active_tickers(spark, d):
    return views.active_tickers(star.tickers(spark, d))


def sentiment_history(spark, d):
    return views.sentiment_history(star.daily(spark, d), AS_OF)


def sentiment_history_ticker(spark, d):
    return views.sentiment_history(star.daily(spark, d), AS_OF, ticker=TICKER.lower(), tickers=star.tickers(spark, d))


def latest_sentiment(spark, d):
    return views.latest_sentiment(star.daily(spark, d))


def price_history(spark, d):
    return views.price_history(star.prices(spark, d), AS_OF)


def latest_correlation(spark, d):
    return views.latest_correlation(_correlations(spark, d), star.tickers(spark, d))


def top_correlations(spark, d):
    return views.top_correlations(_correlations(spark, d), star.tickers(spark, d), 10)


def sector_history(spark, d):
    return _stable(views.sector_history(_sectors(spark, d), AS_OF), "avg_sector_sentiment", "avg_sector_return")


def sector_history_sector(spark, d):
    rows = views.sector_history(_sectors(spark, d), AS_OF, sector=SECTOR)
    return _stable(rows, "avg_sector_sentiment", "avg_sector_return")


def sentiment_price_series(spark, d):
    return views.sentiment_price_series(star.daily(spark, d), star.prices(spark, d), AS_OF)


def freshness(spark, d):
    return views.freshness(star.prices(spark, d), star.daily(spark, d), _correlations(spark, d))


def period_summary(spark, d):
    rows = views.period_summary(star.daily(spark, d), star.prices(spark, d), _correlations(spark, d), AS_OF)
    return _stable(rows, "avg_sentiment", "avg_daily_return")


def run_summary(spark, d):
    return views.run_totals(
        star.prices(spark, d), star.raw_articles(spark, d), star.scored_articles(spark, d), optimal_lag(spark, d), AS_OF
    )


def run_findings(spark, d):
    return views.top_findings(optimal_lag(spark, d), AS_OF)


def tracked_sentiment(spark, d):
    """Rows of tracked tickers only, codes in any case."""
    rows = star.scored_articles(spark, d).select("raw_id", F.lower("ticker").alias("ticker"), "compound_score")
    return tracked(rows, star.tickers(spark, d))


def holiday_filter(spark, d):
    return trading_rows(star.prices(spark, d), "trade_date", star.HOLIDAYS).select("ticker", "trade_date", "close_price")


def mention_counts_zero_filled(spark, d):
    docs = matching.with_tickers(star.documents(spark, d), star.keywords(spark))
    return daily.counts_by_ticker(docs, star.tickers(spark, d))


def busiest_tickers(spark, d):
    return daily.busiest(mention_counts_zero_filled(spark, d))


def source_totals(spark, d):
    return daily.counts_by_source(star.raw_articles(spark, d), ["collected_date"])


# --- quality -------------------------------------------------------------------------


def quality_collection(spark, d):
    return quality.found_days_checks(star.prices(spark, d), star.raw_articles(spark, d))


def quality_scoring(spark, d):
    prices, raw = star.prices(spark, d), star.raw_articles(spark, d)
    days = _days_of((prices, "trade_date"), (raw, "collected_date"))
    rows = quality.scoring_checks(star.scored_articles(spark, d), star.daily(spark, d), days)
    return _stable(rows, "value")


def quality_report(spark, d):
    tables = [star.prices(spark, d), star.raw_articles(spark, d), star.scored_articles(spark, d), star.daily(spark, d)]
    return quality.report(quality.found_days_checks(*tables))


def publish_gate(spark, d):
    return quality.publish_gate(_correlations(spark, d))


def dimension_probe(spark, d):
    return quality.row_probe(star.tickers(spark, d))


# --- dedup and upserts -----------------------------------------------------------------

_RAW_COLUMNS = ["source", "source_id", "ticker", "collected_date", "raw_text", "author", "upvotes"]


def dedup_first(spark, d):
    return dedup.first_by_unique(star.raw_articles(spark, d), ["source", "source_id", "ticker"], "id")


def unscored(spark, d):
    """What is left to score when scoring got as far as the middle of the month."""
    done = star.scored_articles(spark, d).filter(F.col("scored_date") <= F.to_date(F.lit(SPLIT_DAY)))
    return scoring.unscored(star.raw_articles(spark, d), done).select("id", "ticker", "raw_text", "source", "upvotes")


def _ranked_raw(spark, d) -> DataFrame:
    return star.raw_articles(spark, d).withColumnRenamed("id", "event_id").withColumn("url", F.col("event_id").cast("string"))


def upsert_ignore(spark, d):
    """Half a month stored, then the whole month inserted over it, duplicates and all."""
    tables = Tables(spark, work_path(spark, "ignore")).create("raw_sentiment")
    rows = _ranked_raw(spark, d)
    first = [F.col("url").cast("bigint")]
    tables.insert("raw_sentiment", rows.filter(F.col("collected_date") <= F.to_date(F.lit(SPLIT_DAY))), first)
    tables.insert("raw_sentiment", rows, first)
    return tables.read("raw_sentiment").select(*_RAW_COLUMNS, "url")


def upsert_replace(spark, d):
    """Daily sentiment stored, then the second half recomputed from one source and replaced."""
    tables = Tables(spark, work_path(spark, "replace")).create("daily_sentiment")
    tables.append("daily_sentiment", star.daily(spark, d))
    late = star.scored_articles(spark, d).filter(
        (F.col("scored_date") > F.to_date(F.lit(SPLIT_DAY))) & (F.col("source") == "news")
    )
    tables.replace("daily_sentiment", daily.daily_sentiment(late), ["ticker", "sentiment_date"])
    return tables.read("daily_sentiment").drop("computed_at")


def article_ids(spark, d):
    """The ids that stored articles get: digests of their keys."""
    tables = Tables(spark, work_path(spark, "ids")).create("raw_sentiment")
    tables.insert("raw_sentiment", _ranked_raw(spark, d), [F.col("url").cast("bigint")])
    return tables.read("raw_sentiment").select("id", "source", "source_id", "ticker")


def stored_defaults(spark, d):
    """What tables fill in where a written frame lacks a column or holds NULL in it."""
    tables = Tables(spark, work_path(spark, "defaults")).create("raw_sentiment", "daily_sentiment")
    tables.append("raw_sentiment", star.raw_articles(spark, d).drop("id", "upvotes", "author"))
    nullified = star.daily(spark, d).withColumn("news_mentions", F.nullif("news_mentions", "total_mentions"))
    tables.append("daily_sentiment", nullified.drop("yahoo_finance_mentions"))
    raw = tables.read("raw_sentiment").groupBy("ticker", F.col("collected_date").alias("day")).agg(
        F.sum("upvotes").alias("upvotes"), F.count("author").alias("authors"), F.count("ingested_at").alias("stamped")
    )
    rolled = tables.read("daily_sentiment").select(
        "ticker", F.col("sentiment_date").alias("day"), "news_mentions", "yahoo_finance_mentions"
    )
    return raw.join(rolled, ["ticker", "day"])


def collected_articles(spark, d):
    """What one run collects from all three kinds of articles, in one frame."""
    return feed_news(spark, d).unionByName(feed_xml(spark, d)).unionByName(article_json(spark, d))


def sql_scan(spark, d):
    """A parametrised SQL query over the stored tables and views."""
    tables = Tables(spark, work_path(spark, "scan")).create()
    tables.append("daily_sentiment", star.daily(spark, d))
    tables.append("price_daily", star.prices(spark, d))
    sql = """SELECT ticker, date, avg_sentiment_score, next_day_return FROM vw_sentiment_price
             WHERE date >= CAST(? AS DATE) AND total_mentions >= ? ORDER BY ticker, date"""
    return tables.query(sql, ["2024-01-10", 3])


# --- texts -------------------------------------------------------------------------------


def keyword_match(spark, d):
    return matching.with_tickers(star.documents(spark, d), star.keywords(spark)).select(F.col("id").alias("doc_id"), "ticker")


def keyword_match_large(spark, d):
    """A dictionary of all long words of the documents, thousands of them, by the same plan."""
    docs = star.documents(spark, d)
    word = F.explode(F.regexp_extract_all(F.upper("raw_text"), F.lit(rf"([{WORD}]+)"), 1))
    words = docs.select(word.alias("keyword")).filter(F.length("keyword") >= 9).distinct()
    dictionary = words.select(F.concat(F.lit("W"), F.substring("keyword", 1, 2)).alias("ticker"), "keyword")
    return matching.with_tickers(docs, dictionary).select(F.col("id").alias("doc_id"), "ticker")


def keyword_defaults(spark, d):
    """Tickers without keywords of their own are searched by their code."""
    known = keywords_or_ticker(star.tickers(spark, d), star.keywords(spark))
    return known.select("ticker", F.upper("keyword").alias("keyword"))


def clean_texts(spark, d):
    return star.documents(spark, d).select(F.col("id").alias("doc_id"), clean_text("raw_text").alias("clean"))


def html_text(spark, d):
    return star.pages(spark, d).select("page_id", clean_html("html").alias("text"))


def lexicon_scores(spark, d):
    docs = star.documents(spark, d).select(F.col("id").alias("doc_id"), clean_text_rows("raw_text").alias("text"))
    found = scoring.lexicon_probabilities(docs, "text", DOCUMENT_LEXICON)
    return scoring.scores(found).drop("text")


def count_words():
    """A scorer for batches: the lexicon rule in numpy, to stand in for a model."""
    import re

    word = re.compile(r"\w+")

    def scorer(texts: list[str]) -> np.ndarray:
        hits = np.array(
            [
                [sum(words.get(t, 0.0) for t in found) for words in (DOCUMENT_LEXICON.positive, DOCUMENT_LEXICON.negative)]
                for found in (word.findall(text.lower()) for text in texts)
            ]
        )
        logits = DOCUMENT_LEXICON.sharpness * hits / (hits.sum(axis=1, keepdims=True) + 1.0)
        logits = np.column_stack([logits, np.full(len(texts), DOCUMENT_LEXICON.neutral)])
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    return scorer


def batch_scoring(spark, d):
    docs = star.documents(spark, d).select(F.col("id").alias("doc_id"), clean_text_rows("raw_text").alias("text"))
    found = scoring.batch_probabilities(docs, "text", count_words)
    return scoring.scores(found).drop("text")


def score_new_articles(spark, d):
    """Select, clean, score and label what is not scored yet, as table rows."""
    raw = star.documents(spark, d).select(
        "*", F.lit("NATION_0").alias("ticker"), F.lit("news").alias("source"), F.lit(0).alias("upvotes")
    )
    done = raw.filter(F.col("collected_date") <= F.to_date(F.lit(SPLIT_DAY))).select(F.col("id").alias("raw_id"))
    return scoring.score_articles(raw, done, lexicon=DOCUMENT_LEXICON)


# --- landed files --------------------------------------------------------------------------


def _landed_documents(spark, d):
    """Documents with a headline (their first line) and a body (the rest)."""
    docs = star.table(spark, d, "documents")
    line_end = F.instr("text", "\n")
    return docs.select(
        "doc_id",
        "lang",
        "source",
        F.when(line_end > 0, F.substring("text", F.lit(1), line_end - 1)).otherwise(F.col("text")).alias("title"),
        F.when(line_end > 0, F.substring("text", line_end + 1, F.length("text"))).otherwise(F.lit("")).alias("body"),
        F.concat(F.lit("NATION_"), (F.col("doc_id") % 25).cast("string")).alias("ticker"),
    )


INGEST_TS = "2024-02-01 00:00:00"


def article_json(spark, d):
    """Documents landed as nested JSON articles in two shapes, then read as records."""
    path = work_path(spark, "articles")
    body = [
        F.col("title").alias("title"),
        F.lit("").alias("summary"),
        F.col("body").alias("description"),
        F.concat(F.lit("2024-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"), F.lit("T10:20:30Z")).alias(
            "pubDate"
        ),
        F.struct(F.col("source").alias("displayName")).alias("provider"),
        F.struct(F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string")).alias("url")).alias("canonicalUrl"),
    ]
    docs = _landed_documents(spark, d)
    nested = docs.filter("lang = 'en'").select("ticker", F.concat(F.lit("a"), "doc_id").alias("id"), F.struct(*body).alias("content"))
    flat = docs.filter("NOT lang <=> 'en'").select("ticker", *body)
    with shuffles_dropped(spark):
        for part in (nested, flat):
            out = landing.packed_files(part.hint("rebalance", "ticker").write).mode("append")
            out.partitionBy("ticker").json(path)
    records = articles.json_records(landing.read_json_articles(spark, path), F.lit(AS_OF), F.to_timestamp(F.lit(INGEST_TS)))
    return records.withColumn("published_at", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss"))


def _feed_items(spark, d) -> DataFrame:
    escaped = F.replace(F.replace("body", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return _landed_documents(spark, d).select(
        "ticker",
        "source",
        "title",
        F.concat(F.lit("<p>"), escaped, F.lit("</p>")).alias("description"),
        F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string")).alias("link"),
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("g"), "doc_id")).alias("guid"),
        F.concat(
            F.lit("Mon, "), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"), F.lit(" Jan 2024 10:20:30 +0530")
        ).alias("pubDate"),
    )


def feed_news(spark, d):
    """Documents landed as general feeds, then matched to every ticker they mention."""
    path = work_path(spark, "news")
    items = _feed_items(spark, d).withColumnRenamed("source", "author").drop("ticker")
    out = landing.packed_files(items.write).format("xml")
    out.option("rootTag", "channel").option("rowTag", "item").save(path)
    records = articles.feed_records(
        landing.read_feed_items(spark, path), star.keywords(spark), F.lit(AS_OF), F.to_timestamp(F.lit(INGEST_TS))
    )
    return records.withColumn("published_at", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss"))


def feed_xml(spark, d):
    """Documents landed as feed items per ticker, then read as records."""
    path = work_path(spark, "feeds")
    items = _feed_items(spark, d).drop("source")
    out = landing.packed_files(items.hint("rebalance", "ticker").write).partitionBy("ticker").format("xml")
    with shuffles_dropped(spark):
        out.option("rootTag", "rss").option("rowTag", "item").save(path)
    records = articles.ticker_feed_records(
        landing.read_ticker_feed_items(spark, path), F.lit(AS_OF), F.to_timestamp(F.lit(INGEST_TS))
    )
    return records.withColumn("published_at", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss"))


# --- streams -----------------------------------------------------------------------------------


def _event_stream(spark, d) -> DataFrame:
    events = streams.landed(spark, d, star.SCHEMAS["events"], "parquet", pathGlobFilter="events.parquet")
    clock = [F.year("ts"), F.month("ts"), F.day("ts"), F.hour("ts"), F.minute("ts"), F.expr("extract(SECOND FROM ts)")]
    return events.withColumn("event_time", F.make_timestamp(*clock, F.lit("UTC")))


def _scored_stream(spark, d) -> DataFrame:
    return star.scored_from_events(_event_stream(spark, d), keep=["event_time"])


def stream_daily_window(spark, d):
    """Days the watermark has closed, appended by the stream."""
    out = work_path(spark, "days")
    streams.run_available(
        streams.daily_windows(_scored_stream(spark, d), "event_time"), work_path(spark, "check"), output=out
    )
    return spark.read.parquet(out)


def stream_upsert(spark, d):
    """Changed days replaced in the table batch by batch, the open ones included."""
    tables = Tables(spark, work_path(spark, "upsert")).create("daily_sentiment")
    streams.run_available(
        streams.daily_windows(_scored_stream(spark, d), "event_time"),
        work_path(spark, "check"),
        each_batch=streams.replace_days(tables.root, "daily_sentiment", ["ticker", "sentiment_date"]),
        mode="update",
    )
    return tables.read("daily_sentiment").drop("computed_at")


def stream_dedup(spark, d):
    out = work_path(spark, "dedup")
    rows = star.from_events(_event_stream(spark, d)).withColumn("published_at", F.col("published_at").cast("timestamp"))
    once = streams.deduplicated(rows, ["source", "source_id", "ticker"], "published_at", spread="id")
    streams.run_available(once, work_path(spark, "check"), output=out)
    return spark.read.parquet(out).select("source", "source_id", "ticker", "collected_date")


def stream_ingest(spark, d):
    """Events inserted into the article table as they land, each key once."""
    tables = Tables(spark, work_path(spark, "ingest")).create("raw_sentiment")
    rows = star.from_events(_event_stream(spark, d))
    rows = rows.withColumn("url", F.col("id").cast("string")).drop("id")
    first = [F.col("url").cast("bigint")]
    streams.run_available(
        rows, work_path(spark, "check"), each_batch=streams.insert_batches(tables.root, "raw_sentiment", first)
    )
    return tables.read("raw_sentiment").select(*_RAW_COLUMNS, "url")


QUERIES = {
    f.__name__: f
    for f in (
        price_bars,
        price_files,
        price_collection,
        sentiment_daily,
        sentiment_daily_joined,
        weighted_sentiment,
        lag_correlation,
        optimal_lag,
        largest_samples,
        backfill_correlation,
        sentiment_price_view,
        latest_correlations,
        sector_sentiment,
        sector_overview,
        active_tickers,
        sentiment_history,
        sentiment_history_ticker,
        latest_sentiment,
        price_history,
        latest_correlation,
        top_correlations,
        sector_history,
        sector_history_sector,
        sentiment_price_series,
        freshness,
        period_summary,
        run_summary,
        run_findings,
        tracked_sentiment,
        holiday_filter,
        mention_counts_zero_filled,
        busiest_tickers,
        source_totals,
        quality_collection,
        quality_scoring,
        quality_report,
        publish_gate,
        dimension_probe,
        dedup_first,
        unscored,
        upsert_ignore,
        upsert_replace,
        article_ids,
        stored_defaults,
        collected_articles,
        sql_scan,
        keyword_match,
        keyword_match_large,
        keyword_defaults,
        clean_texts,
        html_text,
        lexicon_scores,
        batch_scoring,
        score_new_articles,
        article_json,
        feed_xml,
        feed_news,
        stream_daily_window,
        stream_upsert,
        stream_dedup,
        stream_ingest,
    )
}
QUERIES["clean_text"] = QUERIES.pop("clean_texts")
