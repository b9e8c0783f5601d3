"""Landed articles of every kind to ``raw_sentiment`` rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtape.functions.dates import first_date, parse_iso, parse_rfc822
from moodtape.functions.numeric import ColumnLike, as_col
from moodtape.functions.text import (
    MIN_FEED_TEXT,
    MIN_TICKER_TEXT,
    clean_html,
    full_text,
    only_if,
    source_id,
)
from moodtape.operators.dedup import first_of_few
from moodtape.operators.matching import with_tickers

# Source codes and the author used when an item names none.
FEED_SOURCE = "news"
TICKER_FEED_SOURCE = "google_news"
JSON_SOURCE = "yahoo_finance"
TICKER_FEED_AUTHOR = "Google News"
JSON_AUTHOR = "Yahoo Finance"

RECORD = ["source", "source_id", "ticker", "published_at", "collected_date", "raw_text", "author", "upvotes", "url"]


def _non_empty(*choices: ColumnLike) -> Column:
    return F.coalesce(*[F.nullif(as_col(c), F.lit("")) for c in choices])


def _records(
    landed: DataFrame, key: Column, fields: Callable[[DataFrame], DataFrame], source: str, run_date: ColumnLike
) -> DataFrame:
    """Common last step: column set, and one row per source id (the first in feed order).

    ``key`` is the source id of a landed article, or a part of it that tells all source ids apart.
    """

    def rows(articles: DataFrame) -> DataFrame:
        return fields(articles).select(
            F.lit(source).alias("source"),
            source_id("article_id", "url", "ticker").alias("source_id"),
            "ticker",
            "published_at",
            as_col(run_date).cast("date").alias("collected_date"),
            F.col("text").alias("raw_text"),
            "author",
            F.lit(0).alias("upvotes"),
            "url",
            *FEED_ORDER,
        )

    return first_of_few(landed, key, rows, ["source_id"], FEED_ORDER).select(*RECORD)


def _long_enough(text: Column, least: int) -> Column:
    return only_if(text, lambda t: F.length(t) >= least).alias("text")


def _feed_id() -> tuple[Column, Column]:
    """Id and address of a feed item."""
    return F.coalesce("id", "guid"), F.coalesce("link", F.lit(""))


def _feed_fields(items: DataFrame, least: int) -> DataFrame:
    article_id, url = _feed_id()
    return items.select(
        "*",
        _long_enough(full_text("title", clean_html(_non_empty("summary", "description"))), least),
        url.alias("url"),
        article_id.alias("article_id"),
    )


def _ends_told_apart(keywords: DataFrame) -> bool:
    """Whether no ticker is missing or ends with ``_`` and another one, so that a source id has one reading."""
    tickers = keywords.select("ticker").distinct()
    parts, at = F.split("ticker", "_"), F.sequence(F.lit(1), F.size(F.split("ticker", "_")))
    ends = F.transform(F.filter(at, lambda i: i > 1), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "_"))
    clash = tickers.select(F.explode(ends).alias("ticker")).join(tickers, "ticker", "left_semi")
    return clash.unionByName(tickers.filter("ticker IS NULL")).isEmpty()


# Files in name order, then items in the order they stand in the file; numbered where they are read.
FEED_ORDER = ["file", "block", "_nth"]


def feed_records(items: DataFrame, keywords: DataFrame, run_date: ColumnLike, ingest_ts: ColumnLike) -> DataFrame:
    """Items of general feeds, matched to every ticker they mention."""
    published = [parse_rfc822(c) for c in ("pubDate", "published", "updated", "created")]

    def fields(some: DataFrame) -> DataFrame:
        return with_tickers(_feed_fields(some, MIN_FEED_TEXT), keywords, "text").withColumns(
            {
                "published_at": first_date(published, ingest_ts),
                "author": F.coalesce(
                    F.col("author"),
                    F.col("`dc:creator`"),
                    F.col("feed_title"),
                    F.element_at(F.split("file", "/"), -1),
                ),
            }
        )

    # Without the ticker, as that is known only once the texts have been searched.
    key = F.coalesce(*_feed_id()) if _ends_told_apart(keywords) else F.lit("")
    return _records(items, key, fields, FEED_SOURCE, run_date)


def ticker_feed_records(items: DataFrame, run_date: ColumnLike, ingest_ts: ColumnLike) -> DataFrame:
    """Items of feeds that were searched per ticker; the ticker is given."""
    published = [parse_rfc822(c) for c in ("pubDate", "published", "updated")]

    def fields(some: DataFrame) -> DataFrame:
        return _feed_fields(some, MIN_TICKER_TEXT).withColumns(
            {
                "published_at": first_date(published, ingest_ts),
                "author": F.coalesce(F.col("source._VALUE"), F.lit(TICKER_FEED_AUTHOR)),
            }
        ).drop("source")

    return _records(items, source_id(*_feed_id(), "ticker"), fields, TICKER_FEED_SOURCE, run_date)


def _field(name: str) -> Column:
    return F.when(F.col("content").isNotNull(), F.col(f"content.{name}")).otherwise(F.col(name))


def _is_object(c: Column) -> Column:
    return F.ltrim(c).startswith("{")


def _json_url() -> Column:
    link = _field("canonicalUrl")
    return F.coalesce(F.when(_is_object(link), F.get_json_object(link, "$.url")).otherwise(link), F.lit(""))


def article_fields(articles: DataFrame) -> DataFrame:
    """Open nested JSON articles: fields sit under ``content`` or on the article itself."""
    provider = _field("provider")
    return articles.select(
        "ticker",
        *FEED_ORDER,
        _long_enough(full_text(_field("title"), _non_empty(_field("summary"), _field("description"))), MIN_TICKER_TEXT),
        _field("pubDate").alias("published"),
        F.coalesce(
            F.when(_is_object(provider), F.get_json_object(provider, "$.displayName")), F.lit(JSON_AUTHOR)
        ).alias("author"),
        _json_url().alias("url"),
        F.col("id").alias("article_id"),
    )


def json_records(articles: DataFrame, run_date: ColumnLike, ingest_ts: ColumnLike) -> DataFrame:
    """JSON articles landed per ticker."""

    def fields(some: DataFrame) -> DataFrame:
        return article_fields(some).withColumn("published_at", first_date([parse_iso("published")], ingest_ts))

    return _records(articles, source_id("id", _json_url(), "ticker"), fields, JSON_SOURCE, run_date)
