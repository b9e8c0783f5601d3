"""The star-schema tables (orders, events, documents, …) seen as market data.

Nations stand in for tickers and regions for sectors; orders give price bars,
events give scored articles, documents and pages give texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtape.functions.numeric import round_half_up
from moodtape.operators.bars import price_rows
from moodtape.operators.daily import daily_sentiment

FIRST_DAY = "2024-01-01"
DAYS = 30
HOLIDAYS = ["2024-01-15", "2024-01-26"]

# Keywords that occur in the documents, one with a blank and one with a symbol.
KEYWORDS = [
    ("NATION_0", "the"),
    ("NATION_1", "und"),
    ("NATION_2", "les"),
    ("NATION_2", "pour"),
    ("NATION_3", "que"),
    ("NATION_4", "and"),
    ("NATION_5", "in the"),
    ("NATION_6", "ZZZ&Z"),
]


# Given schemas spare a job per table that would only read file footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


#: Session setting: into how many tasks the texts of documents and pages are dealt after the scan (default: as scanned).
SCAN_TASKS = "moodtape.scan.tasks"


def _dealt(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """Texts in as many tasks as the caller sets.

    For files of fewer row groups than there are cores, where a scan makes one
    task a row group; it costs one exchange of the texts, so it is the caller's
    choice and never made by size.
    """
    tasks = spark.conf.get(SCAN_TASKS, None)
    return texts.repartition(int(tasks)) if tasks else texts


def tickers(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("ticker"),
        F.col("n_name").alias("company_name"),
        F.col("r_name").alias("sector"),
        F.lit(None).cast("string").alias("industry"),
        F.lit(True).alias("is_active"),
    )


def keywords(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KEYWORDS, "ticker string, keyword string")


def _ticker(number):
    return F.concat(F.lit("NATION_"), number.cast("string"))


def _source():
    kind = F.col("event_type")
    return (
        F.when(kind == "view", "news")
        .when(kind == "click", "google_news")
        .when(kind == "signup", "yahoo_finance")
        .otherwise("other")
    )


def raw_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Events as collected articles.  A user's events of one kind on one day are one article, repeated."""
    return from_events(table(spark, folder, "events"))


def from_events(events: DataFrame) -> DataFrame:
    day = F.to_date("ts")
    parts = [F.col("user_id").cast("string"), F.col("event_type"), day.cast("string")]
    return events.select(
        F.col("event_id").alias("id"),
        _source().alias("source"),
        F.concat_ws("_", *parts).alias("source_id"),
        _ticker(F.col("user_id") % 25).alias("ticker"),
        F.col("ts").alias("published_at"),
        day.alias("collected_date"),
        F.concat(
            F.col("event_type"), F.lit(" by user "), F.col("user_id").cast("string"), F.lit(" props "), F.col("props")
        ).alias("raw_text"),
        F.get_json_object("props", "$.k").alias("author"),
        F.floor("value").cast("int").alias("upvotes"),
    )


def scored_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Events as scored articles; the score grows with the event value."""
    return scored_from_events(table(spark, folder, "events"))


def scored_from_events(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    positive = round_half_up(F.lit(0.8) * F.least("value", F.lit(500.0)) / 500.0, 4)
    scored = events.select(
        F.col("event_id").alias("raw_id"),
        _ticker(F.col("user_id") % 25).alias("ticker"),
        _source().alias("source"),
        F.floor("value").cast("int").alias("upvotes"),
        F.to_date("ts").alias("scored_date"),
        positive.alias("score_positive"),
        *keep,
    )
    return scored.select(
        "*",
        round_half_up(F.lit(0.8) - F.col("score_positive"), 4).alias("score_negative"),
        F.lit(0.2).alias("score_neutral"),
        round_half_up(F.col("score_positive") * 2.0 - 0.8, 4).alias("compound_score"),
    )


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as daily bars per nation, weekdays only."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    day = F.date_add(F.to_date(F.lit(FIRST_DAY)), (F.col("o_orderkey") % DAYS).cast("int"))
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .groupBy("c_nationkey", day.alias("date"))
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
        .filter(F.weekday("date") < 5)
        .select(_ticker(F.col("c_nationkey")).alias("ticker"), "date", "open", "high", "low", "close", "volume")
    )


def prices(spark: SparkSession, folder: str) -> DataFrame:
    return price_rows(bars(spark, folder))


def daily(spark: SparkSession, folder: str) -> DataFrame:
    return daily_sentiment(scored_articles(spark, folder))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return _dealt(spark, table(spark, folder, "pages").select("page_id", "html"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as articles collected over a month."""
    docs = _dealt(spark, table(spark, folder, "documents").select("doc_id", "text"))
    return docs.select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("raw_text"),
        F.date_add(F.to_date(F.lit(FIRST_DAY)), (F.col("doc_id") % DAYS).cast("int")).alias("collected_date"),
    )
