"""Table and input schemas, keys and column defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_KINDS = {
    "s": T.StringType(),
    "d": T.DoubleType(),
    "l": T.LongType(),
    "i": T.IntegerType(),
    "b": T.BooleanType(),
    "date": T.DateType(),
    "ts": T.TimestampType(),
}


def _schema(text: str) -> T.StructType:
    """``name kind`` pairs; a trailing ``!`` marks a column that may not be NULL."""
    fields = []
    for item in text.replace("\n", " ").split(","):
        name, kind = item.split()
        fields.append(T.StructField(name, _KINDS[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


@dataclass(frozen=True)
class Table:
    """One stored table: schema, key, the day column it is partitioned by, defaults.

    ``defaults`` are SQL expressions used where a written frame lacks the column
    or holds NULL in it.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    day: str | None = None
    defaults: dict[str, str] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


TICKERS = Table(
    "tickers",
    _schema("ticker s!, company_name s!, sector s, industry s, exchange s, is_active b, added_at ts"),
    key=("ticker",),
    defaults={"exchange": "'NSE'", "is_active": "true", "added_at": "current_timestamp()"},
)

PRICE_DAILY = Table(
    "price_daily",
    _schema(
        """ticker s!, trade_date date!, open_price d, high_price d, low_price d, close_price d,
        adj_close d, volume l, pct_change d, intraday_range d, ingested_at ts"""
    ),
    key=("ticker", "trade_date"),
    day="trade_date",
    defaults={"ingested_at": "current_timestamp()"},
)

# Row ids are digests of the key rather than numbers from a sequence: the same
# article gets the same id on a re-run, and 128 bits do not collide at any size.
# A row without source_id has no key, so its content stands in.
ROW_ID = (
    "md5(concat_ws('\\u001f', source, ticker, coalesce(source_id, "
    "concat_ws('\\u001f', 'no id', url, cast(published_at as string), raw_text))))"
)

RAW_SENTIMENT = Table(
    "raw_sentiment",
    _schema(
        """id s!, source s!, source_id s, ticker s!, published_at ts, collected_date date!,
        raw_text s!, author s, upvotes i, url s, ingested_at ts"""
    ),
    key=("source", "source_id", "ticker"),
    day="collected_date",
    defaults={
        "id": ROW_ID,
        "upvotes": "0",
        "ingested_at": "current_timestamp()",
    },
)

# source and upvotes ride along so that the daily roll-up needs no second join
# of the two largest tables.
SENTIMENT_SCORED = Table(
    "sentiment_scored",
    _schema(
        """id s!, raw_id s!, ticker s!, source s, upvotes i, scored_date date!, label s!,
        score_positive d!, score_negative d!, score_neutral d!, confidence d!, compound_score d!,
        scored_at ts"""
    ),
    key=("raw_id",),
    day="scored_date",
    defaults={"id": "raw_id", "scored_at": "current_timestamp()"},
)

DAILY_SENTIMENT = Table(
    "daily_sentiment",
    _schema(
        """ticker s!, sentiment_date date!, total_mentions i, news_mentions i, google_news_mentions i,
        yahoo_finance_mentions i, avg_sentiment_score d, engagement_weighted_score d,
        positive_ratio d, negative_ratio d, neutral_ratio d, sentiment_std d, computed_at ts"""
    ),
    key=("ticker", "sentiment_date"),
    day="sentiment_date",
    defaults={
        "total_mentions": "0",
        "news_mentions": "0",
        "google_news_mentions": "0",
        "yahoo_finance_mentions": "0",
        "computed_at": "current_timestamp()",
    },
)

SENTIMENT_PRICE_CORRELATION = Table(
    "sentiment_price_correlation",
    _schema(
        """ticker s!, analysis_date date!, corr_lag_0d d, corr_lag_1d d, corr_lag_2d d, corr_lag_3d d,
        corr_lag_7d d, optimal_lag_days i, optimal_lag_corr d, rolling_30d_avg_sent d,
        rolling_30d_price_ret d, sample_size i, computed_at ts"""
    ),
    key=("ticker", "analysis_date"),
    day="analysis_date",
    defaults={"computed_at": "current_timestamp()"},
)

TABLES = {
    t.name: t
    for t in (
        TICKERS,
        PRICE_DAILY,
        RAW_SENTIMENT,
        SENTIMENT_SCORED,
        DAILY_SENTIMENT,
        SENTIMENT_PRICE_CORRELATION,
    )
}

# Landed inputs.
BAR_FILE = _schema("date date, open d, high d, low d, close d, volume l, adj_close d")

FEED_ITEM = T.StructType(
    [T.StructField(n, T.StringType()) for n in (
        "title", "summary", "description", "link", "guid", "id", "pubDate", "published", "updated", "created", "author", "dc:creator",
    )]
    + [T.StructField("source", T.StructType([T.StructField(n, T.StringType()) for n in ("_VALUE", "_url")]))]
)

def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ATOM_ENTRY = T.StructType(
    [T.StructField(n, _strings("_VALUE", "_type")) for n in ("title", "summary", "content")]
    + _strings("id", "published", "updated").fields
    + [T.StructField("link", T.ArrayType(_strings("_href", "_rel", "_VALUE"))), T.StructField("author", T.ArrayType(_strings("name")))]
)

# provider and canonicalUrl arrive either as an object or as a plain string, so
# they are read as text and opened with JSON path expressions.
_ARTICLE_BODY = [
    T.StructField(n, T.StringType())
    for n in ("title", "summary", "description", "pubDate", "provider", "canonicalUrl")
]
ARTICLE = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("content", T.StructType(_ARTICLE_BODY))] + _ARTICLE_BODY
)
