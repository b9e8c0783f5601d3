"""The tracked instruments, their keywords, and the market holidays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtape.schemas import TICKERS

# Ticker, company, sector, industry, keywords.
INSTRUMENTS = [
    ("RELIANCE", "Reliance Industries", "Energy", "Oil & Gas", ["Reliance", "RIL", "Mukesh Ambani", "Jio"]),
    ("HINDUNILVR", "Hindustan Unilever", "FMCG", "Consumer Goods", ["Hindustan Unilever", "HUL"]),
    ("ADANIGREEN", "Adani Green Energy", "Utilities", "Power Generation", ["Adani Green Energy", "Adani Green"]),
    ("NTPC", "NTPC Limited", "Utilities", "Power Generation", ["NTPC Limited", "NTPC"]),
    ("JSWINFRA", "JSW Infrastructure", "Infrastructure", "Port", ["JSW Infrastructure", "JSW"]),
    ("TCS", "Tata Consultancy Services", "IT", "Software", ["Tata Consultancy Services", "TCS", "Tata"]),
    ("INFY", "Infosys", "IT", "Software", ["Infosys", "Narayana Murthy"]),
    ("HCLTECH", "HCL Technologies", "IT", "Software", ["HCL Technologies", "HCL"]),
    ("WIPRO", "Wipro", "IT", "Software", ["Wipro Limited", "WIPRO"]),
    ("TECHM", "Tech Mahindra Ltd", "IT", "software", ["Tech Mahindra Ltd", "TECHM"]),
    ("HDFCBANK", "HDFC Bank", "Finance", "Banking", ["HDFC BANK", "HDFC"]),
    ("ICICIBANK", "ICICI Bank", "Finance", "Banking", ["ICICI BANK", "ICICI"]),
    ("KOTAKBANK", "Kotak Mahindra Bank", "Finance", "Banking", ["KOTAK BANK", "KOTAK"]),
    ("AXISBANK", "Axis Bank", "Finance", "Banking", ["AXIS BANK", "AXIS"]),
    ("SBIN", "State Bank of India", "Finance", "Banking", ["SBI BANK OF INDIA", "SBI"]),
    ("TMCV", "Tata Motors", "Auto", "Commercial Vehicles", ["TATA MOTORS", "Tata"]),
    ("M&M", "Mahindra and Mahindra", "Auto", "Passenger Vehicles", ["Mahindra & Mahindra"]),
    ("MARUTI", "Maruti Suzuki", "Auto", "Passenger Vehicles", ["MARUTI SUZUKI"]),
    ("HYUNDAI", "Hyundai", "Auto", "Passenger Vehicles", ["HYUNDAI MOTOR INDIA", "HYU"]),
    ("BAJAJ-AUTO", "Bajaj auto", "Auto", "Commercial Vehicles", ["BAJAJ Auto", "Bajaj"]),
    ("GOLDBEES", "Nippon India ETF Gold BeES", "Metals", "Commodities", ["Nippon India ETF Gold BeES", "Gold ETF"]),
    ("SILVERBEES", "Nippon India Silver ETF", "Metals", "Commodities", ["Nippon India Silver ETF", "Silver ETF"]),
    ("BANKBEES", "Nippon India ETF Bank BeES", "Finance", "Banking", ["Nippon India ETF Nifty Bank BeES", "Bank ETF"]),
    ("SUNPHARMA", "Sun Pharmaceutical", "Healthcare", "Pharma", ["Sun Pharmaceutical Industries", "Sun Pharma"]),
    ("ONGC", "ONGC", "Energy", "Oil & Gas", ["Oil and Natural Gas Corporation"]),
]

# Weekdays in 2026 on which the exchange is closed.
HOLIDAYS = ["2026-09-14", "2026-10-02", "2026-10-20", "2026-11-10", "2026-11-24", "2026-12-25"]

# Exchange code and the suffix its symbols carry at the price vendor.
EXCHANGE = "NSE"
VENDOR_SUFFIX = ".NS"


def seed_tickers(spark: SparkSession) -> DataFrame:
    """The instrument dimension, with the column defaults filled in."""
    rows = [(t, name, sector, industry, EXCHANGE, True) for t, name, sector, industry, _ in INSTRUMENTS]
    fields = [f.name for f in TICKERS.schema.fields if f.name != "added_at"]
    kinds = ", ".join(f"{n} {TICKERS.schema[n].dataType.simpleString()}" for n in fields)
    return spark.createDataFrame(rows, kinds).withColumn("added_at", F.current_timestamp())


def seed_keywords(spark: SparkSession) -> DataFrame:
    """(ticker, keyword) rows of the tracked instruments."""
    rows = [(t, k) for t, *_, keys in INSTRUMENTS for k in keys]
    return spark.createDataFrame(rows, "ticker string, keyword string")


def keywords_or_ticker(tickers: DataFrame, keywords: DataFrame) -> DataFrame:
    """Keyword rows for every ticker; one without keywords is searched by its own code."""
    listed = tickers.select("ticker").join(keywords, "ticker", "left")
    return listed.select("ticker", F.coalesce("keyword", "ticker").alias("keyword")).distinct()


def vendor_symbol(ticker: str | Column = "ticker") -> Column:
    return F.concat(F.col(ticker) if isinstance(ticker, str) else ticker, F.lit(VENDOR_SUFFIX))


def is_holiday(day: str | Column, holidays: list[str] = HOLIDAYS) -> Column:
    day = F.col(day) if isinstance(day, str) else day
    return day.isin([F.to_date(F.lit(h)) for h in holidays]) if holidays else F.lit(False)


def trading_rows(df: DataFrame, day: str, holidays: list[str] = HOLIDAYS) -> DataFrame:
    """Rows whose day is not a listed holiday.  Weekends are not looked at."""
    return df.filter(~is_holiday(day, holidays))


def tracked(df: DataFrame, tickers: DataFrame, column: str = "ticker") -> DataFrame:
    """Rows of tracked tickers, the code upper-cased first."""
    return df.withColumn(column, F.upper(column)).join(
        tickers.select(F.col("ticker").alias(column)), column, "left_semi"
    )
