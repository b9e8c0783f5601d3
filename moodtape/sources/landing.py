"""Landed files: how raw bars, feeds and JSON articles are written and read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodtape.schemas import ARTICLE, ATOM_ENTRY, BAR_FILE, FEED_ITEM

# Fixed value: bar files are named <ticker>_<run date>.csv.
BAR_FILE_NAME = r"([^/]+)_(\d{4}-\d{2}-\d{2})\.csv[^/]*$"
#: Most rows of a compressed file.
PACKED_ROWS = 100_000


def snake_names(df: DataFrame) -> DataFrame:
    """Flatten two-level columns to their first level; lower case, blanks to underscores."""
    flat = []
    for f in df.schema.fields:
        one_below = isinstance(f.dataType, T.StructType) and len(f.dataType) == 1
        c = F.col(f"`{f.name}`")
        c = c[f.dataType.names[0]] if one_below else c
        flat.append(c.alias(f.name.lower().replace(" ", "_")))
    return df.select(*flat)


def _decoded(path: Column) -> Column:
    """A file's path as it was written; ``_metadata`` shows it URL-encoded."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _layouts(spark: SparkSession, path: str, base: str) -> list[tuple[str, list[str]]]:
    """Header lines and the files that begin with each.  As many rows as there are files, which a scan lists anyway."""
    lines = spark.read.option("basePath", base).text(path).select(
        "value", _decoded(F.col("_metadata.file_path")).alias("file"), F.struct(*_position()[1:]).alias("at")
    )
    first = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    found = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header")
    return [(r["header"], r["files"]) for r in found.collect()]


def read_bar_files(spark: SparkSession, path: str, base: str | None = None) -> DataFrame:
    """Bars from CSV with a header, with ticker and run_date.

    Columns are matched by name, file by file: files of one layout are read
    together, and a column that a layout lacks is NULL in its rows.  Ticker and
    run date come from the folders below ``base`` (``run_date=…/ticker=…``) when
    the files were written that way, else from the file name; both are read as
    declared, so a ticker keeps its leading zeros.
    """
    base = (base or path).rstrip("/")
    parts = []
    for header, files in _layouts(spark, path, base):
        names = [n.strip().strip('"') for n in header.lstrip("\ufeff").split(",")]
        below = [c for c in ("run_date", "ticker") if all(f"/{c}=" in f for f in files)]
        schema = ", ".join([f"`{n}` string" for n in names] + [f"{c} string" for c in below])
        raw = spark.read.schema(schema).option("header", True).option("basePath", base).csv(files)
        parts.append(_bars_of(raw.withColumn("_file", _decoded(F.col("_metadata.file_path")))))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField("ticker", T.StringType()), T.StructField("run_date", T.DateType()), *BAR_FILE.fields]))
    return reduce(DataFrame.unionByName, parts)


def _bars_of(raw: DataFrame) -> DataFrame:
    bars = snake_names(raw)
    found = set(bars.columns)

    def from_name(column: str, group: int):
        return F.col(column) if column in found else F.regexp_extract("_file", BAR_FILE_NAME, group)

    values = [
        (F.col(f.name) if f.name in found else F.lit(None)).try_cast(f.dataType).alias(f.name)
        for f in BAR_FILE.fields
        if f.name not in ("date", "volume")
    ]
    return bars.select(
        from_name("ticker", 1).cast("string").alias("ticker"),
        from_name("run_date", 2).cast("date").alias("run_date"),
        F.substring("date", 1, 10).try_cast("date").alias("date"),
        *values,
        (F.col("volume") if "volume" in found else F.lit(None)).try_cast("double").cast("bigint").alias("volume"),
    )


def write_bar_files(bars: DataFrame, path: str) -> None:
    """Land bars as CSV, one folder per run date and ticker."""
    columns = ["ticker", "run_date", *[f.name for f in BAR_FILE.fields if f.name in bars.columns]]
    out = bars.select(*columns).hint("rebalance", "run_date", "ticker")
    out.write.mode("append").partitionBy("run_date", "ticker").option("header", True).csv(path)


def packed_files(writer: DataFrameWriter) -> DataFrameWriter:
    """Texts compressed, the quick way, as they are landed whole.

    Such files do not split, so none gets more rows than one task can well read.
    """
    return writer.options(compression="gzip", maxRecordsPerFile=PACKED_ROWS, **{"zlib.compress.level": "BEST_SPEED"})


def _position() -> list[Column]:
    """Where a row was read from, and its number within the read block: the feed order.

    Taken at the scan, as a number given after a shuffle says nothing about the file.
    """
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_nth"),
    ]


def _xml(spark: SparkSession, path: str, tag: str, schema: T.StructType) -> DataFrame:
    """Elements of one name.  One that cannot be parsed fails the read, as a broken JSON record does."""
    return spark.read.format("xml").option("rowTag", tag).option("mode", "FAILFAST").schema(schema).load(path)


def _entries(spark: SparkSession, path: str) -> DataFrame:
    """Atom entries in the columns of feed items: the address is an attribute, the author an element of its own.

    Where an entry has several links the one to the article itself counts (``alternate``, also if not said), else
    the first; a missing summary is the content.
    """
    raw = _xml(spark, path, "entry", ATOM_ENTRY)
    own = F.filter("link", lambda link: F.coalesce(link["_rel"], F.lit("alternate")) == "alternate")
    link = F.coalesce(F.get(own, 0), F.get("link", 0))["_href"]
    text = {c: F.col(f"{c}._VALUE") for c in ("title", "summary", "content")}
    known = {
        "title": text["title"],
        "summary": F.coalesce(F.nullif(text["summary"], F.lit("")), text["content"]),
        "link": link,
        "id": F.col("id"),
        "published": F.col("published"),
        "updated": F.col("updated"),
        "author": F.get("author", 0)["name"],
    }
    columns = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in FEED_ITEM.fields]
    return raw.select(*columns, *_position())


def read_feed_items(spark: SparkSession, path: str) -> DataFrame:
    """Feed items from XML, one row per <item> (RSS) or <entry> (Atom), with the title of their feed.

    The file is split at the items, so a large feed is read by many tasks.
    """
    items = _xml(spark, path, "item", FEED_ITEM).select("*", *_position()).unionByName(_entries(spark, path))
    # A feed's own title is the first of its file; read by that tag, no row holds a whole channel.
    title = T.StructType([T.StructField("_VALUE", T.StringType())])
    titles = _xml(spark, path, "title", title).select("_VALUE", *_position())
    first = titles.groupBy("file").agg(F.min_by("_VALUE", F.struct("block", "_nth")).alias("feed_title"))
    # One row a file, which the scan lists anyway: sent to the items, which else would all be shuffled to their file's row.
    return items.join(first.hint("broadcast"), "file", "left")


def read_ticker_feed_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of feeds landed per ticker, in folders ``ticker=…``."""
    schema = T.StructType(FEED_ITEM.fields + [T.StructField("ticker", T.StringType())])
    return _xml(spark, path, "item", schema).select("*", *_position())


def read_json_articles(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Nested JSON articles landed per ticker, in folders ``ticker=…``.

    Use one article per line where possible: such files split over tasks, a
    multi-line array does not.  A record that cannot be parsed fails the read, as
    do arrays over several lines read without ``multi_line``.
    """
    schema = T.StructType(ARTICLE.fields + [T.StructField("ticker", T.StringType())])
    articles = spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)
    return articles.select("*", *_position())


def write_article_records(records: DataFrame, path: str, run_date: str | None = None) -> None:
    """Land article records as JSON lines, one folder per collection date."""
    day = F.col("collected_date") if run_date is None else F.to_date(F.lit(run_date))
    out = records.withColumn("run_date", day).hint("rebalance", "run_date")
    # The default format would cut timestamps to milliseconds.
    options = {"ignoreNullFields": False, "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    out.write.mode("append").partitionBy("run_date").options(**options).json(path)
