"""The stored tables: Parquet folders, partitioned by day, written by key.

A thin object that knows where the tables are.  Reading gives DataFrames; the
three ways to write are append, insert-or-ignore and replace-by-key.

A replacement is written beside the table as a whole, then committed by one mark,
then moved in day by day.  Until the mark is there a reader sees the old rows;
from then on it sees the new ones, taking those days that are not moved yet from
where they were written, so a writer that dies in between leaves no mixture.  The
next writer finishes the moves.  There is one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodtape.dimensions import seed_tickers
from moodtape.operators.dedup import first_per_full_key, not_stored, replaced
from moodtape.plans import views
from moodtape.schemas import TABLES, Table
from moodtape.session import work_path
from moodtape.sources.files import Files
from moodtape.sources.keys import KeyIndex, key_digest

#: Ends the name of the mark that commits a replacement.
COMMITTED = ".committed"


def _indexed(table: Table) -> bool:
    """Whether inserts need an index of keys: the key does not say on which day a row lies."""
    return table.day is not None and table.day not in table.key


def aligned(df: DataFrame, table: Table) -> DataFrame:
    """Columns matched by name, defaults filled in, types cast, missing values refused."""
    given = df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema.fields]
    )
    filled = given.withColumns({c: F.coalesce(F.col(c), F.expr(default)) for c, default in table.defaults.items()})

    def present(f: T.StructField) -> Column:
        if f.nullable:
            return F.col(f.name).cast(f.dataType)
        refuse = F.raise_error(F.lit(f"NULL in {table.name}.{f.name}"))
        return F.coalesce(F.col(f.name).cast(f.dataType), refuse.cast(f.dataType)).alias(f.name)

    return filled.select(*[present(f) for f in table.schema.fields])


def _counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The frame, and a function that tells after its write how many rows went through.

    Placed in the last stage, where a repeated task is not counted twice.
    """
    seen = Observation()

    def rows() -> int:
        try:
            return int(seen.get["n"])
        except Py4JJavaError:
            # A plan found to be empty runs no task, so there is no count to fetch.
            return 0

    return df.observe(seen, F.count(F.lit(1)).alias("n")), rows


class Tables:
    """The six tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark)
        self._staged: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{TABLES[name].name}"

    # --- set-up and reading ----------------------------------------------------

    def create(self, *names: str) -> "Tables":
        """Create missing tables (all, or those named) and add missing instruments.  Safe to repeat."""
        for table in [TABLES[n] for n in names or TABLES]:
            empty = self.spark.createDataFrame([], table.schema)
            writer = empty.write.mode("ignore")
            (writer.partitionBy(table.day) if table.day else writer).parquet(self.path(table.name))
        if "tickers" in (names or TABLES):
            self.insert("tickers", seed_tickers(self.spark))
        return self

    def read(self, name: str) -> DataFrame:
        table = TABLES[name]
        rows = self._rows(table, self.path(name)) if self.files.exists(self.path(name)) else None
        for folder in self._committed(table):
            new = self._rows(table, folder)
            if table.day:
                days = [n.split("=", 1)[1] for n in self.files.names(folder) if n.startswith(f"{table.day}=")]
                new = rows.filter(~F.col(table.day).cast("string").isin(days)).unionByName(new) if days else rows
            rows = new
        if rows is None:
            raise FileNotFoundError(self.path(name))
        return rows

    def _rows(self, table: Table, path: str) -> DataFrame:
        return self.spark.read.schema(table.schema).parquet(path).select(*table.schema.names)

    # --- replacements on their way -----------------------------------------------------

    def _replacing(self, table: Table) -> str:
        return f"{self.root}/_replacing/{table.name}"

    def _committed(self, table: Table) -> list[str]:
        """The folder of a replacement that is committed and not moved in as a whole yet: none or one."""
        folder = self._replacing(table)
        found = self.files.names(folder)
        return [f"{folder}/{n}" for n in found if f"{n}{COMMITTED}" in found]

    def _settle(self, table: Table) -> None:
        """Finish what a writer left: move in what was committed, remove what was not."""
        for folder in self._committed(table):
            if table.day:
                for day in [n for n in self.files.names(folder) if n.startswith(f"{table.day}=")]:
                    self.files.delete(f"{self.path(table.name)}/{day}")
                    self.files.move(f"{folder}/{day}", f"{self.path(table.name)}/{day}")
            else:
                self.files.delete(self.path(table.name))
                self.files.move(folder, self.path(table.name))
        self.files.delete(self._replacing(table))
        self.spark.catalog.refreshByPath(self.path(table.name))

    def register(self) -> "Tables":
        """Temporary views for SQL: the tables and the three stored queries over them."""
        for name in TABLES:
            self.read(name).createOrReplaceTempView(name)
        daily, prices, tickers = self.read("daily_sentiment"), self.read("price_daily"), self.read("tickers")
        correlations = self.read("sentiment_price_correlation")
        views.sentiment_price(daily, prices).createOrReplaceTempView("vw_sentiment_price")
        views.latest_correlations(correlations, tickers).createOrReplaceTempView("vw_latest_correlations")
        views.sector_sentiment(daily, prices, tickers).createOrReplaceTempView("vw_sector_sentiment")
        return self

    def query(self, sql: str, params: Sequence[Any] | dict[str, Any] | None = None) -> DataFrame:
        """A SQL query with ``?`` or ``:name`` parameters over the views."""
        self.register()
        args = params if isinstance(params, dict) or params is None else list(params)
        return self.spark.sql(sql, args=args) if args else self.spark.sql(sql)

    # --- writing -----------------------------------------------------------------

    def _write(self, df: DataFrame, table: Table, path: str | None = None) -> int:
        """One write; the rows are counted on the way, not by a second job.

        The rebalance hint makes files of a sensible size per day and splits a
        day that holds much of the data.
        """
        path = path or self.path(table.name)
        even = df.hint("rebalance", table.day) if table.day else df
        counted, seen = _counted(even)
        writer = counted.write.partitionBy(table.day) if table.day else counted.write
        writer.mode("append").parquet(path)
        self.spark.catalog.refreshByPath(path)
        return seen()

    def _stage(self, df: DataFrame, table: Table, label: str, more: str = "") -> tuple[DataFrame, int]:
        """Write rows that are used more than once to the shared folder; also their number."""
        path = work_path(self.spark, f"{label}-{table.name}")
        self._staged.append(path)
        counted, seen = _counted(df)
        counted.write.parquet(path)
        schema = T.StructType([*table.schema.fields, *(T.StructType.fromDDL(more).fields if more else [])])
        return self.spark.read.schema(schema).parquet(path), seen()

    def _unstage(self, written: int) -> int:
        """Remove staged rows that have been written, and pass on how many were."""
        while self._staged:
            self.files.delete(self._staged.pop())
        return written

    def _on_days_of(self, incoming: DataFrame, stored: DataFrame, table: Table) -> DataFrame:
        """Stored rows on the days that come in.  As literals the days prune partitions at the scan;
        there are as many as the calendar has, not as the data has rows."""
        days = [r[0] for r in incoming.select(table.day).distinct().collect()]
        return stored.filter(F.col(table.day).isin(days))

    def append(self, name: str, df: DataFrame) -> int:
        table = TABLES[name]
        self._settle(table)
        if _indexed(table):
            KeyIndex(self.spark, self.root, table).outdated()
        return self._write(aligned(df, table), table)

    def append_rows(self, name: str, rows: Sequence[Sequence[Any]], columns: Sequence[str]) -> int:
        """A few rows typed in by hand."""
        if not rows:
            return 0
        kinds = TABLES[name].schema
        ddl = ", ".join(f"{c} {kinds[c].dataType.simpleString()}" for c in columns)
        return self.append(name, self.spark.createDataFrame(list(rows), ddl))

    def insert(self, name: str, df: DataFrame, order: Sequence[Column | str] | None = None) -> int:
        """Insert rows whose key is not stored yet; returns how many were.

        Of several incoming rows with one key the first in ``order`` is taken
        (default: all columns in turn, so that a re-run picks the same one).
        Repeating an insert adds nothing.
        """
        table = TABLES[name]
        given = aligned(df, table)
        stamps = {"ingested_at", "scored_at", "computed_at", "added_at"}
        order = order or [c for c in given.columns if c not in (*table.key, *stamps)]
        self._settle(table)
        staged, _ = self._stage(first_per_full_key(given, table.key, order), table, "insert")
        if _indexed(table):
            return self._unstage(self._insert_by_index(staged, table))
        stored = self.read(name)
        if table.day in table.key:
            stored = self._on_days_of(staged, stored, table)
        return self._unstage(self._write(not_stored(staged, stored, table.key), table))

    def _insert_by_index(self, staged: DataFrame, table: Table) -> int:
        """Insert against the index of keys; the stored rows are not read."""
        index = KeyIndex(self.spark, self.root, table).up_to_date(self.read(table.name))
        fresh, seen = self._stage(index.not_held(staged.withColumn("_key", key_digest(table.key))), table, "fresh", "_key binary")
        if not seen:
            return 0
        index.begin([r[0] for r in fresh.select(table.day).distinct().collect()])
        written = self._write(fresh.drop("_key"), table)
        index.add(fresh)
        index.end()
        return written

    def replace(self, name: str, df: DataFrame, keys: Sequence[str]) -> int:
        """Delete the stored rows with an incoming key, insert all incoming rows; returns how many.

        Only the days that occur in ``df`` are read and rewritten.  Readers see
        all of them replaced or none.
        """
        table = TABLES[name]
        if not keys:
            raise ValueError("replace needs the key columns that say which rows to delete")
        if table.day and table.day not in keys:
            raise ValueError(f"the keys for {name} must include its day column {table.day}")
        self._settle(table)
        incoming, seen = self._stage(aligned(df, table), table, "replace")
        if not seen:
            return 0
        stored = self.read(name)
        if table.day:
            stored = self._on_days_of(incoming, stored, table)
        if _indexed(table):
            KeyIndex(self.spark, self.root, table).outdated()
        beside = f"{self._replacing(table)}/{uuid.uuid4().hex}"
        self._write(replaced(stored, incoming, keys), table, beside)
        self._commit(beside)
        self._settle(table)
        return self._unstage(seen)

    def _commit(self, beside: str) -> None:
        self.files.mark(f"{beside}{COMMITTED}")

    def ready(self) -> bool:
        """Is the instrument dimension set up?"""
        return not self.read("tickers").isEmpty()
