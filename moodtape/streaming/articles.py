"""Continuous forms of ingest, deduplication and the daily roll-up.

Each gives what the batch operator gives on the same rows, as long as no row is
later than its watermark.  Checkpoints and results belong under the shared
folder; a query restarted from its checkpoint goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodtape.operators.daily import MIN_MENTIONS, daily_measures
from moodtape.sources.tables import Tables

def landed(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json", **options) -> DataFrame:
    """A stream over the files that land in a folder."""
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def deduplicated(rows: DataFrame, keys: Sequence[str], event_time: str, spread: str, delay: str = "2 days", salts: int | None = None) -> DataFrame:
    """One row per key among rows at most ``delay`` apart.

    Two steps, so that a key with very many copies does not end up in one task:
    first per (key, salt), the salt taken from the unique column ``spread``,
    then per key over the few rows left.  There are as many salts as shuffle
    partitions unless given.
    """
    salts = salts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    few = salted.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([*keys, "_salt"])
    return few.dropDuplicatesWithinWatermark(list(keys)).drop("_salt")


def daily_windows(scored: DataFrame, event_time: str, delay: str = "1 hour", min_mentions: int = MIN_MENTIONS) -> DataFrame:
    """Daily sentiment over one-day windows (UTC) of the event time.

    In append mode a day comes out once the watermark has passed its end; in
    update mode every change comes out at once, to be written with
    ``replace_days``.  Partial aggregates merge before the shuffle.
    """
    windowed = (
        scored.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, "1 day"), "ticker")
        .agg(*daily_measures())
    )
    measures = windowed.columns[2:]
    # Windows begin at midnight UTC whatever zone the session shows times in.
    utc_day = F.date_from_unix_date(F.floor(F.unix_seconds("window.start") / 86400).cast("int"))
    return windowed.filter(F.col("total_mentions") >= min_mentions).select(
        "ticker", utc_day.alias("sentiment_date"), *measures
    )


def run_available(
    rows: DataFrame,
    checkpoint: str,
    each_batch: Callable[[DataFrame, int], None] | None = None,
    output: str | None = None,
    mode: str = "append",
) -> None:
    """Process everything that has landed, then stop."""
    writer = rows.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint)
    if each_batch is not None:
        query = writer.foreachBatch(each_batch).start()
    else:
        query = writer.format("parquet").option("path", output).start()
    query.awaitTermination()


def insert_batches(root: str, name: str, order: Sequence[str] | None = None) -> Callable[[DataFrame, int], None]:
    """Insert-or-ignore every micro-batch; a replayed batch adds nothing."""

    def write(batch: DataFrame, _: int) -> None:
        Tables(batch.sparkSession, root).insert(name, batch, order)

    return write


def replace_days(root: str, name: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Replace the changed keys of every micro-batch; a replayed batch changes nothing."""

    def write(batch: DataFrame, _: int) -> None:
        Tables(batch.sparkSession, root).replace(name, batch, keys)

    return write
