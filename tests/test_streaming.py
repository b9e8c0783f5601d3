"""Streams against the batch operators on the same rows."""

import datetime as dt

from pyspark.sql import functions as F

from moodtape.operators import daily
from moodtape.session import shared_dir, work_path
from moodtape.sources import landing, star
from moodtape.sources.tables import Tables
from moodtape.streaming import articles as streams
from tests.conftest import rows

SCORED = (
    "ts timestamp, ticker string, source string, upvotes int, score_positive double, score_negative double, "
    "score_neutral double, compound_score double"
)


def land(spark, folder, name, items):
    data = [(dt.datetime(2026, 1, d, h), t, "news", 1, 0.6, 0.2, 0.2, 0.4) for d, h, t in items]
    spark.createDataFrame(data, SCORED).coalesce(1).write.mode("append").json(f"{folder}/{name}")


def source(spark, folder):
    return streams.landed(spark, folder, SCORED, recursiveFileLookup="true")


def in_batch(spark, folder):
    df = spark.read.schema(SCORED).option("recursiveFileLookup", "true").json(folder)
    return daily.daily_sentiment(df.withColumn("scored_date", F.to_date("ts")))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_days_come_out_once_closed_and_equal_the_batch(spark, tmp_path):
    folder, out, check = str(tmp_path / "in"), str(tmp_path / "out"), work_path(spark, "check")
    for part in ([(1, 9, "A"), (1, 10, "A"), (1, 11, "B")], [(2, 9, "A"), (2, 23, "A"), (1, 23, "B")], [(5, 9, "A")]):
        land(spark, folder, f"f{len(part)}{part[0][0]}", part)
        streams.run_available(streams.daily_windows(source(spark, folder), "ts", "2 days"), check, output=out)
    got = spark.read.parquet(out)
    expect = in_batch(spark, folder).filter("sentiment_date <= date'2026-01-02'")
    assert rows(got) == rows(expect.select(*got.columns)) and got.count() == 3


def test_changed_days_are_replaced_and_late_articles_counted(spark, tmp_path):
    folder, check = str(tmp_path / "in"), work_path(spark, "check")
    tables = Tables(spark, str(tmp_path / "t")).create("daily_sentiment")
    write = streams.replace_days(tables.root, "daily_sentiment", ["ticker", "sentiment_date"])
    for i, part in enumerate([[(1, 9, "A"), (1, 10, "A"), (2, 11, "B")], [(2, 9, "B"), (1, 23, "A")], [(3, 1, "C"), (3, 2, "C")]]):
        land(spark, folder, f"f{i}", part)
        streams.run_available(streams.daily_windows(source(spark, folder), "ts", "7 days"), check, each_batch=write, mode="update")
        stored = tables.read("daily_sentiment").drop("computed_at")
        assert rows(stored) == rows(in_batch(spark, folder).select(*stored.columns))


def test_each_key_once_across_batches(spark, tmp_path):
    folder, out, check = str(tmp_path / "in"), str(tmp_path / "out"), work_path(spark, "check")
    schema = "source string, source_id string, ticker string, published_at timestamp, n int"

    def article(i, n):
        return ("news", i, "A", dt.datetime(2026, 1, 1, 9), n)

    for k, part in enumerate([[article("1", 1), article("1", 2), article("2", 3)], [article("1", 4), article("3", 5)]]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").json(f"{folder}/{k}")
        stream = streams.landed(spark, folder, schema, recursiveFileLookup="true")
        once = streams.deduplicated(stream, ["source", "source_id", "ticker"], "published_at", spread="n")
        streams.run_available(once, check, output=out)
    assert sorted(r["source_id"] for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]


def test_ingest_equals_batch_insert_and_replays_add_nothing(spark, sf, tmp_path):
    raw = star.raw_articles(spark, sf).drop("id").withColumn("published_at", F.col("published_at").cast("timestamp"))
    folder = str(tmp_path / "in")
    landing.write_article_records(raw, folder)
    schema = "source string, source_id string, ticker string, published_at timestamp, collected_date date, raw_text string, author string, upvotes int, url string"
    tables = Tables(spark, str(tmp_path / "t")).create("raw_sentiment")
    order = ["published_at"]
    for _ in range(2):  # a new checkpoint replays everything
        stream = streams.landed(spark, folder, schema)
        streams.run_available(stream, work_path(spark, "check"), each_batch=streams.insert_batches(tables.root, "raw_sentiment", order))
    batch = Tables(spark, str(tmp_path / "b")).create("raw_sentiment")
    batch.insert("raw_sentiment", raw, order)
    assert rows(tables.read("raw_sentiment").drop("ingested_at")) == rows(batch.read("raw_sentiment").drop("ingested_at"))
