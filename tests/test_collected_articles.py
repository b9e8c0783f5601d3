"""What collecting articles leaves on disk, and which of several rows with one source id stays."""

import os
import random

import pytest
from pyspark.sql import functions as F

from moodtape.operators import articles, dedup
from moodtape.plans import catalog
from moodtape.session import CLEANUP, shared_dir, shuffles_dropped
from moodtape.sources import landing

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def text_of(seed, words=400):
    some = random.Random(seed)
    return " ".join(some.choice(["the", "und", "les", "que", "market", "price", "report", "growing"]) for _ in range(words))


def documents(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def landed(spark):
    return {os.path.join(at, f) for at, _, names in os.walk(f"{shared_dir(spark)}/moodtape") for f in names if f.startswith("part-")}


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_three_kinds_take_less_disk_than_their_texts(spark, tmp_path):
    rows = [(i, text_of(i), "en" if i % 2 else "de", f"s{i % 3}", 1) for i in range(300)]
    before = landed(spark)
    got = catalog.collected_articles(spark, documents(spark, tmp_path, rows))
    assert {r["source"]: r["count"] for r in got.groupBy("source").count().collect()}.items() >= {("google_news", 300), ("yahoo_finance", 300)}
    size = sum(os.path.getsize(f) for f in landed(spark) - before)
    assert 0 < size < sum(len(r[1]) for r in rows) * 1.5  # before: 3.4 times the texts


def test_texts_with_keys_of_their_own_are_not_shuffled(spark, tmp_path):
    rows = [(i, text_of(i, 30), "en", "s", 1) for i in range(20)]
    folder = documents(spark, tmp_path, rows)
    assert "Window" not in plan(catalog.collected_articles(spark, folder))
    again = documents(spark, tmp_path / "again", rows + rows[3:5])
    got = catalog.feed_xml(spark, again)
    assert "Window" in plan(got) and got.count() == 20


def test_feed_titles_do_not_shuffle_the_items(spark, tmp_path):
    folder = tmp_path / "feeds"
    folder.mkdir()
    (folder / "a.xml").write_text("<rss><channel><title>Feed</title><item><title>One</title></item></channel></rss>")
    df = landing.read_feed_items(spark, str(folder))
    assert [r.feed_title for r in df.collect()] == ["Feed"]
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def feed(path, *items):
    path.mkdir(parents=True, exist_ok=True)
    body = "".join(f"<item><title>{t}</title><guid>{g}</guid></item>" for g, t in items)
    (path / f"{len(list(path.iterdir()))}.xml").write_text(f"<rss><channel><title>F</title>{body}</channel></rss>")


def collected(spark, folder, words):
    known = spark.createDataFrame(words, "ticker string, keyword string")
    items = landing.read_feed_items(spark, str(folder))
    df = articles.feed_records(items, known, F.lit("2024-01-30"), F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return sorted(((r.source_id, r.raw_text) for r in df.collect()), key=repr)


def test_the_first_item_of_an_id_stays(spark, tmp_path):
    at = tmp_path / "feeds"
    feed(at, ("a", "Alpha is up, the first text"), ("b", "Beta is up, the only text"), ("a", "Alpha and Beta, second text"))
    feed(at, ("a", "Beta is up in the third text"), ("c", "Alpha and Beta, an only text"))
    # An item is a row for each ticker, so the second text of an id may be the first for its ticker.
    assert collected(spark, at, [("A", "alpha"), ("B", "beta")]) == [
        ("a_A", "Alpha is up, the first text"),
        ("a_B", "Alpha and Beta, second text"),
        ("b_B", "Beta is up, the only text"),
        ("c_A", "Alpha and Beta, an only text"),
        ("c_B", "Alpha and Beta, an only text"),
    ]


def test_source_ids_that_two_ids_share(spark, tmp_path):
    feed(tmp_path, ("a", "Alpha is up, the first text"), ("a_X", "Beta is up, the second text"), ("z", "Alpha is up again today"))
    # a + X_B and a_X + B
    got = collected(spark, tmp_path, [("X_B", "alpha"), ("B", "beta")])
    assert got == [("a_X_B", "Alpha is up, the first text"), ("z_X_B", "Alpha is up again today")]
    # rows without a source id count as one
    got = collected(spark, tmp_path, [(None, "alpha"), ("B", "beta")])
    assert got == [("a_X_B", "Beta is up, the second text"), (None, "Alpha is up, the first text")]


def test_first_of_few_equals_first_per_key(spark):
    rows = [(None if k == 7 else k % 11 if k < 40 else k, k, f"t{k}") for k in range(300)] + [(None, 400, "n")]
    df = spark.createDataFrame(rows, "k int, at int, text string").repartition(5)
    want = dedup.first_per_key(df, ["k"], ["at"])
    got = dedup.first_of_few(df, F.col("k"), lambda some: some, ["k"], ["at"])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_shuffle_files_go_with_the_write_and_the_setting_is_as_before(spark):
    before = spark.conf.get(CLEANUP, None)
    with pytest.raises(ValueError):
        with shuffles_dropped(spark):
            assert spark.conf.get(CLEANUP) == "true"
            raise ValueError
    assert spark.conf.get(CLEANUP, None) == before
