"""Landed files that are not all alike, and input that must not vanish without an error."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodtape.dimensions import seed_keywords
from moodtape.functions.text import clean_html
from moodtape.operators import articles, scoring
from moodtape.sources import landing


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_bar_files_of_two_layouts(spark, tmp_path):
    plain = "Date,Open,High,Low,Close,Volume\n2024-01-02,1,2,0.5,1.5,100\n"
    adjusted = "Date,Close,Adj Close,Open,High,Low,Volume\n2024-01-02,1.5,1.4,1,2,0.5,200\n"
    write(f"{tmp_path}/run_date=2024-01-03/ticker=0005/a.csv", plain)
    write(f"{tmp_path}/run_date=2024-01-03/ticker=M&M/b.csv", adjusted)
    write(f"{tmp_path}/run_date=2024-01-04/ticker=X/c.csv", "nonsense\n1\n")
    rows = landing.read_bar_files(spark, f"{tmp_path}/run_date=2024-01-03", str(tmp_path)).collect()
    assert {(r.ticker, str(r.run_date), r.close, r.adj_close, r.volume) for r in rows} == {
        ("0005", "2024-01-03", 1.5, None, 100),
        ("M&M", "2024-01-03", 1.5, 1.4, 200),
    }


def test_arrays_over_several_lines(spark, tmp_path):
    found = [{"id": "1", "title": "A title long enough to keep", "pubDate": "2024-01-02T03:04:05Z"}]
    write(f"{tmp_path}/ticker=X/a.json", json.dumps(found, indent=2))
    assert landing.read_json_articles(spark, str(tmp_path), multi_line=True).select("id").collect()[0].id == "1"
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        landing.read_json_articles(spark, str(tmp_path)).select("id", "title").collect()


def test_long_ids_that_differ_at_their_end(spark):
    base = "https://example.org/" + "x" * 300
    items = spark.createDataFrame([("T", base + c, "A title long enough to keep " + "w " * 3000, i) for i, c in enumerate("ab")], "ticker string, id string, title string, _nth long")
    kept = items.select(
        "*",
        *[F.lit(None).cast("string").alias(c) for c in ("summary", "description", "link", "guid", "pubDate", "published", "updated")],
        F.lit(None).cast("struct<_VALUE: string>").alias("source"), F.lit("f").alias("file"), F.lit(0).alias("block"),
    )
    rows = articles.ticker_feed_records(kept, F.lit("2024-01-02"), F.lit("2024-01-02").cast("timestamp")).collect()
    assert len(rows) == 2 and all(len(r.raw_text) > 6000 for r in rows)


def no_model():
    raise RuntimeError("no such model")


def half_broken():
    def scorer(texts):
        if "bad" in texts:
            raise ValueError("bad text")
        return np.full((len(texts), 3), 1 / 3)

    return scorer


def test_a_model_that_cannot_be_loaded_fails(spark):
    df = spark.createDataFrame([(1, "text")], "id int, text string")
    with pytest.raises(Exception, match="no such model"):
        scoring.batch_probabilities(df, "text", no_model).collect()


def test_failed_batches_are_counted(spark):
    df = spark.createDataFrame([(i, "bad" if i == 3 else "good") for i in range(8)], "id int, text string").coalesce(1)
    failed = spark.sparkContext.accumulator(0)
    rows = scoring.batch_probabilities(df, "text", half_broken, batch_size=2, failed=failed).collect()
    assert len(rows) == 6 and failed.value == 2 and "text" not in rows[0]


def test_html_without_templates_and_ruby_notes(spark):
    page = "a<template><p>tt</p></template> <ruby>kan<rp>(</rp><rt>ji</rt><rp>)</rp></ruby> b"
    assert spark.range(1).select(clean_html(F.lit(page)).alias("t")).first().t == "a kan b"


ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title type="text">Atom feed</title><id>f</id>
<link href="http://site/"/><entry><title type="html">Tata &amp;amp; co rise a lot today</title><link rel="self" href="http://x/self"/>
<link rel="alternate" href="http://x/1"/><id>urn:1</id><updated>2024-01-02T03:04:05Z</updated><author><name>Ann</name></author>
<summary type="html">&lt;p&gt;Short&lt;/p&gt;</summary></entry><entry><title>Infosys results are out now</title><link href="http://x/2"/>
<published>Fri, 20 Feb 2026 09:00:00 +0530</published><content type="html"><![CDATA[<b>All</b> of it]]></content></entry></feed>"""


def test_atom_entries_beside_feed_items(spark, tmp_path):
    write(f"{tmp_path}/a.xml", ATOM)
    write(f"{tmp_path}/b.xml", "<rss><channel><title>Rss feed</title><item><title>Reliance news of the day</title><link>http://y/1</link></item></channel></rss>")
    items = landing.read_feed_items(spark, str(tmp_path))
    now = F.lit("2026-03-01 12:00:00").cast("timestamp")
    got = {r.source_id: r for r in articles.feed_records(items, seed_keywords(spark), F.lit("2026-02-20"), now).collect()}
    assert set(got) == {"urn:1_TCS", "urn:1_TMCV", "http://x/2_INFY", "http://y/1_RELIANCE"}
    first, second = got["urn:1_TCS"], got["http://x/2_INFY"]
    assert first.raw_text.endswith("co rise a lot today Short") and first.author == "Ann" and first.url == "http://x/1"
    assert second.raw_text == "Infosys results are out now All of it" and second.author == "Atom feed"
    assert str(second.published_at) == "2026-02-20 03:30:00" or second.published_at.day == 20
    assert got["http://y/1_RELIANCE"].author == "Rss feed"


@pytest.mark.parametrize("broken", ["<item><title>Tata never ends</titl></item>", "<item><title>Tata</title><link>x</item>"])
def test_broken_feeds_fail_the_read(spark, tmp_path, broken):
    write(f"{tmp_path}/a.xml", f"<rss><channel><title>F</title><item><title>Good</title></item>{broken}</channel></rss>")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        landing.read_feed_items(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        landing.read_ticker_feed_items(spark, str(tmp_path)).drop("ticker").collect()
