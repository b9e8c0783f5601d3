import datetime as dt

import pytest
from pyspark.sql import functions as F

from moodtape.operators import dedup, scoring
from moodtape.schemas import TABLES
from moodtape.sources.files import Files
from moodtape.sources.keys import KeyIndex, key_digest
from moodtape.sources.tables import Tables
from tests.conftest import rows

DAY = dt.date(2026, 1, 5)
RAW = "source string, source_id string, ticker string, collected_date date, raw_text string, url string"


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "tables")).create()


def raw(spark, *items):
    return spark.createDataFrame([(s, i, t, DAY, text, url) for s, i, t, text, url in items], RAW)


def test_insert_keeps_the_first_and_repeats_add_nothing(spark, tables):
    batch = raw(spark, ("news", "1", "A", "first", "1"), ("news", "1", "A", "second", "2"), ("news", "2", "A", "x", "3"))
    assert tables.insert("raw_sentiment", batch, ["url"]) == 2
    assert tables.insert("raw_sentiment", batch, ["url"]) == 0
    later = raw(spark, ("news", "1", "A", "changed", "0"), ("news", "1", "B", "other ticker", "4"))
    assert tables.insert("raw_sentiment", later, ["url"]) == 1
    got = rows(tables.read("raw_sentiment").select("source_id", "ticker", "raw_text"))
    assert got == [("1", "A", "first"), ("1", "B", "other ticker"), ("2", "A", "x")]


def test_rows_without_a_full_key_never_conflict(spark, tables):
    batch = raw(spark, ("news", None, "A", "one", "1"), ("news", None, "A", "two", "2"))
    assert tables.insert("raw_sentiment", batch) == 2
    assert tables.insert("raw_sentiment", batch) == 2
    ids = {r["id"] for r in tables.read("raw_sentiment").collect()}
    assert len(ids) == 2  # the same article has the same id on every run


def test_defaults_and_ids(spark, tables):
    tables.insert("raw_sentiment", raw(spark, ("news", "1", "A", "text", None)))
    row = tables.read("raw_sentiment").first()
    assert row["upvotes"] == 0 and row["ingested_at"] is not None and len(row["id"]) == 32
    assert row["collected_date"] == DAY


def test_missing_values_are_refused(spark, tables):
    with pytest.raises(Exception, match="NULL in raw_sentiment.raw_text"):
        tables.append("raw_sentiment", raw(spark, ("news", "1", "A", None, None)))


def daily_rows(spark, *items):
    return spark.createDataFrame(
        [(t, DAY + dt.timedelta(days=d), n) for t, d, n in items], "ticker string, sentiment_date date, total_mentions int"
    )


def shown(tables):
    return rows(
        tables.read("daily_sentiment").select("ticker", F.datediff("sentiment_date", F.lit(DAY)).alias("d"), "total_mentions")
    )


def test_replace_by_key(spark, tables):
    keys = ["ticker", "sentiment_date"]
    assert tables.append("daily_sentiment", daily_rows(spark, ("A", 0, 1), ("B", 0, 2), ("A", 1, 3))) == 3
    change = daily_rows(spark, ("A", 0, 10), ("A", 0, 11), ("C", 2, 5))
    for _ in range(2):  # the second time changes nothing
        assert tables.replace("daily_sentiment", change, keys) == 3
        assert shown(tables) == [("A", 0, 10), ("A", 0, 11), ("A", 1, 3), ("B", 0, 2), ("C", 2, 5)]
    assert tables.replace("daily_sentiment", change.limit(0), keys) == 0
    assert len(shown(tables)) == 5


def test_replace_rewrites_only_the_days_it_touches(spark, tables, tmp_path):
    tables.append("daily_sentiment", daily_rows(spark, ("A", 0, 1), ("A", 1, 3)))
    other = tmp_path / "tables" / "daily_sentiment" / f"sentiment_date={DAY + dt.timedelta(days=1)}"
    before = sorted(p.name for p in other.iterdir())
    tables.replace("daily_sentiment", daily_rows(spark, ("A", 0, 9)), ["ticker", "sentiment_date"])
    assert sorted(p.name for p in other.iterdir()) == before
    assert shown(tables) == [("A", 0, 9), ("A", 1, 3)]


def test_replace_needs_keys(spark, tables):
    change = daily_rows(spark, ("A", 0, 1))
    with pytest.raises(ValueError):
        tables.replace("daily_sentiment", change, [])
    with pytest.raises(ValueError):
        tables.replace("daily_sentiment", change, ["ticker"])


def test_replace_in_the_undated_table(spark, tables):
    one = spark.createDataFrame([("TCS", "New name")], "ticker string, company_name string")
    assert tables.replace("tickers", one, ["ticker"]) == 1
    got = {r["ticker"]: r["company_name"] for r in tables.read("tickers").collect()}
    assert len(got) == 25 and got["TCS"] == "New name"


def test_create_is_repeatable(tables):
    tables.create()
    assert tables.ready() and tables.read("tickers").count() == 25


def test_append_rows_and_sql(spark, tables):
    assert tables.append_rows("price_daily", [], ["ticker"]) == 0
    n = tables.append_rows(
        "price_daily", [("A", DAY, 5.0, 1.5), ("A", DAY + dt.timedelta(days=1), 6.0, 2.5)], ["ticker", "trade_date", "close_price", "pct_change"]
    )
    assert n == 2
    tables.append("daily_sentiment", daily_rows(spark, ("A", 0, 1), ("A", 1, 3)))
    got = tables.query("SELECT date, next_day_return FROM vw_sentiment_price WHERE ticker = ? ORDER BY date", ["A"]).collect()
    assert [r["next_day_return"] for r in got] == [2.5, None]
    named = tables.query("SELECT count(*) n FROM price_daily WHERE close_price > :low", {"low": 5.5}).first()
    assert named["n"] == 1
    assert tables.query("SELECT * FROM vw_latest_correlations").count() == 0
    assert tables.query("SELECT * FROM vw_sector_sentiment").count() == 0


class Killed(Exception):
    pass


def dies(monkeypatch, owner, method, after=0):
    """The method raises once it was called ``after`` times."""
    real, calls = getattr(owner, method), []

    def call(self, *args):
        calls.append(args)
        if len(calls) > after:
            raise Killed
        return real(self, *args)

    monkeypatch.setattr(owner, method, call)


def test_a_replacement_is_all_or_nothing(spark, tables, monkeypatch):
    keys = ["ticker", "sentiment_date"]
    tables.append("daily_sentiment", daily_rows(spark, ("A", 0, 1), ("A", 1, 2), ("A", 2, 3), ("B", 3, 4)))
    old, change = shown(tables), daily_rows(spark, ("A", 0, 10), ("A", 1, 20), ("A", 2, 30))
    new = [("A", 0, 10), ("A", 1, 20), ("A", 2, 30), ("B", 3, 4)]
    with monkeypatch.context() as m:
        dies(m, Tables, "_commit")
        with pytest.raises(Killed):
            tables.replace("daily_sentiment", change, keys)
    assert shown(tables) == shown(Tables(spark, tables.root)) == old
    with monkeypatch.context() as m:
        dies(m, Files, "move", after=1)  # between two days
        with pytest.raises(Killed):
            tables.replace("daily_sentiment", change, keys)
    assert shown(tables) == shown(Tables(spark, tables.root)) == new
    # the next writer finishes it
    assert tables.replace("daily_sentiment", daily_rows(spark, ("C", 4, 5)), keys) == 1
    assert shown(tables) == [*new, ("C", 4, 5)]
    assert Files(spark).names(f"{tables.root}/_replacing") == []


def test_a_replacement_of_an_undated_table_is_all_or_nothing(spark, tables, monkeypatch):
    one = spark.createDataFrame([("TCS", "New name")], "ticker string, company_name string")
    with monkeypatch.context() as m:
        dies(m, Files, "move")
        with pytest.raises(Killed):
            tables.replace("tickers", one, ["ticker"])
    got = {r["ticker"]: r["company_name"] for r in tables.read("tickers").collect()}
    assert len(got) == 25 and got["TCS"] == "New name"
    assert tables.replace("tickers", spark.createDataFrame([("XX", "Y")], one.schema), ["ticker"]) == 1
    assert tables.read("tickers").count() == 26


@pytest.mark.parametrize("owner, method", [(KeyIndex, "add"), (Tables, "_write"), (KeyIndex, "end")])
def test_a_broken_insert_is_made_good(spark, tables, monkeypatch, owner, method):
    tables.insert("raw_sentiment", raw(spark, ("news", "1", "A", "x", "1")))
    batch = raw(spark, ("news", "1", "A", "x", "1"), ("news", "2", "A", "y", "2"), ("news", None, "A", "z", "3"))
    with monkeypatch.context() as m:
        dies(m, owner, method)
        with pytest.raises(Killed):
            tables.insert("raw_sentiment", batch.where("source_id IS NOT NULL"))
    tables.insert("raw_sentiment", batch)
    got = rows(tables.read("raw_sentiment").select("source_id"))
    assert got == sorted([("1",), ("2",), (None,)], key=repr)


def test_the_index_follows_other_writers(spark, tables):
    tables.insert("raw_sentiment", raw(spark, ("news", "1", "A", "x", "1")))
    tables.append("raw_sentiment", raw(spark, ("news", "2", "A", "appended", "2")))
    assert tables.insert("raw_sentiment", raw(spark, ("news", "2", "A", "x", "1"), ("news", "3", "A", "x", "1"))) == 1
    tables.replace("raw_sentiment", raw(spark, ("news", "4", "A", "replaced", "2")), ["source", "collected_date"])
    assert tables.insert("raw_sentiment", raw(spark, ("news", "1", "A", "x", "1"), ("news", "4", "A", "x", "1"))) == 1
    again = Tables(spark, tables.root)  # another session knows the index by its folder
    assert again.insert("raw_sentiment", raw(spark, ("news", "1", "A", "x", "1"), ("news", "5", "A", "x", "1"))) == 1
    assert rows(again.read("raw_sentiment").select("source_id")) == [("1",), ("4",), ("5",)]


def test_the_index_is_joined_without_a_shuffle_of_it(spark, tables):
    tables.insert("raw_sentiment", raw(spark, *[("news", str(i), "A", "x", "1") for i in range(500)]))
    index = KeyIndex(spark, tables.root, TABLES["raw_sentiment"])
    incoming = raw(spark, *[("news", str(i), "A", "x", "1") for i in range(490, 600)]).withColumn("_key", key_digest(index.table.key))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = index.not_held(incoming)
        plan = fresh._jdf.queryExecution().executedPlan().toString().splitlines()
        assert fresh.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line and "Bucketed: true" in line)
    depth, above = len(plan[scan]) - len(plan[scan].lstrip(" :+-*(0123456789)")), []
    for line in reversed(plan[:scan]):
        at = len(line) - len(line.lstrip(" :+-*(0123456789)"))
        if at < depth:
            above.append(line)
            depth = at
    assert any("Join" in line for line in above) and not any("Exchange" in line for line in above), above


def test_key_digests_tell_neighbouring_parts_apart(spark):
    pairs = [("a", "bc"), ("ab", "c"), ("", "abc"), ("1:a", "b"), (None, "x")]
    found = spark.createDataFrame(pairs, "x string, y string").select(key_digest(("x", "y")).alias("k")).collect()
    assert len({bytes(r.k) for r in found if r.k is not None}) == 4 and found[4].k is None


def test_replaced_frame_leaves_null_keys(spark):
    old = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    new = spark.createDataFrame([(None, 3), ("a", 4)], "k string, v int")
    assert rows(dedup.replaced(old, new, ["k"])) == sorted([(None, 1), (None, 3), ("a", 4)], key=repr)


def test_a_key_with_a_third_of_all_rows(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    got = dedup.first_per_key(df, ["k"], [F.desc("id")])
    assert got.count() == 20_001
    assert got.filter("k = 'hot'").first()["id"] == 29_997


# --- scoring -------------------------------------------------------------------------------------


def stored_raw(spark, tables, texts):
    tables.insert("raw_sentiment", raw(spark, *[("news", str(i), "A", t, str(i)) for i, t in enumerate(texts)]))


def test_only_long_unscored_texts_are_scored(spark, tables):
    stored_raw(spark, tables, ["x" * 15, "x" * 16, "profits surge to a record", "https://only.an/address/here"])
    first = scoring.score_articles(tables.read("raw_sentiment"), tables.read("sentiment_scored"), DAY.isoformat())
    assert tables.append("sentiment_scored", first) == 2
    again = scoring.score_articles(tables.read("raw_sentiment"), tables.read("sentiment_scored"), DAY.isoformat())
    assert again.count() == 0
    got = {r["label"] for r in tables.read("sentiment_scored").collect()}
    assert got == {"positive", "neutral"}
    for r in tables.read("sentiment_scored").collect():
        assert abs(r["score_positive"] + r["score_negative"] + r["score_neutral"] - 1) < 0.001
        assert -1 <= r["compound_score"] <= 1
    other_day = scoring.score_articles(tables.read("raw_sentiment"), tables.read("sentiment_scored").limit(0), "2026-01-06")
    assert other_day.count() == 0


def test_labels_and_ties(spark):
    df = spark.createDataFrame(
        [(1, 0.4, 0.4, 0.2), (2, 0.2, 0.4, 0.4), (3, 0.3, 0.3, 0.4), (4, 0.12345, 0.5, 0.37655)],
        "i int, p_positive double, p_negative double, p_neutral double",
    )
    got = {r["i"]: r for r in scoring.scores(df).collect()}
    assert [got[i]["label"] for i in (1, 2, 3, 4)] == ["positive", "negative", "neutral", "negative"]
    assert got[4]["confidence"] == 0.5 and got[4]["compound_score"] == -0.3766


def failing_model():
    import numpy as np

    def scorer(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("model failed")
        return np.array([[0.7, 0.2, 0.1]] * len(texts))

    return scorer


def test_a_failed_batch_stays_unscored(spark):
    df = spark.createDataFrame([(i, "bad text" if i == 5 else "good text") for i in range(40)], "i int, t string").coalesce(1)
    got = scoring.batch_probabilities(df, "t", failing_model, batch_size=16).collect()
    assert sorted(r["i"] for r in got) == list(range(16, 40))
    assert scoring.scores(scoring.batch_probabilities(df.filter("i > 20"), "t", failing_model)).first()["compound_score"] == 0.5
