import random
import re

import pytest
from pyspark.sql import functions as F

from moodtape.dimensions import keywords_or_ticker, seed_keywords, seed_tickers
from moodtape.operators import matching

WORDS = ["tata", "TCS", "M&M", "Jio", "BAJAJ-AUTO", "bajaj", "auto", "Sun", "Pharma", "(x)", "C++", "$", "a_b", "é", "SBI's"]
GLUE = [" ", " ", "-", "&", ", ", "", ".", "'", "\n", " & "]


def by_regex(texts, pairs):
    found = set()
    for i, t in texts:
        for ticker, keyword in pairs:
            if keyword and re.search(r"\b" + re.escape(keyword.upper()) + r"\b", (t or "").upper()):
                found.add((i, ticker))
    return found


def random_texts(n, seed):
    rng = random.Random(seed)
    return [
        (i, "".join(rng.choice(WORDS) + rng.choice(GLUE) for _ in range(rng.randrange(0, 12)))) for i in range(n)
    ] + [(n, None), (n + 1, "")]


def random_keywords(seed):
    rng = random.Random(seed)
    pairs = [("T%d" % i, w) for i, w in enumerate(WORDS)]
    pairs += [("P%d" % i, rng.choice(WORDS) + rng.choice(GLUE) + rng.choice(WORDS)) for i in range(40)]
    pairs += [("Q", "&M"), ("Q", "M&"), ("R", "tata "), ("S", " tata"), ("U", "tata"), ("E", "")]
    return sorted(set(pairs))


def test_random_texts_equal_the_regular_expression(spark):
    texts, pairs = random_texts(200, 3), random_keywords(5)
    df = spark.createDataFrame(texts, "id int, raw_text string")
    keywords = spark.createDataFrame(pairs, "ticker string, keyword string").repartition(3)
    got = matching.with_tickers(df, keywords).select("id", "ticker").collect()
    assert len(got) == len(set(map(tuple, got)))
    assert {tuple(r) for r in got} == by_regex(texts, pairs)


def test_copies_of_one_text_are_all_matched(spark):
    texts = [(i if i % 5 else None, "Jio and Tata" if i % 3 else "Infosys") for i in range(90)]
    df = spark.createDataFrame(texts, "id int, raw_text string")
    got = [tuple(r) for r in matching.with_tickers(df, seed_keywords(spark)).select("id", "ticker").collect()]
    expect = [(i, t) for i, text in texts for t in (("RELIANCE", "TCS", "TMCV") if text.startswith("Jio") else ("INFY",))]
    assert sorted(got, key=repr) == sorted(expect, key=repr)


def test_default_dictionary(spark):
    texts = [
        (1, "Reliance and Jio rise"),
        (2, "Mahindra & Mahindra beats"),
        (3, "Tata gains"),
        (4, "tatami mats"),
        (5, "HULK smash"),
    ]
    df = spark.createDataFrame(texts, "id int, raw_text string")
    got = {tuple(r) for r in matching.with_tickers(df, seed_keywords(spark)).select("id", "ticker").collect()}
    assert got == {(1, "RELIANCE"), (2, "M&M"), (3, "TCS"), (3, "TMCV")}


def test_no_keywords_no_rows(spark):
    df = spark.createDataFrame([(1, "x")], "id int, raw_text string")
    none = spark.createDataFrame([], "ticker string, keyword string")
    assert matching.with_tickers(df, none).count() == 0


def test_plan_does_not_grow_with_the_dictionary(spark):
    df = spark.createDataFrame([(1, "word7 and word4999"), (2, None)], "id int, raw_text string")
    plans = []
    for n in (10, 5000):
        keywords = spark.createDataFrame([(f"T{i}", f"word{i}") for i in range(n)], "ticker string, keyword string")
        found = matching.with_tickers(df, keywords)
        plans.append(len(found._jdf.queryExecution().optimizedPlan().toString()))
    assert plans[0] == pytest.approx(plans[1], rel=0.05)
    assert {r.ticker for r in found.collect()} == {"T7", "T4999"}


def test_ticker_without_keywords_is_searched_by_its_code(spark):
    tickers = spark.createDataFrame([("AAA",), ("BBB",)], "ticker string")
    keywords = spark.createDataFrame([("AAA", "alpha")], "ticker string, keyword string")
    got = {tuple(r) for r in keywords_or_ticker(tickers, keywords).collect()}
    assert got == {("AAA", "alpha"), ("BBB", "BBB")}


def test_seed_dimension(spark):
    rows = {r["ticker"]: r for r in seed_tickers(spark).collect()}
    assert len(rows) == 25
    assert rows["NTPC"]["sector"] == rows["ADANIGREEN"]["sector"] == "Utilities"
    assert all(r["is_active"] and r["exchange"] == "NSE" for r in rows.values())


@pytest.mark.parametrize("limits", [{"in_place": 0}, {"in_place": 0, "broadcast_bytes": 0}])
def test_larger_dictionaries_are_joined(spark, limits):
    texts, pairs = random_texts(200, 3), random_keywords(5)
    df = spark.createDataFrame(texts, "id int, raw_text string")
    keywords = spark.createDataFrame(pairs, "ticker string, keyword string").repartition(3)
    got = matching.with_tickers(df, keywords, **limits).select("id", "ticker").collect()
    assert len(got) == len(set(map(tuple, got)))
    assert {tuple(r) for r in got} == by_regex(texts, pairs)


def plan_with(spark, sf, n, **limits):
    keywords = spark.createDataFrame([(f"T{i}", f"word{i} of" if i % 9 == 0 else f"word{i}") for i in range(n)], "ticker string, keyword string")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text").alias("raw_text"))
    found = matching.with_tickers(docs, keywords, **limits)
    return found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [5, 5000])
def test_texts_stay_where_they_are(spark, sf, n):
    plan = plan_with(spark, sf, n)
    assert "Join" not in plan
    # Above the scan of the texts there is no exchange; those of the dictionary are in subqueries.
    path, depth = [], None
    for line in reversed(plan.splitlines()):
        at = len(line) - len(line.lstrip(" :+-|*"))
        if "FileScan" in line:
            path, depth = [line], at
        elif depth is not None and at < depth:
            path.append(line)
            depth = at
    assert path and not any("Exchange" in line for line in path), path


def test_texts_are_never_the_built_side(spark, sf):
    for limits, built in (({"in_place": 0}, "BuildRight"), ({"in_place": 0, "broadcast_bytes": 0}, None)):
        plan = plan_with(spark, sf, 50, **limits)
        assert "BuildLeft" not in plan
        assert ("BroadcastHashJoin" in plan) == (built is not None)
        assert "SortMergeJoin" in plan


def test_only_grams_that_may_be_keywords_are_joined(spark, tmp_path):
    long = [f"extraordinary{i}" for i in range(40)]
    texts = [(i, " ".join([f"w{i}x{k}" for k in range(200)] + long[i % 40 : i % 40 + 2])) for i in range(50)]
    df = spark.createDataFrame(texts, "id int, raw_text string")
    keywords = spark.createDataFrame([(f"T{i}", w) for i, w in enumerate(long)], "ticker string, keyword string")
    found = matching.with_tickers(df, keywords, in_place=0, broadcast_bytes=0)
    assert {(r.id, r.ticker) for r in found.collect()} == {(i, f"T{k}") for i, _ in texts for k in (i % 40, i % 40 + 1) if k < 40}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "{14,15}+" in plan  # the 200 short words of a text go where they are found


@pytest.mark.parametrize("limits", [{}, {"in_place": 0}, {"in_place": 0, "broadcast_bytes": 0}])
def test_runs_are_as_long_as_those_of_the_keywords(spark, limits):
    texts = [(i, t) for i, t in enumerate(["abcd", "abc", "xabc", "abc-x", "ab", "a&b", "xa&b", "a&bc", "abcdef & abc", "é", "éé", "--", "x--x", "x-x"])]
    pairs = [("A", "abc"), ("B", "a&b"), ("C", "éé"), ("D", "--"), ("E", "abcdef & abc")]
    df = spark.createDataFrame(texts, "id int, raw_text string")
    for some in (pairs, pairs[:1], pairs[1:2], pairs[3:4], pairs[4:]):
        keywords = spark.createDataFrame(some, "ticker string, keyword string")
        got = matching.with_tickers(df, keywords, **limits).select("id", "ticker").collect()
        assert {tuple(r) for r in got} == by_regex(texts, some)
