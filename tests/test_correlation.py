import datetime as dt
import math
import random

import pytest

from moodtape.operators import bars, correlation, daily
from moodtape.plans import views

DAY0 = dt.date(2026, 1, 1)


def day(i):
    return DAY0 + dt.timedelta(days=i)


def half_up(x, n):
    return None if x is None else math.copysign(math.floor(abs(x) * 10**n + 0.5) / 10**n, x) + 0.0


def corr(pairs):
    pairs = [(x, y) for x, y in pairs if x is not None and y is not None]
    n = len(pairs)
    if n < 2:
        return None
    mx, my = sum(x for x, _ in pairs) / n, sum(y for _, y in pairs) / n
    vx, vy = sum((x - mx) ** 2 for x, _ in pairs), sum((y - my) ** 2 for _, y in pairs)
    if vx < 1e-18 or vy < 1e-18:
        return None
    return sum((x - mx) * (y - my) for x, y in pairs) / math.sqrt(vx * vy)


def mean(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


def by_hand(sent, price, end, lookback):
    """The analysis of one date, row by row."""
    out = {}
    for ticker in {t for t, _ in sent}:
        days = sorted(d for t, d in sent if t == ticker and (t, d) in price and end - dt.timedelta(days=lookback) <= d <= end)
        xs, ys = [sent[ticker, d] for d in days], [price[ticker, d] for d in days]
        full = [i for i in range(len(days)) if xs[i] is not None and ys[i] is not None]
        if len(full) < 10:
            continue
        r = [half_up(corr([(xs[i - k] if i >= k else None, ys[i]) for i in full]), 6) for k in (0, 1, 2, 3, 7)]
        rolls = [half_up(mean([mean(s[max(0, i - 29) : i + 1]) for i in full]), 4) for s in (xs, ys)]
        out[ticker] = (*r, *rolls, len(full))
    return out


def random_market(seed, tickers=4, days=80):
    rng = random.Random(seed)
    sent, price = {}, {}
    for t in range(tickers):
        for i in range(days):
            if rng.random() < 0.85:
                sent[f"T{t}", day(i)] = None if rng.random() < 0.05 else round(rng.uniform(-1, 1), 4)
            if day(i).weekday() < 5 and rng.random() < 0.95:
                price[f"T{t}", day(i)] = None if rng.random() < 0.05 else round(rng.gauss(0, 2), 4)
    for i in range(30):
        sent["FLAT", day(i)] = 0.1
        price["FLAT", day(i)] = round(rng.gauss(0, 2), 4)
    for i in range(9):
        sent["NINE", day(i)] = price["NINE", day(i)] = float(i)
    return sent, price


def frames(spark, sent, price):
    daily_rows = spark.createDataFrame(
        [(t, d, x) for (t, d), x in sent.items()], "ticker string, sentiment_date date, avg_sentiment_score double"
    )
    prices = spark.createDataFrame(
        [(t, d, y) for (t, d), y in price.items()], "ticker string, trade_date date, pct_change double"
    )
    return daily_rows, prices


@pytest.mark.parametrize("lookback,end", [(90, 79), (40, 79), (25, 33), (5, 20)])
def test_one_date(spark, lookback, end):
    sent, price = random_market(2)
    got = correlation.lag_correlation(*frames(spark, sent, price), day(end).isoformat(), lookback).collect()
    assert {r["ticker"]: tuple(r)[2:] for r in got} == by_hand(sent, price, day(end), lookback)
    assert all(r["analysis_date"] == day(end) for r in got)


def test_backfill_equals_every_single_date(spark):
    sent, price = random_market(11)
    found = correlation.backfill_correlation(
        *frames(spark, sent, price), day(10).isoformat(), day(79).isoformat(), 35
    ).collect()
    expect = {(t, day(i)): v for i in range(10, 80) for t, v in by_hand(sent, price, day(i), 35).items()}
    assert {(r["ticker"], r["analysis_date"]): tuple(r)[2:] for r in found} == expect
    assert len(found) == len(expect)


@pytest.mark.parametrize("lookback", [0, 9, 60, 400])
def test_backfill_at_other_lookbacks(spark, lookback):
    sent, price = random_market(12, days=70)
    found = correlation.backfill_correlation(*frames(spark, sent, price), day(20).isoformat(), day(75).isoformat(), lookback).collect()
    expect = {(t, day(i)): v for i in range(20, 76) for t, v in by_hand(sent, price, day(i), lookback).items()}
    assert {(r["ticker"], r["analysis_date"]): tuple(r)[2:] for r in found} == expect


def test_backfill_rows_do_not_grow_with_the_lookback(spark):
    sent, price = random_market(13, tickers=6, days=200)
    made = []
    for lookback in (30, 120):
        found = correlation.backfill_correlation(*frames(spark, sent, price), day(140).isoformat(), day(199).isoformat(), lookback)
        found.collect()
        nodes = found._jdf.queryExecution().executedPlan().toString()
        assert nodes.count("Generate explode") >= 1
        made.append(generated_rows(found))
    assert max(made) <= 2 * 6 * 60 + 2 * 60  # two for a ticker and date


def generated_rows(df):
    """How many rows the plan's Generate made."""
    waiting, most = [df._jdf.queryExecution().executedPlan()], 0
    while waiting:
        node = waiting.pop()
        if node.nodeName() == "Generate":
            most = max(most, node.metrics().get("numOutputRows").get().value())
        inner = node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.plan() if "QueryStage" in node.nodeName() else None
        below = [inner] if inner is not None else [node.children().apply(i) for i in range(node.children().size())]
        waiting += below
    return most


def best(spark, *r):
    df = spark.createDataFrame([r], ", ".join(f"corr_lag_{k}d double" for k in (0, 1, 2, 3, 7)))
    row = correlation.optimal_lag(df).first()
    return row["optimal_lag_days"], row["optimal_lag_corr"]


def test_optimal_lag(spark):
    assert best(spark, 0.1, 0.2, -0.9, 0.3, 0.4) == (2, -0.9)
    assert best(spark, 0.5, -0.5, 0.5, 0.5, -0.5) == (0, 0.5)
    assert best(spark, None, 0.3, float("nan"), -0.3, None) == (1, 0.3)
    assert best(spark, None, None, None, None, None) == (0, 0.0)
    assert best(spark, 0.0, 0.0, 0.0, 0.0, 0.0) == (0, 0.0)


def test_largest_samples_breaks_ties_by_ticker(spark):
    df = spark.createDataFrame([(t, n) for t, n in zip("fedcba", (9, 9, 9, 9, 9, 12))], "ticker string, sample_size int")
    assert [r["ticker"] for r in correlation.largest_samples(df).collect()] == ["a", "b", "c", "d", "e"]


# --- bars ---------------------------------------------------------------------------------


def test_price_rows(spark):
    raw = [
        ("A", day(0), 1.0, 2.0, 1.0, 2.0, 10),
        ("A", day(1), 1.0, 3.0, 2.0, 3.0, None),
        ("A", day(2), 1.0, 3.0, 0.0, 0.0, 5),
        ("A", day(3), 1.0, 3.0, 1.0, 4.0, 5),
        ("B", day(0), 1.0, 3.0, 1.0, 4.0, 5),
    ]
    df = spark.createDataFrame(raw, "ticker string, date date, open double, high double, low double, close double, volume long")
    got = {r["trade_date"]: r for r in bars.price_rows(df).collect()}
    assert set(got) == {day(1), day(2)}  # first bars and the change from a zero close are dropped
    assert got[day(1)]["pct_change"] == 50.0 and got[day(1)]["volume"] == 0 and got[day(1)]["intraday_range"] == 50.0
    assert got[day(2)]["pct_change"] == -100.0 and got[day(2)]["intraday_range"] is None
    assert got[day(1)]["adj_close"] == 3.0


def test_collect_prices_keeps_from_the_lookback_without_upper_bound(spark):
    raw = [("A", day(i), 1.0, 2.0, 1.0, float(i + 1), 1) for i in range(12)]
    df = spark.createDataFrame(raw, "ticker string, date date, open double, high double, low double, close double, volume long")
    run = day(8).isoformat()
    kept = sorted(r["trade_date"] for r in bars.collect_prices(df, run, 2).collect())
    assert kept == [day(7), day(8), day(9), day(10), day(11)]
    bounded = sorted(r["trade_date"] for r in bars.collect_prices(df, run, 1, keep_to=run).collect())
    assert bounded == [day(8)]


# --- daily roll-up --------------------------------------------------------------------------

SCORED = "raw_id string, ticker string, source string, upvotes int, scored_date date, " + ", ".join(
    f"{c} double" for c in ("score_positive", "score_negative", "score_neutral", "compound_score")
)


def test_daily_sentiment(spark):
    rows = [
        ("1", "A", "news", 0, day(0), 0.6, 0.2, 0.2, 0.4),
        ("2", "A", "google_news", 3, day(0), 0.1, 0.7, 0.2, -0.6),
        ("3", "B", "news", 0, day(0), 0.6, 0.2, 0.2, 0.4),
        ("4", "C", "blog", 0, day(0), 0.6, 0.2, 0.2, 0.4),
        ("5", "C", "blog", 0, day(0), 0.6, 0.2, 0.2, 0.4),
    ]
    got = {r["ticker"]: r for r in daily.daily_sentiment(spark.createDataFrame(rows, SCORED)).collect()}
    assert set(got) == {"A", "C"}  # one article is not enough
    a = got["A"]
    assert (a["total_mentions"], a["news_mentions"], a["google_news_mentions"], a["yahoo_finance_mentions"]) == (2, 1, 1, 0)
    assert a["avg_sentiment_score"] == -0.1 and a["engagement_weighted_score"] == -0.6
    assert a["sentiment_std"] == half_up(math.sqrt(0.5), 4)
    assert got["C"]["engagement_weighted_score"] is None  # no upvotes, no weight
    raw = spark.createDataFrame([(str(i), "news", 7) for i in range(1, 6)], "id string, source string, upvotes int")
    joined = {r["ticker"]: r for r in daily.daily_sentiment(spark.createDataFrame(rows, SCORED), raw).collect()}
    assert joined["C"]["news_mentions"] == 2 and joined["C"]["engagement_weighted_score"] == 0.4


# --- served queries -------------------------------------------------------------------------


def test_parameter_ranges(spark):
    df, prices = frames(spark, *random_market(1))
    for days in (0, -1):
        with pytest.raises(ValueError):
            views.price_history(prices, "2026-01-30", days)
    for k in (0, -1):
        with pytest.raises(ValueError):
            views.top_correlations(df, df, k)


def test_latest_correlations_use_the_newest_date_of_the_table(spark):
    corr_rows = spark.createDataFrame(
        [("A", day(1), 0.2), ("B", day(2), -0.9), ("C", day(2), 0.5), ("D", day(2), None)],
        "ticker string, analysis_date date, optimal_lag_corr double",
    )
    tickers = spark.createDataFrame([(t, t.lower(), "s") for t in "ABCD"], "ticker string, company_name string, sector string")
    assert [r["ticker"] for r in views.latest_correlations(corr_rows, tickers).collect()] == ["B", "C", "D"]
