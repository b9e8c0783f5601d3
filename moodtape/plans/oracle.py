"""The same answers as plain SQL, for a database to compute independently.

Dialect: DuckDB.  Common parts are named sub-queries put in front as needed.
"""

from __future__ import annotations

import json

from moodtape.plans import catalog
from moodtape.sources import star

# Fixed values, written out here so that the SQL doesn't follow the code it checks.
WORD = r"\p{L}\p{N}_"
SPACE = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
URL_PATTERN = r"https?://[^" + SPACE + r"]+|www\.[^" + SPACE + "]+"
DROPPED_PATTERN = r"[^\p{L}\p{N}_%.,!?₹$\-]+"
# name, measure, rule, bound, critical, message
PRICE_RULES = [
    ("price_row_count", "rows", ">=", 20, True, "%d rows (need >=20 tickers)"),
    ("price_no_null_close", "null_close", "=", 0, True, "%d null close prices"),
    ("price_positive_values", "non_positive", "=", 0, True, "%d rows with close_price <= 0"),
    ("price_pct_change_range", "extreme", "=", 0, False, "%d rows with |pct_change| > 30%%"),
]
RAW_RULES = [
    ("sentiment_row_count", "rows", ">=", 10, True, "%d posts collected (need >=10)"),
    ("sentiment_no_empty_text", "empty_text", "=", 0, False, "%d records with empty text"),
    ("sentiment_multiple_sources", "sources", ">=", 1, False, "%d distinct sources"),
    ("sentiment_ticker_coverage", "tickers", ">=", 5, True, "%d tickers have sentiment data (need >=5)"),
]
SCORED_RULES = [
    ("scored_row_count", "rows", ">=", 5, True, "%d scored records (need >=5)"),
    ("scored_probability_sum", "sum_error", "<", 0.01, True, "avg probability sum error: %.6f (need <0.01)"),
    ("scored_compound_range", "out_of_range", "=", 0, True, "%d records with compound_score outside [-1, 1]"),
]
DAILY_RULES = [
    ("daily_agg_row_count", "rows", ">=", 3, True, "%d tickers aggregated (need >=3)"),
    ("daily_agg_score_range", "out_of_range", "=", 0, True, "%d rows with avg_sentiment outside [-1,1]"),
]


def r_up(x: str, n: int) -> str:
    return (
        f"(case when abs({x}) < {2.0**52 / 10**n}::double "
        f"then sign({x}) * floor(abs({x}) * 1e{n} + 0.5) / 1e{n} + 0.0 else {x} end)"
    )


def r_even(x: str, n: int) -> str:
    return f"(round_even(({x}) * 1e{n}, 0) / 1e{n})"


def mean4(x: str) -> str:
    return f"(sum(cast({x} as decimal(18, 4)))::double / count({x}))"


def pearson(x: str, y: str) -> str:
    return f"case when isnan(corr({x}, {y})) then null else {r_up(f'corr({x}, {y})', 6)} end"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LAGS = (0, 1, 2, 3, 7)
SOURCE_CASE = """case event_type when 'view' then 'news' when 'click' then 'google_news'
    when 'signup' then 'yahoo_finance' else 'other' end"""

PARTS = {
    "tickers": """
        select n_name ticker, n_name company_name, r_name sector, null::varchar industry, true is_active
        from nation join region on n_regionkey = r_regionkey""",
    "raw": f"""
        select event_id id, {SOURCE_CASE} source,
               concat_ws('_', user_id::varchar, event_type, ts::date::varchar) source_id,
               'NATION_' || (user_id % 25)::varchar ticker, ts published_at, ts::date collected_date,
               event_type || ' by user ' || user_id::varchar || ' props ' || props raw_text,
               json_extract_string(props, '$.k') author, floor(value)::int upvotes
        from events""",
    "scored0": f"""
        select event_id raw_id, 'NATION_' || (user_id % 25)::varchar ticker, ts, {SOURCE_CASE} source,
               floor(value)::int upvotes, ts::date scored_date,
               {r_up('0.8::double * least(value, 500.0::double) / 500.0::double', 4)} score_positive
        from events""",
    "scored": f"""
        select *, {r_up('0.8::double - score_positive', 4)} score_negative, 0.2::double score_neutral,
               {r_up('score_positive * 2.0::double - 0.8::double', 4)} compound_score
        from scored0""",
    "daily": f"""
        select ticker, scored_date sentiment_date, count(*) total_mentions,
               count(*) filter (source = 'news') news_mentions,
               count(*) filter (source = 'google_news') google_news_mentions,
               count(*) filter (source = 'yahoo_finance') yahoo_finance_mentions,
               {r_up(mean4('compound_score'), 4)} avg_sentiment_score,
               {r_up("(sum(compound_score * ln(upvotes + 1.0::double)) / nullif(sum(ln(upvotes + 1.0::double)), 0))", 4)}
                   engagement_weighted_score,
               {r_up(mean4('score_positive'), 4)} positive_ratio,
               {r_up(mean4('score_negative'), 4)} negative_ratio,
               {r_up(mean4('score_neutral'), 4)} neutral_ratio,
               {r_up('stddev_samp(compound_score)', 4)} sentiment_std
        from scored group by 1, 2 having count(*) >= 2""",
    "bars": f"""
        select 'NATION_' || c_nationkey::varchar ticker,
               date '{star.FIRST_DAY}' + (o_orderkey % {star.DAYS})::int date,
               min_by(o_totalprice, o_orderkey) open, max(o_totalprice) high, min(o_totalprice) low,
               max_by(o_totalprice, o_orderkey) "close", count(*) volume
        from orders join customer on o_custkey = c_custkey group by 1, 2""",
    "weekday_bars": "select * from bars where isodow(date) < 6",
    "prices": f"""
        select ticker, date trade_date, {r_even('open', 4)} open_price, {r_even('high', 4)} high_price,
               {r_even('low', 4)} low_price, {r_even('"close"', 4)} close_price, {r_even('"close"', 4)} adj_close,
               volume, {r_even('("close" / nullif(prior, 0) - 1.0::double) * 100.0::double', 4)} pct_change,
               {r_even('((high - low) / nullif(low, 0)) * 100.0::double', 4)} intraday_range
        from (select *, lag("close") over (partition by ticker order by date) prior from weekday_bars)
        where "close" / nullif(prior, 0) is not null""",
    "joined": """
        select d.*, p.* exclude (ticker, trade_date)
        from daily d join prices p on d.ticker = p.ticker and d.sentiment_date = p.trade_date""",
}
NEEDS = {
    "scored": ["scored0"],
    "daily": ["scored"],
    "weekday_bars": ["bars"],
    "prices": ["weekday_bars"],
    "joined": ["daily", "prices"],
}


def correlations(name: str, start: str, end: str, lookback: int, optimal: bool = True) -> dict[str, str]:
    """Sub-queries that compute the correlation table day by day."""
    w = "over (partition by analysis_date, ticker order by sentiment_date)"
    roll = "over (partition by analysis_date, ticker order by sentiment_date rows between 29 preceding and current row)"
    lagged = ", ".join(f"lag(avg_sentiment_score, {k}) {w} x{k}" for k in LAGS)
    columns = ", ".join(f"{pearson(f'x{k}', 'pct_change')} corr_lag_{k}d" for k in LAGS)
    best, best_r = "0", "0.0::double"
    parts = {
        f"{name}_days": f"select unnest(generate_series(date '{start}', date '{end}', interval 1 day))::date analysis_date",
        f"{name}_base": f"""
            select analysis_date, ticker, avg_sentiment_score, pct_change, {lagged},
                   avg(avg_sentiment_score) {roll} rolling_x, avg(pct_change) {roll} rolling_y
            from {name}_days join joined
              on sentiment_date between analysis_date - {lookback} and analysis_date""",
        f"{name}_found": f"""
            select ticker, analysis_date, {columns},
                   {r_up('avg(rolling_x)', 4)} rolling_30d_avg_sent, {r_up('avg(rolling_y)', 4)} rolling_30d_price_ret,
                   count(*) sample_size
            from {name}_base where avg_sentiment_score is not null and pct_change is not null
            group by 1, 2 having count(*) >= 10""",
    }
    previous = f"select *, {best} optimal_lag_days, {best_r} optimal_lag_corr from {name}_found"
    for k in LAGS:
        wins = f"coalesce(abs(corr_lag_{k}d) > abs(optimal_lag_corr), false)"
        previous = f"""select * replace (case when {wins} then {k} else optimal_lag_days end as optimal_lag_days,
                   case when {wins} then corr_lag_{k}d else optimal_lag_corr end as optimal_lag_corr) from ({previous})"""
    parts[name] = previous
    return parts


ONE_DAY = correlations("one_day", catalog.AS_OF, catalog.AS_OF, 90)
MANY_DAYS = correlations("many_days", catalog.TABLE_START, catalog.AS_OF, 90)
BACKFILL = correlations("filled", catalog.BACKFILL_START, catalog.AS_OF, catalog.BACKFILL_LOOKBACK)


def query(body: str, *needs: str, **extra: str) -> str:
    """``body`` with the sub-queries it needs, in order, in front."""
    ordered: list[str] = []

    def add(part: str) -> None:
        for inner in NEEDS.get(part, []):
            add(inner)
        if part not in ordered:
            ordered.append(part)

    for part in needs:
        add(part)
    named = [f"{p} as ({PARTS[p]})" for p in ordered] + [f"{k} as ({v})" for k, v in extra.items()]
    return f"with {', '.join(named)} {body}" if named else body


SENTIMENT = "avg_sentiment_score, engagement_weighted_score, total_mentions, positive_ratio, negative_ratio"
CORRELATION = """analysis_date, optimal_lag_days, optimal_lag_corr, corr_lag_0d, corr_lag_1d, corr_lag_2d,
    corr_lag_3d, corr_lag_7d, sample_size"""
SINCE = f"date '{catalog.AS_OF}' - 30"
SECTORS = f"""select sector, sentiment_date, count(distinct ticker) stocks_tracked,
    {mean4('avg_sentiment_score')} avg_sector_sentiment, sum(total_mentions)::bigint total_sector_mentions,
    {mean4('pct_change')} avg_sector_return
    from joined join tickers using (ticker) group by 1, 2"""
SHOWN_SECTORS = f"""select sector, sentiment_date, stocks_tracked, {r_up('avg_sector_sentiment', 10)} avg_sector_sentiment,
    total_sector_mentions, {r_up('avg_sector_return', 10)} avg_sector_return from sectors"""

# --- quality ---------------------------------------------------------------------------------

CALENDAR = """select unnest(generate_series(min(day), max(day), interval 1 day))::date run_date
    from (select trade_date as day from prices union all select collected_date from raw)"""
MEASURES = {
    "price_m": """select trade_date run_date, count(*) rows, count(*) filter (close_price is null) null_close,
        count(*) filter (close_price <= 0) non_positive, count(*) filter (abs(pct_change) > 30) extreme
        from prices group by 1""",
    "raw_m": """select collected_date run_date, count(*) rows,
        count(*) filter (raw_text is null or length(raw_text) < 10) empty_text,
        count(distinct source) sources, count(distinct ticker) tickers from raw group by 1""",
    "scored_m": """select scored_date run_date, count(*) rows,
        avg(abs(score_positive + score_negative + score_neutral - 1.0::double)) sum_error,
        count(*) filter (compound_score < -1 or compound_score > 1) out_of_range from scored group by 1""",
    "daily_m": """select sentiment_date run_date, count(*) rows,
        count(*) filter (avg_sentiment_score < -1 or avg_sentiment_score > 1) out_of_range from daily group by 1""",
}


def checks(measures: str, rules: list[tuple]) -> str:
    rows = []
    for name, measure, rule, bound, critical, message in rules:
        value = measure if rule == "<" else f"coalesce({measure}, 0)"
        shown = f"printf({quote(message)}, {value if rule == '<' else value + '::bigint'})"
        rows.append(
            f"""select run_date, {quote(name)} as name, coalesce({value} {rule} {bound}, false) passed,
            {str(critical).lower()} critical, case when {value} is null then 'no rows' else {shown} end message,
            {value}::double as value from days left join {measures} using (run_date)"""
        )
    return " union all ".join(rows)


COLLECTION = f"{checks('price_m', PRICE_RULES)} union all {checks('raw_m', RAW_RULES)}"
SCORING = f"{checks('scored_m', SCORED_RULES)} union all {checks('daily_m', DAILY_RULES)}"

# --- texts -------------------------------------------------------------------------------------


def cleaned(text: str) -> str:
    dropped = f"regexp_replace({text}, {quote(URL_PATTERN)}, '', 'g')"
    return f"trim(regexp_replace({dropped}, {quote(DROPPED_PATTERN)}, ' ', 'g'))"


MARKUP = (
    r"(?is)<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)|<[!?][^>]*>"
    r"""|</?[a-z][^>=]*(?:=\s*(?:"[^"]*"|'[^']*'|)[^>=]*)*>"""
)


def stripped(text: str) -> str:
    return f"regexp_replace({text}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def unescaped(text: str) -> str:
    """The references that occur in the pages; the ampersand last, so that none is read twice."""
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{char}')"
    return text


DOCUMENTS = f"""select doc_id, text, date '{star.FIRST_DAY}' + (doc_id % {star.DAYS})::int collected_date,
    {cleaned('text')} clean from documents"""
KEYWORDS = "select * from (values " + ", ".join(f"({quote(t)}, {quote(k)})" for t, k in star.KEYWORDS) + ") k(ticker, keyword)"
def matches(source: str, text: str) -> str:
    """Pairs of document and ticker, one pattern per keyword."""
    patterns = [(t, rf"(^|[^{WORD}])\Q{k.upper()}\E([^{WORD}]|$)") for t, k in star.KEYWORDS]
    return " union ".join(
        f"select doc_id, {quote(t)} ticker from {source} where regexp_matches(upper({text}), {quote(p)})" for t, p in patterns
    )


MATCHES = matches("documents", "text")


def lexicon_sql(source: str, columns: str) -> str:
    lex = catalog.DOCUMENT_LEXICON

    def weigh(words: dict[str, float]) -> str:
        table = "map " + json.dumps(words).replace('"', "'")
        return f"coalesce(list_sum(list_transform(tokens, lambda t: coalesce(({table})[t], 0.0)))::double, 0.0)"

    return f"""
        select {columns}, case when pp >= pn and pp >= pu then 'positive' when pn >= pu then 'negative' else 'neutral' end as label,
               {r_up('pp', 4)} score_positive, {r_up('pn', 4)} score_negative, {r_up('pu', 4)} score_neutral,
               {r_up('greatest(pp, pn, pu)', 4)} confidence, {r_up('(pp - pn)', 4)} compound_score
        from (select *, ep / (ep + en + eu) pp, en / (ep + en + eu) pn, eu / (ep + en + eu) pu
        from (select *, exp(zp - greatest(zp, zn, zu)) ep, exp(zn - greatest(zp, zn, zu)) en, exp(zu - greatest(zp, zn, zu)) eu
        from (select *, p * {lex.sharpness}::double / (p + n + 1.0) zp, n * {lex.sharpness}::double / (p + n + 1.0) zn,
                     {lex.neutral}::double zu
        from (select *, {weigh(lex.positive)} p, {weigh(lex.negative)} n
        from (select *, regexp_extract_all(lower(clean), '[{WORD}]+') tokens from {source} where clean <> '')))))"""


LANDED = """select doc_id, lang, source,
    case when instr(text, chr(10)) > 0 then substr(text, 1, instr(text, chr(10)) - 1) else text end title,
    case when instr(text, chr(10)) > 0 then substr(text, instr(text, chr(10)) + 1) else '' end body,
    'NATION_' || (doc_id % 25)::varchar ticker,
    '2024-01-' || lpad((doc_id % 28 + 1)::varchar, 2, '0') || ' 10:20:30' published_at,
    'https://example.org/' || doc_id::varchar url from documents"""

# --- upserts ------------------------------------------------------------------------------------

FIRST_RAW = """select distinct on (source, source_id, ticker) source, source_id, ticker, collected_date, raw_text, author,
    upvotes, id::varchar url from raw order by source, source_id, ticker, id"""
ORACLE: dict[str, str] = {
    "price_bars": query("select * from prices", "prices"),
    "price_files": query("select * from prices", "prices"),
    "price_collection": query(
        f"""select ticker || '.NS' symbol, ticker, trade_date, close_price, pct_change from prices
        where trade_date >= date '{catalog.AS_OF}' - 13""",
        weekday_bars=f"select * from ({PARTS['bars']}) where isodow(date) < 6 and date >= date '{catalog.AS_OF}' - 15",
        prices=PARTS["prices"],
    ),
    "sentiment_daily": query("select * from daily", "daily"),
    "sentiment_daily_joined": query("select * from daily", "daily"),
    "weighted_sentiment": query("select ticker, sentiment_date, engagement_weighted_score from daily", "daily"),
    "lag_correlation": query("select * exclude (optimal_lag_days, optimal_lag_corr) from one_day", "joined", **ONE_DAY),
    "optimal_lag": query("select * from one_day", "joined", **ONE_DAY),
    "largest_samples": query(
        "select ticker, optimal_lag_days, sample_size from one_day order by sample_size desc, ticker limit 5", "joined", **ONE_DAY
    ),
    "backfill_correlation": query("select * from filled", "joined", **BACKFILL),
    "sentiment_price_view": query(
        """select ticker, sentiment_date date, avg_sentiment_score, engagement_weighted_score, total_mentions,
        positive_ratio, negative_ratio, sentiment_std, close_price, pct_change price_change_pct, volume, intraday_range,
        lead(pct_change, 1) over w next_day_return, lead(pct_change, 2) over w next_2day_return
        from joined window w as (partition by ticker order by sentiment_date)""",
        "joined",
    ),
    "latest_correlations": query(
        """select c.*, company_name, sector from many_days c join tickers using (ticker)
        where analysis_date = (select max(analysis_date) from many_days)""",
        "joined", "tickers", **MANY_DAYS,
    ),
    "sector_sentiment": query(SHOWN_SECTORS, "joined", "tickers", sectors=SECTORS),
    "sector_overview": query(
        f"""select sector, {r_up('avg(avg_sector_sentiment)', 10)} avg_sentiment, {r_up('avg(avg_sector_return)', 10)} avg_return,
        sum(total_sector_mentions)::bigint total_mentions from sectors where sentiment_date >= {SINCE} group by 1""",
        "joined", "tickers", sectors=SECTORS,
    ),
    "active_tickers": query(
        "select ticker, company_name, sector, industry from tickers where is_active order by ticker", "tickers"
    ),
    "sentiment_history": query(
        f"select ticker, sentiment_date date, {SENTIMENT} from daily where sentiment_date >= {SINCE}", "daily"
    ),
    "sentiment_history_ticker": query(
        f"""select ticker, sentiment_date date, {SENTIMENT} from daily
        where sentiment_date >= {SINCE} and ticker = '{catalog.TICKER}'""",
        "daily",
    ),
    "latest_sentiment": query(
        f"""select ticker, sentiment_date date, {SENTIMENT} from daily
        qualify row_number() over (partition by ticker order by sentiment_date desc) = 1""",
        "daily",
    ),
    "price_history": query(
        f"select ticker, trade_date date, close_price, pct_change, volume from prices where trade_date >= {SINCE}", "prices"
    ),
    "latest_correlation": query(
        f"""select ticker, company_name, {CORRELATION} from many_days join tickers using (ticker)
        qualify row_number() over (partition by ticker order by analysis_date desc) = 1""",
        "joined", "tickers", **MANY_DAYS,
    ),
    "top_correlations": query(
        """select c.*, company_name, sector from many_days c join tickers using (ticker)
        where analysis_date = (select max(analysis_date) from many_days)
        order by abs(optimal_lag_corr) desc nulls last, ticker limit 10""",
        "joined", "tickers", **MANY_DAYS,
    ),
    "sector_history": query(f"{SHOWN_SECTORS} where sentiment_date >= {SINCE}", "joined", "tickers", sectors=SECTORS),
    "sector_history_sector": query(
        f"{SHOWN_SECTORS} where sentiment_date >= {SINCE} and sector = '{catalog.SECTOR}'", "joined", "tickers", sectors=SECTORS
    ),
    "sentiment_price_series": query(
        f"""select ticker, sentiment_date date, {SENTIMENT}, close_price, pct_change from joined
        where sentiment_date >= {SINCE}""",
        "joined",
    ),
    "freshness": query(
        """select (select max(trade_date) from prices) latest_price_date,
        (select max(sentiment_date) from daily) latest_sentiment_date,
        (select max(analysis_date) from many_days) latest_correlation_date""",
        "joined", **MANY_DAYS,
    ),
    "period_summary": query(
        f"""select * from (select ticker, {r_up('avg(avg_sentiment_score)', 10)} avg_sentiment,
        sum(total_mentions)::bigint total_mentions, {r_up('avg(pct_change)', 10)} avg_daily_return
        from joined where sentiment_date >= {SINCE} group by 1)
        left join (select ticker, optimal_lag_days, optimal_lag_corr from many_days
        qualify row_number() over (partition by ticker order by analysis_date desc) = 1) using (ticker)""",
        "joined", **MANY_DAYS,
    ),
    "run_summary": query(
        f"""select 'price rows' measure, count(*) total from prices where trade_date = date '{catalog.AS_OF}'
        union all select 'articles ' || source, count(*) from raw where collected_date = date '{catalog.AS_OF}' group by 1
        union all select 'scored articles', count(*) from scored where scored_date = date '{catalog.AS_OF}'
        union all select 'correlated tickers', count(*) from one_day where analysis_date = date '{catalog.AS_OF}'""",
        "joined", "raw", **ONE_DAY,
    ),
    "run_findings": query(
        """select ticker, optimal_lag_days, optimal_lag_corr, sample_size,
        case when optimal_lag_corr > 0 then 'positive' else 'negative' end direction
        from one_day order by abs(optimal_lag_corr) desc nulls last, ticker limit 3""",
        "joined", **ONE_DAY,
    ),
    "tracked_sentiment": query("select raw_id, ticker, compound_score from scored semi join tickers using (ticker)", "scored", "tickers"),
    "holiday_filter": query(
        f"""select ticker, trade_date, close_price from prices
        where trade_date not in ({', '.join(f"date '{h}'" for h in star.HOLIDAYS)})""",
        "prices",
    ),
    "mention_counts_zero_filled": query(
        """select ticker, coalesce(n, 0) n from tickers left join (select ticker, count(*) n from matches group by 1) using (ticker)""",
        "tickers", matches=MATCHES,
    ),
    "busiest_tickers": query("select ticker, count(*) n from matches group by 1", matches=MATCHES),
    "source_totals": query("select collected_date, source, count(*) n from raw group by 1, 2", "raw"),
    "quality_collection": query(COLLECTION, "prices", "raw", days=CALENDAR, price_m=MEASURES["price_m"], raw_m=MEASURES["raw_m"]),
    "quality_scoring": query(
        f"select * replace ({r_up('value', 10)} as value) from ({SCORING})",
        "prices", "raw", "scored", "daily", days=CALENDAR, scored_m=MEASURES["scored_m"], daily_m=MEASURES["daily_m"],
    ),
    "quality_report": query(
        """select run_date, count(*) filter (passed) passed, count(*) filter (not passed) failed,
        coalesce(string_agg(name, ',' order by name) filter (not passed and critical), '') critical_failures,
        count(*) filter (not passed and critical) = 0 pipeline_ok from results group by 1""",
        "prices", "raw", "daily", days=CALENDAR, **MEASURES, results=f"{COLLECTION} union all {SCORING}",
    ),
    "publish_gate": query(
        """select count(*) filter (sample_size < 10) stale_rows, count(*) filter (sample_size < 10) = 0 may_publish
        from many_days""",
        "joined", **MANY_DAYS,
    ),
    "dimension_probe": query("select count(*) n from tickers", "tickers"),
    "dedup_first": query(
        "select distinct on (source, source_id, ticker) * from raw order by source, source_id, ticker, id", "raw"
    ),
    "unscored": query(
        f"""select id, ticker, raw_text, source, upvotes from raw
        left join (select raw_id from scored where scored_date <= date '{catalog.SPLIT_DAY}') on id = raw_id
        where raw_id is null and raw_text is not null and length(raw_text) > 15""",
        "raw", "scored",
    ),
    "upsert_ignore": query("select * from first_raw", "raw", first_raw=FIRST_RAW),
    "upsert_replace": query(
        """select * from daily d where not exists (select 1 from late l
            where l.ticker = d.ticker and l.sentiment_date = d.sentiment_date)
        union all select * from late""",
        "daily",
        late_scored=f"select * from scored where scored_date > date '{catalog.SPLIT_DAY}' and source = 'news'",
        late=PARTS["daily"].replace("from scored", "from late_scored"),
    ),
    "sql_scan": query(
        """select * exclude (total_mentions) from (select ticker, sentiment_date date, avg_sentiment_score,
        lead(pct_change) over (partition by ticker order by sentiment_date) next_day_return, total_mentions from joined)
        where date >= date '2024-01-10' and total_mentions >= 3""",
        "joined",
    ),
    "keyword_match_large": f"""select distinct doc_id, 'W' || substr(word, 1, 2) ticker from
        (select doc_id, unnest(regexp_extract_all(upper(replace(text, 'ß', 'ss')), '[{WORD}]+')) word from documents) where length(word) >= 9""",
    "keyword_match": query("select * from matches", matches=MATCHES),
    "keyword_defaults": query(
        "select distinct ticker, upper(coalesce(keyword, ticker)) keyword from tickers left join keywords using (ticker)",
        "tickers", keywords=KEYWORDS,
    ),
    "clean_text": query("select doc_id, clean from docs", docs=DOCUMENTS),
    "html_text": f"""select page_id, array_to_string(list_filter(list_transform(string_split_regex(html, {quote(MARKUP)}),
        lambda x: {stripped(unescaped('x'))}), lambda x: x <> ''), ' ') as text from pages""",
    "lexicon_scores": query(lexicon_sql("docs", "doc_id"), docs=DOCUMENTS),
    "batch_scoring": query(lexicon_sql("docs", "doc_id"), docs=DOCUMENTS),
    "score_new_articles": query(
        lexicon_sql("todo", "doc_id raw_id, 'NATION_0' ticker, 'news' as source, 0 upvotes, collected_date scored_date"),
        docs=DOCUMENTS,
        todo=f"select * from docs where collected_date > date '{catalog.SPLIT_DAY}' and length(text) > 15",
    ),
    "article_json": query(
        f"""select 'yahoo_finance' as source, case when lang = 'en' then 'a' || doc_id::varchar else url end || '_' || ticker source_id,
        ticker, published_at, date '{catalog.AS_OF}' collected_date, full_text raw_text, source author,
        0 upvotes, url from (select *, {stripped("title || ' ' || body")} full_text from landed) where length(full_text) >= 15""",
        landed=LANDED,
    ),
    "feed_xml": query(
        f"""select 'google_news' as source,
        case when doc_id % 2 = 0 then 'g' || doc_id::varchar else url end || '_' || ticker source_id,
        ticker, published_at, date '{catalog.AS_OF}' collected_date, full_text raw_text, 'Google News' author,
        0 upvotes, url from (select *, {stripped("title || ' ' || " + stripped("body"))} full_text from landed)
        where length(full_text) >= 15""",
        landed=LANDED,
    ),
    "feed_news": query(
        """select 'news' as source, case when doc_id % 2 = 0 then 'g' || doc_id::varchar else url end || '_' || m.ticker source_id,
        m.ticker, published_at, collected_date, full_text raw_text, author, 0 upvotes, url
        from texts join found m using (doc_id)""",
        landed=LANDED,
        texts=f"""select * from (select doc_id, url, published_at, source author, date '{catalog.AS_OF}' collected_date,
            {stripped("title || ' ' || " + stripped("body"))} full_text from landed) where length(full_text) >= 20""",
        found=matches("texts", "full_text"),
    ),
    "stream_daily_window": query(
        """select * from daily where sentiment_date + 1 <= (select max(ts) - interval 1 hour from events)""", "daily"
    ),
    "stream_upsert": query("select * from daily", "daily"),
    "stream_dedup": query("select distinct source, source_id, ticker, collected_date from raw", "raw"),
    "stream_ingest": query("select * from first_raw", "raw", first_raw=FIRST_RAW),
}

ORACLE |= {
    "article_ids": query(
        """select md5(source || chr(31) || ticker || chr(31) || source_id) id, source, source_id, ticker
        from (select distinct source, source_id, ticker from raw)""",
        "raw",
    ),
    "stored_defaults": query(
        """select r.*, coalesce(nullif(news_mentions, total_mentions), 0) news_mentions, 0 yahoo_finance_mentions
        from (select ticker, collected_date as day, 0 upvotes, 0 authors, count(*) stamped from raw group by 1, 2) r
        join daily d on d.ticker = r.ticker and d.sentiment_date = r.day""",
        "raw", "daily",
    ),
    "collected_articles": " union all ".join(f"select * from ({ORACLE[n]})" for n in ("feed_news", "feed_xml", "article_json")),
}
