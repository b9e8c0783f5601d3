import datetime as dt
import email.utils
import html.entities
import math
import random
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from moodtape.functions import dates, numeric, text


def one(spark, c):
    return spark.range(1).select(c.alias("v")).first()["v"]


def column(spark, values, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").coalesce(1)
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


# --- numbers -----------------------------------------------------------------------


def test_round_half_up(spark):
    values = [1.005, 0.5, -0.5, 2.5, -2.5, 0.12345, None, 1e300, float("inf"), 0.0, -1e-9]
    got = column(spark, values, "double", lambda c: numeric.round_half_up(c, 0))
    assert got == [1.0, 1.0, -1.0, 3.0, -3.0, 0.0, None, 1e300, float("inf"), 0.0, 0.0]
    assert column(spark, [1.005], "double", lambda c: numeric.round_half_up(c, 2)) == [1.0]
    assert math.isnan(column(spark, [float("nan")], "double", lambda c: numeric.round_half_up(c, 4))[0])


def test_round_half_even(spark):
    got = column(spark, [0.5, 1.5, 2.5, -0.5, None], "double", lambda c: numeric.round_half_even(c, 0))
    assert got == [0.0, 2.0, 2.0, 0.0, None]


def test_change_and_spread_with_zero(spark):
    assert one(spark, numeric.change_pct(F.lit(5.0), F.lit(0.0))) is None
    assert one(spark, numeric.change_pct(F.lit(5.0), F.lit(4.0))) == 25.0
    assert one(spark, numeric.spread_pct(F.lit(5.0), F.lit(0.0))) is None


def series(spark, pairs):
    return spark.createDataFrame(pairs, "x double, y double")


def pearson(spark, pairs):
    return series(spark, pairs).select(numeric.pearson("x", "y").alias("r")).first()["r"]


def test_pearson(spark):
    rng = random.Random(1)
    pairs = [(rng.random(), rng.random()) for _ in range(50)]
    n = len(pairs)
    mx, my = sum(x for x, _ in pairs) / n, sum(y for _, y in pairs) / n
    cov = sum((x - mx) * (y - my) for x, y in pairs)
    expect = cov / math.sqrt(sum((x - mx) ** 2 for x, _ in pairs) * sum((y - my) ** 2 for _, y in pairs))
    assert pearson(spark, pairs) == pytest.approx(expect, abs=1e-12)
    holes = pairs + [(None, 5.0), (7.0, None)]
    assert pearson(spark, holes) == pytest.approx(expect, abs=1e-12)
    scaled = [(3 * x + 1, 2 * y - 5) for x, y in pairs]
    assert pearson(spark, scaled) == pytest.approx(expect, abs=1e-12)


@pytest.mark.parametrize("pairs", [[(1.0, 2.0)], [(0.1, 1.0), (0.1, 2.0), (0.1, 3.0)], [(1.0, 5.0), (2.0, 5.0)], [(None, 1.0)]])
def test_pearson_undefined(spark, pairs):
    assert pearson(spark, pairs) is None


def test_mean_of_four_decimal_scores_does_not_depend_on_order(spark):
    values = [round(random.Random(i).uniform(-1, 1), 4) for i in range(999)]
    means = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        means.add(df.select(numeric.mean_4dp("v").alias("m")).first()["m"])
        values = values[::-1]
    assert len(means) == 1
    assert spark.createDataFrame([], "v double").select(numeric.mean_4dp("v").alias("m")).first()["m"] is None


def test_weighted_mean_without_weight(spark):
    df = spark.createDataFrame([(0.5, 0.0), (0.1, 0.0)], "v double, w double")
    assert df.select(numeric.weighted_mean("v", "w").alias("m")).first()["m"] is None


def test_softmax(spark):
    got = spark.range(1).select(*numeric.softmax(F.lit(1000.0), F.lit(1000.0), F.lit(-1000.0))).first()
    assert tuple(got) == (0.5, 0.5, 0.0)


# --- texts ---------------------------------------------------------------------------


# Texts and what is left of them, written out by hand.
SAMPLES = [
    ("", ""),
    (None, ""),
    ("Profit up 12% https://x.y/z?a=1 now, see www.site.org/q!", "Profit up 12% now, see"),
    ("Café naïve — “quoted” ₹500 $3 a_b 中文 ½ ²", "Café naïve quoted ₹500 $3 a_b 中文 ½ ²"),
    ("tab\tnew\nline nbsp\u00a0em\u3000wide\x1cfs\x85nel", "tab new line nbsp em wide fs nel"),
    ("x" * 9000, "x" * 9000),
    ("emoji 😀 kept? no", "emoji kept? no"),
    ("http:// no address", "http no address"),
]


def test_clean_text(spark):
    assert column(spark, [t for t, _ in SAMPLES], "string", text.clean_text) == [clean for _, clean in SAMPLES]


def test_clean_text_of_random_characters(spark):
    rng = random.Random(7)
    pools = [(0x20, 0x7F), (0xA0, 0x250), (0x370, 0x500), (0x900, 0x980), (0x2000, 0x2100), (0x3000, 0x3100), (0x4E00, 0x4E80)]
    texts = ["".join(chr(rng.randrange(*rng.choice(pools))) for _ in range(60)) for _ in range(300)]
    import unicodedata

    # Only characters both Unicode tables know, as the two versions differ in age.
    texts = ["".join(ch for ch in t if unicodedata.category(ch) != "Cn") for t in texts]
    got = column(spark, texts, "string", text.clean_text)
    assert got == [" ".join("".join(ch if ch.isalnum() or ch in "_%.,!?₹$-" else " " for ch in t).split()) for t in texts]


def test_full_text_and_source_id(spark):
    assert one(spark, text.full_text(F.lit("T"), F.lit(None))) == "T"
    assert one(spark, text.full_text(F.lit(" a"), F.lit("b "))) == "a b"
    assert one(spark, text.source_id(F.lit("i" * 200), F.lit("u"), F.lit("M&M"))) == "i" * 200 + "_M&M"
    assert one(spark, text.source_id(F.lit(None), F.lit("u"), F.lit("X"))) == "u_X"


class Nodes(HTMLParser):
    """Text nodes of a fragment, references resolved the lenient way."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.nodes, self.current, self.hidden = [], [], 0

    def flush(self):
        joined = "".join(self.current)
        self.current = []
        if joined.strip():
            self.nodes.append(joined.strip())

    def handle_starttag(self, tag, attrs):
        self.flush()
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        if self.hidden:
            self.current = []
            self.hidden -= tag in ("script", "style")
        self.flush()

    def handle_startendtag(self, tag, attrs):
        self.flush()

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = handle_comment

    def handle_data(self, data):
        self.current.append(data)

    def handle_entityref(self, name):
        self.current.append(html.entities.html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        code = int(name[1:], 16) if name[0] in "xX" else int(name)
        if 128 <= code < 160:
            try:
                return self.current.append(bytes([code]).decode("cp1252"))
            except UnicodeDecodeError:
                pass
        self.current.append(chr(code) if code <= 0x10FFFF and not 0xD800 <= code < 0xE000 else "�")


def visible(fragment):
    parser = Nodes()
    parser.feed(fragment or "")
    parser.close()
    parser.flush()
    return " ".join(parser.nodes)


FRAGMENTS = [
    None,
    "",
    "plain",
    "<p>One<b>two</b> three</p>",
    "a < b and c > d",
    "<p title='x > y'>kept</p> <a href=\"u?a=1&amp;b=>\">link</a>",
    "x<!-- gone > still gone -->y<br/>z",
    "<script>var t='<p>no</p>';</script>yes<STYLE type='t'>p{}</STYLE>!",
    "AT&amp;T &lt;tag&gt; &quot;q&quot; &copy; &hellip; &euro;5 &nbsp;end&nbsp;",
    "&#8217;&#x2019;&#X41;&#146;&#128; &#1114112; &#55296;",
    "&amp;lt; stays &amp;amp;",
    "&unknown; &bogus text",
    "<!DOCTYPE html><html><head><title>T</title></head><body>  B\n c </body></html>",
    "<ul><li>1</li><li> 2 </li></ul>",
    "<p class=it's title = 'a > b'>stray quote</p> it's 5 < 6",
    "<a href=x?a=b=c>two</a>",
    "<div\n class='a'\n>multi\nline</div>",
]


def test_clean_html(spark):
    assert column(spark, FRAGMENTS, "string", text.clean_html) == [visible(f) for f in FRAGMENTS]


def test_clean_html_on_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("html", text.clean_html("html").alias("t")).collect()
    assert pages and all(r["t"] == visible(r["html"]) for r in pages)


def test_long_attributes_do_not_overflow(spark):
    tag = "<a " + " ".join(f'k{i}="{"v" * 50}"' for i in range(3000)) + ">in</a>"
    assert one(spark, text.clean_html(F.lit(tag))) == "in"


# --- dates -----------------------------------------------------------------------------

RFC = [
    "Mon, 05 Jan 2026 10:20:30 +0530",
    "05 Jan 2026 10:20 GMT",
    "Tue, 6 FEB 26 01:02:03 -0800",
    "Thu, 31 Dec 98 23:59:59 EST",
    "not a date",
    "Mon, 31 Feb 2026 10:20:30 +0530",
    "",
    None,
]


def rfc_in_python(v):
    try:
        return email.utils.parsedate_to_datetime(v).replace(tzinfo=None)
    except Exception:
        return None


def test_rfc822(spark):
    assert column(spark, RFC, "string", dates.parse_rfc822) == [rfc_in_python(v) for v in RFC]


ISO = ["2026-01-05T10:20:30Z", "2026-01-05T10:20:30+05:30", "2026-01-05 10:20", "2026-01-05T10:20:30.123Z", "2026-01-05", "05/01/2026", "", None]


def iso_in_python(v):
    try:
        return dt.datetime.fromisoformat(v.replace("Z", "+00:00")).replace(tzinfo=None, microsecond=0)
    except (ValueError, AttributeError):
        return None


def test_iso(spark):
    assert column(spark, ISO, "string", dates.parse_iso) == [iso_in_python(v) for v in ISO]


def test_fallback_date(spark):
    now = F.to_timestamp(F.lit("2026-03-01 00:00:00"))
    got = one(spark, dates.first_date([dates.parse_rfc822(F.lit("x")), dates.parse_rfc822(F.lit("5 Jan 2026 1:02:03"))], now))
    assert got == dt.datetime(2026, 1, 5, 1, 2, 3)
    assert one(spark, dates.first_date([dates.parse_rfc822(F.lit("x"))], now)) == dt.datetime(2026, 3, 1)


def test_outer_blanks_of_every_kind_go(spark):
    every = [chr(c) for c in range(0x3100) if re.fullmatch(r"\s", chr(c))]
    assert set(text._SPACES) == set(every)
    given = ["", " ", "a", *every, *[f"{b}a{b}b{b}{b}\n" for b in every], "a\u200b", "\u200ba", None]
    assert column(spark, given, "string", text.strip_blank) == [g if g is None else g.strip("".join(every)) for g in given]


def test_markup_begins_with_one_character(spark):
    # every branch is tried only where a tag may begin
    assert text._MARKUP.startswith("(?is)<(?:") and text._MARKUP.endswith(")")
