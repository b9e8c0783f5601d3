"""Main text of pages, nearest vectors, and the registered SQL."""

from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from moodtape.llm import catalog, main_text, vector_tree
from tests.oracle_compare import compare, connect

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><header><h1>Head &amp; line</h1></header><p>First <b>bo</b>ld&nbsp;words<br>and   more &lt;tags&gt;.
<div class="ad">Buy now</div><p title="a>b">Second paragraph &copy; 2 < 3<aside>see also</aside></p>
<ul><li>one<li>two</ul><form><input name="q"><button>Go</button></form>
<section id="comments"><p>Nice read</p></section></article><div class="sidebar">More</div><footer>&copy; me</footer></body></html>"""


def weights():
    return dict(main_text.DEFAULTS)


def test_main_text():
    expected = "Head & line\nFirst bold words and more <tags>.\nSecond paragraph © 2 < 3\none\ntwo"
    assert main_text.main_text(PAGE, weights()) == expected


def test_cut_off_and_odd_pages():
    w = weights()
    assert main_text.main_text(PAGE[: PAGE.index("</b>ld")] + "<p cla", w) == "Head & line\nFirst bo"
    assert [main_text.main_text(p, w) for p in (None, "", "<nav>x</nav>", "<p>", "<", "<!-- a")] == ["", "", "", "", "<", ""]
    assert main_text.main_text("just words", w) == "just words"
    assert main_text.main_text("<p>" + "word " * 100_000, w) == ("word " * 100_000).strip()
    assert main_text.main_text("<div>" * 50_000 + "deep", w) in ("deep", "")


def test_small_articles_do_not_label_a_page():
    real = " ".join(f"real{k}" for k in range(200))
    said = "".join(f'<article id="c{k}"><p>said {k} by someone</p></article>' for k in range(20))
    teaser = '<article><h3>Other story</h3><p>read on</p></article>'
    pages = [
        f"<div><section><p>{real}</p></section></div>{said}",
        f"{teaser}<div><p>{real}</p></div>{teaser}",
        f"<script>x = '<article>'</script><div><p>{real}</p></div>",
        f"<!-- <main> --><div><p>{real}</p></div>",
        f'<div><p>{real}</p></div><article class="comment">{real.replace("real", "said")} {real.replace("real", "more")}</article>',
        f"<nav><article>{real.replace('real', 'menu')}</article></nav><div><p>{real}</p></div>",
    ]
    for page in pages:
        assert real in main_text.main_text(page, weights())
    assert "said0" not in main_text.main_text(pages[4], weights())
    assert {kind for kind, _, _ in main_text.tokens(pages[0]) if kind[0] == "w"} == {"word"}
    assert "word" not in {kind for kind, _, _ in main_text.tokens(PAGE)}


REAL = " ".join(f"real{k}" for k in range(200))


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="content with-sidebar"><p>{REAL}</p></div>',
        f'<div class="post comments-open"><p>{REAL}</p></div>',
        f'<div class="no-sidebar"><p>{REAL}</p></div>',
        f'<div id="share-page"><p>{REAL}</p></div>',
        f'<article class="ad-free story"><p>{REAL}</p></article>',
        f'<form id="aspnetForm"><div><p>{REAL}</p></div></form>',
        f'<main><p class="discussion">{REAL}</p></main>',
        f'<div><aside>note<p>{REAL}</p></div>',
        f'<aside>note<p>{REAL}</p>',
        f'<div class="sidebar"><p>{REAL}</p></div>',
        f'<div class="content with-sidebar"><p>{REAL}</p></div><div class="sidebar">{"more " * 50}</div>',
        f'<form id="aspnetForm"><div class="nav-bar"><a href="x">menu item</a></div><p>{REAL}</p><div class="footer">left over</div></form>',
    ],
)
def test_names_do_not_take_the_page(page):
    for w in (weights(), weights() | {"mark sidebar": -3.0, "mark share": -3.0, "mark comments": -3.0, "mark ad": -3.0}):
        text = main_text.main_text(page, w)
        assert REAL in text
        assert not any(x in text for x in ("more more", "menu item", "left over"))


@pytest.mark.parametrize(
    "junk",
    [
        '<div class="comments">{}</div>',
        '<ol class="comment-list"><li>{}</li></ol>',
        '<section id="comments"><p>{}</p></section>',
        '<div role="complementary">{}</div>',
        '<div class="x cookie-notice">{}</div>',
        '<form><label>{}</label><input name="q"></form>',
        '<aside><p>{}</p></aside>',
        '<p class="ad">{}</p>',
        '<div class="header">{}</div>',
    ],
)
def test_boilerplate_stays_out(junk):
    said = " ".join(f"junk{k}" for k in range(80))
    page = f"<div><article><h1>Head</h1><p>{REAL}</p>{junk.format(said)}<p>The end</p></article></div>"
    if 'class="header"' not in junk:
        assert main_text.main_text(page, weights()) == f"Head\n{REAL}\nThe end"
    outside = f"<div><p>{REAL}</p></div>{junk.format(said)}"
    assert "junk1" not in main_text.main_text(outside, weights())


def test_runs_against_all_runs():
    rng = np.random.RandomState(8)
    for n in [0, 1, 2, 5, 30] * 20:
        scores = rng.randint(-4, 4, n).tolist()
        start, stop = main_text.best_run(scores)
        every = {(a, b): sum(scores[a:b]) for a in range(n) for b in range(a + 1, n + 1)}
        most = max([0, *every.values()])
        # of equal runs the one that ends first, then the shortest
        best = min(((b, b - a) for (a, b), total in every.items() if total == most and most > 0), default=(0, 0))
        assert (start, stop) == (best[0] - best[1], best[0])


class Article(HTMLParser):
    """The blocks of the article element, without adverts: what a page of the given tables says its text is."""

    blocks = set("article h1 h2 h3 p div ul li section".split())

    def __init__(self):
        super().__init__()
        self.inside, self.ad, self.lines = False, 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if self.ad or (tag == "div" and ("class", "ad") in attrs):
            self.ad += tag == "div"
        if tag in self.blocks:
            self.lines.append("")
        if tag == "br":
            self.lines[-1] += " "

    def handle_endtag(self, tag):
        if self.ad:
            self.ad -= tag == "div"
        if tag in self.blocks:
            self.lines.append("")
        self.inside &= tag != "article"

    def handle_data(self, data):
        if self.inside and not self.ad:
            self.lines[-1] += data


def test_all_pages_of_a_table(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.page_id: r.text for r in catalog.op4_main_text(spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert set(got) == {p.page_id for p in pages}
    for p in pages:
        plain = Article()
        plain.feed(p.html)
        plain.close()
        assert got[p.page_id] == "\n".join(" ".join(line.split()) for line in plain.lines if line.strip()), p.page_id


def test_best_run():
    assert main_text.best_run([-1, 2, -1, 2, -5, 2]) == (1, 4)
    assert main_text.best_run([1, -1, 1]) == (0, 1)
    assert main_text.best_run([-1, -2]) == (0, 0) == main_text.best_run([])


def test_pages_table(spark, tmp_path):
    schema = "page_id long, url string, html string, text int"
    pages = spark.createDataFrame([(1, "u", PAGE, 0), (1, "u", PAGE, 0), (None, None, None, None), (2, "v", "", 1)], schema)
    learned = main_text.fit(pages)
    rows = main_text.extract(pages, learned).collect()
    whole = len(main_text.main_text(PAGE, learned))
    assert sorted((r.page_id or 0, r.n_chars) for r in rows) == [(0, 0), (1, whole), (1, whole), (2, 0)]
    assert len({r.text for r in rows if r.page_id == 1}) == 1
    assert main_text.extract(pages.limit(0), main_text.fit(pages.limit(0))).count() == 0


def exact(ids, vectors, query, top):
    scores = (vectors * vectors[ids == query][0]).sum(1)
    order = sorted((-s, i) for s, i in zip(scores, ids) if i != query)
    return [(query, k + 1, i, -s) for k, (s, i) in enumerate(order[:top])]


def test_small_tables_are_exact(spark):
    rng = np.random.RandomState(1)
    base = rng.randn(300, 8)
    base[50:150] = base[50]  # one very common vector
    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(base)]
    bad = [(400, None, 0), (401, [0.0] * 8, 0), (402, [float("nan")] * 8, 0), (403, [None] * 8, 0), (None, rows[0][1], 0), (404, [1.0], 0)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, score int")
    got = vector_tree.nearest(table, table.where("vec_id % 20 = 0"))
    vectors, ids = np.array([r[1] for r in rows]), np.arange(300)
    expected = [x for q in range(0, 300, 20) for x in exact(ids, vectors, q, 20)]
    assert sorted(map(tuple, got.collect())) == sorted((q, k, int(i), s) for q, k, i, s in expected)
    few = vector_tree.nearest(table.where("vec_id < 5"), table.where("vec_id = 0"))
    assert few.count() == 4
    assert vector_tree.nearest(table.limit(0), table.limit(0)).count() == 0


def test_outlier_leaves_do_not_shorten_answers(spark):
    rng = np.random.RandomState(2)
    base = rng.randn(6000, 8)
    base[:30] = 1000 * np.abs(rng.randn(30, 8)) * np.where(np.arange(30)[:, None] % 8 == np.arange(8), 1, 1e-3)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "vec_id long, embedding array<double>")
    found = vector_tree.nearest(table, table.where("vec_id < 30 or vec_id % 40 = 0"), recall=0.01).groupBy("query_id").count().collect()
    assert len(found) == 30 + 149
    assert {r["count"] for r in found} == {20}


@pytest.mark.parametrize("rows", [9000, 20000])
def test_recall(spark, tmp_path, rows):
    rng = np.random.RandomState(rows)
    centres = rng.randn(60, 32)
    vectors = (centres[rng.randint(0, 60, rows)] + 0.5 * rng.randn(rows, 32)).astype(np.float32)
    pq.write_table(pa.table({"vec_id": np.arange(rows), "embedding": vectors.tolist()}), tmp_path / "embeddings.parquet")
    got = {}
    for r in catalog.op6_vector_tree(spark, str(tmp_path)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    asked = np.arange(0, rows, 20)
    assert set(got) == set(asked.tolist()) and {len(found) for found in got.values()} == {20}
    ids, wide = np.arange(rows), vectors.astype(np.float64)
    hits = sum(len(got[q] & {i for _, _, i, _ in exact(ids, wide, q, 20)}) for q in asked[:150])
    assert hits / (20 * 150) >= 0.9


@pytest.mark.parametrize("name", list(catalog.ORACLE))
def test_equals_sql(spark, sf, name):
    assert compare(spark, name, catalog.QUERIES[name], catalog.ORACLE[name], sf, connect(sf)) is None


def test_registered():
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in catalog.QUERIES}
    assert set(catalog.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", ["op5_license_scan", "op9_line_dedup", "op10_exact_dedup"])
def test_native_plans_have_no_python(spark, sf, name):
    plan = catalog.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "InPandas", "InArrow", "NestedLoop", "Cartesian"))
