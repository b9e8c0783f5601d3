"""The main text of web pages as the maximum-scoring run of words and tags.

A page is a sequence of words and tags.  Words score positive, tags negative, and one linear scan finds the contiguous
run with the largest sum: the content region.  The weights are log odds learned from labelled pages: pages that say
themselves, by an ``article`` or ``main`` element with at least half of their words, where their content is; words count by where they stand (inside
such an element, outside of it, on a page without one, in a link), tags by name.  They are fitted on a bounded sample
(``sample_pages``, drawn by a hash of the page's address and number), counted on the executors; only one row per kind
of word, tag or mark reaches the driver, as many as the sampled pages have.  Every page is then read whole, in Arrow batches, without a shuffle.

Elements that have no text of their own by name (scripts, styles, ...) are never read.  Those that look like boilerplate,
by name or by the words of their class, id or role (menus, page headers, footers, side bars, notices, adverts, forms,
reader comments), are passed over at no cost, so an advert doesn't cut an article in two, but only if they are a minor
part of the page: an element with more than ``MAJOR`` of its words is read on, whatever it is called, and what it holds
is judged by itself.  So a page whose whole content stands in a form, or in a ``content with-sidebar``, keeps it.  Inside
an article or main element, words of a class don't make a block of text boilerplate unless it is an element that adverts
and comments stand in.  What else class, id and role say has learned weights like the tags: each of their words is a
token of its own kind at the element's start.  A block (paragraph, heading, list item, ...) that the region touches is
given whole.  Character references are decoded, white space becomes one space, blocks are joined by newlines.

Edge cases.  Null, empty and word-less pages give an empty text.  Tags cut off at the end of the page are dropped,
unclosed elements end with the page.  Of equal runs the one that ends first is taken, then the shortest.  A page's text depends on the page and
the weights alone, so repeated rows agree; an empty table gives an empty result.  With no labelled page, default weights
hold.  Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 4000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead tr ul".split()
)
SPACES = frozenset("br td th".split())
CONTENT = frozenset("article main".split())
#: Elements without a text of their own.
SILENT = frozenset("script style noscript template iframe svg object button select textarea head title".split())
#: Boilerplate by name: always, and unless they hold a major part of the page.
MENUS = frozenset("nav footer menu".split())
WRAPPERS = frozenset("aside form dialog header".split())
#: Elements that make a wrapper a page rather than some fields or links.
TEXTUAL = frozenset("article blockquote h1 h2 h3 main p section".split())
#: Words of a class, id or role that mark boilerplate.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side menu nav navbar "
    "navigation breadcrumb breadcrumbs header footer masthead cookie cookies consent notice notices alert gdpr popup modal newsletter "
    "subscribe subscription signup login share sharing social related recommended comment comments reply replies discussion "
    "disqus widget pagination pager toolbar search contentinfo complementary".split()
)
#: Words that may stand beside such a word in one name, as in "comment-list"; others ("no-sidebar") make it say less.
HOLDERS = frozenset("area bar bars block bottom box container inner item items left list outer panel right section thread top wrap wrapper".split())
#: Those that hold for an article element itself, and for a paragraph and the like.
COMMENT_MARKS = frozenset("comment comments reply replies discussion ad ads advert sponsored promo".split())
LEAF_MARKS = frozenset("ad ads advert adverts advertisement sponsor sponsored promo cookie cookies consent newsletter gdpr".split())
LEAVES = frozenset("blockquote dd dt em figcaption h1 h2 h3 h4 h5 h6 li p pre span strong summary td th".split())
#: Parts of a page's words: from ``MAJOR`` on a wrapper is the page itself, from ``WHOLE`` on a marked element is.
MAJOR, WHOLE = 0.5, 0.95

_token = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|iframe|xmp)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>(?P<inside>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-zA-Z!?][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_attribute = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_mark_word = re.compile(r"[a-zA-Z]+")

#: Scores without labelled pages.
DEFAULTS = {"word in": 2.0, "word out": -1.0, "word": 1.0, "link": -0.5}
DEFAULT_TAG = -0.3


@dataclass(slots=True)
class _Element:
    name: str
    attributes: str
    words: int = 0
    textual: bool = False
    closed: bool = False

    def names(self) -> list[list[str]]:
        """The words of each class, of the id and of the role."""
        said = " ".join(["".join(found) for found in _attribute.findall(self.attributes)]) if "=" in self.attributes else ""
        return [[w.lower() for w in _mark_word.findall(name)] for name in said.split()]


def _boilerplate(element: _Element, names: list[list[str]], total: int, in_content: bool) -> bool:
    name, part = element.name, element.words / max(1, total)
    if name in SILENT:
        return True
    if name in ("html", "body") or not element.closed:  # what is never closed may be all the rest
        return False
    if name in MENUS:
        return True
    if name in WRAPPERS and not (name == "header" and in_content) and (part < MAJOR or not element.textual):
        return True
    marks = COMMENT_MARKS if name in CONTENT else LEAF_MARKS if name in LEAVES else MARKS
    # A header in the content element has its heading.
    marked = any(any(w in marks and not (w == "header" and in_content) for w in n) and all(w in MARKS or w in HOLDERS for w in n) for n in names)
    return marked and part < WHOLE


_OPEN, _CLOSE, _VOID, _TEXT = range(4)


def _events(page: str) -> tuple[list[tuple], int]:
    """What a page consists of, with the elements measured, and its number of words.

    (_TEXT, text, words), (_OPEN, element), (_CLOSE, name, elements that end), (_VOID, name).
    """
    events: list[tuple] = []
    stack: list[_Element] = []
    total = 0

    def end(closed: bool) -> _Element:
        gone = stack.pop()
        gone.closed = closed
        if stack:
            stack[-1].words += gone.words
            stack[-1].textual |= gone.textual or gone.name in TEXTUAL
        return gone

    for m in _token.finditer(page):
        text = m.group("text")
        if text is not None:
            words = len(text.split())
            if stack:
                stack[-1].words += words
            total += words
            events.append((_TEXT, text, words))
            continue
        name = m.group("name")
        if name is None:
            continue
        name = name.lower()
        if m.group("close"):
            ended = 0
            if any(e.name == name for e in reversed(stack)):
                while True:
                    ended += 1
                    gone = end(True)
                    if gone.name == name:
                        break
                    if gone.name in MENUS or gone.name in WRAPPERS:
                        gone.closed = False  # another element's end tag ended it
            events.append((_CLOSE, name, ended))
        elif name in VOID or m.group("attributes").endswith("/"):
            events.append((_VOID, name))
        else:
            if name in ("p", "li", "option") and stack and stack[-1].name == name:
                end(True)  # its end tag is optional
                events.append((_CLOSE, "", 1))
            stack.append(_Element(name, m.group("attributes")))
            events.append((_OPEN, stack[-1]))
    while stack:
        end(False)
    return events, total


def tokens(page: str) -> list[tuple[str, str, int]]:
    """(kind, text, block) for each piece of text outside boilerplate, and (kind, "", block) for each tag and mark.

    Text kinds are those of DEFAULTS; an inline tag keeps the block, a block tag starts the next.
    """
    out: list[tuple[str, str, int]] = []
    events, total = _events(page)
    stack: list[str] = []
    content = links = block = element = skip_from = 0
    elements: list[int] = []  # the outermost content element of each piece, 0 for none
    for event in events:
        what = event[0]
        if what == _TEXT:
            if not skip_from:
                out.append(("link" if links else "word in" if content else "word out", event[1], block))
                elements.append(element if content else 0)
            continue
        name = event[1].name if what == _OPEN else event[1]
        if name in BLOCKS:
            block += 1
        if name and not skip_from:
            out.append((f"tag {name}", " " if name in SPACES else "", block))
            elements.append(0)
        if what == _CLOSE:
            for _ in range(event[2]):
                gone = stack.pop()
                content -= gone in CONTENT
                links -= gone == "a"
                if len(stack) < skip_from:
                    skip_from = 0
        elif what == _OPEN:
            stack.append(name)
            if name in CONTENT:
                element += content == 0
                content += 1
            links += name == "a"
            if not skip_from:
                names = event[1].names()
                if _boilerplate(event[1], names, total, content > 0):
                    skip_from = len(stack)
                else:
                    for word in {w for n in names for w in n if w in MARKS}:
                        out.append((f"mark {word}", "", block))
                        elements.append(0)
    if not _labelled(out, elements):
        return [("word" if kind[0] == "w" else kind, text, block) for kind, text, block in out]
    return out


def _is_text(kind: str) -> bool:
    return kind in DEFAULTS


def _labelled(parts: list[tuple[str, str, int]], elements: list[int]) -> bool:
    """Whether one content element holds at least half of the page's words, links aside; teasers and comments do not."""
    if not any(elements):
        return False
    held: Counter = Counter()
    for (kind, text, _), element in zip(parts, elements):
        if kind[0] == "w":
            held[element] += len(text.split())
    return held.total() > 0 and 2 * max((n for element, n in held.items() if element), default=0) >= held.total()


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous run with the largest positive sum, in one scan; the first and shortest of equals, else empty."""
    best, start, stop, total, since = 0.0, 0, 0, 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, since = 0.0, k
        total += score
        if total > best:
            best, start, stop = total, since, k + 1
    return start, stop


def main_text(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    parts = tokens(page)
    scores = []
    for kind, text, _ in parts:
        if _is_text(kind):
            scores.append(weights[kind] * len(text.split()))
        else:
            scores.append(weights.get(kind, DEFAULT_TAG))
    start, stop = best_run(scores)
    if start == stop:
        return ""
    first, last = parts[start][2], parts[stop - 1][2]
    blocks: dict[int, list[str]] = {}
    for kind, text, block in parts:
        if first <= block <= last:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join(references.unescape("".join(b)).split()) for b in blocks.values())
    return "\n".join(line for line in lines if line)


def count_labelled(page: str | None, counts: Counter) -> None:
    """Add how often each kind stands inside and outside the content of a page that labels it."""
    if not page:
        return
    parts = tokens(page)
    if not any(kind == "word in" for kind, _, _ in parts):
        return
    inside = False
    for kind, text, _ in parts:
        if kind in ("tag article", "tag main"):
            inside = not inside
        if not _is_text(kind):
            counts[kind, inside] += 1
        else:
            counts[kind, inside] += len(text.split())
            if kind in ("word in", "word out"):
                counts["word", inside] += len(text.split())


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weights from about ``sample_pages`` pages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch["html"]:
                count_labelled(page, counts)
        rows = [(kind, inside, n) for (kind, inside), n in counts.items()]
        yield pd.DataFrame(rows, columns=["kind", "inside", "n"])

    total = max(1, pages.count())
    draw = F.pmod(F.xxhash64(F.lit("page sample"), "page_id", "url"), F.lit(1 << 30)) / (1 << 30)
    sample = pages.where(draw < sample_pages / total).select("html")
    rows = sample.mapInPandas(run, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n"))
    counts = {(r["kind"], r["inside"]): r["n"] for r in rows.collect()}
    weights = dict(DEFAULTS)
    for kind in {k for k, _ in counts}:
        odds = float(np.log((counts.get((kind, True), 0) + 1) / (counts.get((kind, False), 0) + 1)))
        if not _is_text(kind):
            weights[kind] = min(-0.05, max(-3.0, odds))
        elif kind == "word out" or kind == "link":
            weights[kind] = min(-0.1, max(-3.0, odds))
        else:
            weights[kind] = min(3.0, max(0.5, odds))
    return weights


def extract(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""

    @F.pandas_udf("string")
    def text(batch: pd.Series) -> pd.Series:
        return batch.map(lambda page: main_text(page, weights), na_action=None)

    made = pages.select("page_id", "url", text("html").alias("text"))
    return made.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
