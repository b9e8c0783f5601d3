"""Text clean-up as Column expressions; nothing here leaves the JVM."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodtape.functions.numeric import ColumnLike, as_col

# Character classes spelled out, as \w and \s mean different sets in different
# regex engines.  WORD: letters, numbers, underscore.  SPACE: Unicode blanks.
WORD = r"\p{L}\p{N}_"
SPACE = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

_SPACES = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)

# Lengths, in characters, that decide what is kept.
MIN_FEED_TEXT = 20
MIN_TICKER_TEXT = 15
MIN_SCORED_TEXT = 15
MIN_VALID_TEXT = 10

# Web addresses, and the characters a cleaned text may hold.
URL_PATTERN = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+"
DROPPED_PATTERN = rf"[^{WORD}%.,!?₹$\-]+"


def strip_blank(c: ColumnLike) -> Column:
    """Trim every kind of Unicode blank from both ends; a pattern would be tried at every character between them."""
    return F.btrim(as_col(c), F.lit(_SPACES))


def clean_text(c: ColumnLike) -> Column:
    """Drop web addresses and symbols, squeeze blanks; the whole text stays.

    Blanks and dropped characters both end up as one space, so one pass does for
    the two.  What a model can take in at once is the scorer's concern.
    """
    t = F.coalesce(as_col(c), F.lit(""))
    maybe_url = F.contains(t, F.lit("http")) | F.contains(t, F.lit("www."))
    t = F.when(maybe_url, F.regexp_replace(t, URL_PATTERN, "")).otherwise(t)
    return F.trim(F.regexp_replace(t, DROPPED_PATTERN, " "))


def only_if(c: Column, condition: Callable[[Column], Column]) -> Column:
    """The value as a generator: one row where the condition holds, none where it does not.

    For values that are dear to compute.  A filter on a computed column is pushed
    below its computation, which then runs twice.
    """
    return F.explode(F.filter(F.array(c), condition))


def clean_text_rows(c: ColumnLike) -> Column:
    """The cleaned text, without a row where nothing is left."""
    return only_if(clean_text(c), lambda t: t != "")


def full_text(title: ColumnLike, summary: ColumnLike) -> Column:
    """Title and summary in one string, outer blanks removed."""
    parts = [F.coalesce(as_col(c), F.lit("")) for c in (title, summary)]
    return strip_blank(F.concat(parts[0], F.lit(" "), parts[1]))


def source_id(article_id: ColumnLike, url: ColumnLike, ticker: ColumnLike) -> Column:
    """Article id, or its address when absent, tagged with the ticker.

    It is a key, so all of it counts: long ids may differ in their last characters only.
    """
    base = F.coalesce(as_col(article_id), as_col(url), F.lit(""))
    return F.concat(base, F.lit("_"), as_col(ticker))


# What separates two text nodes: script, style and template blocks and ruby
# annotations with their content, comments, declarations, and tags (a quoted
# attribute may hold a '>').  The '<' stands before the choice, so all other
# characters are passed over after one comparison.
_MARKUP = (
    r"(?is)<(?:script\b[^>]*>.*?(?:</script\s*>|\z)"
    r"|style\b[^>]*>.*?(?:</style\s*>|\z)"
    r"|template\b[^>]*>.*?(?:</template\s*>|\z)"
    r"|rt\b[^>]*>.*?(?:</rt\s*>|(?=<rp\b|</ruby)|\z)"
    r"|rp\b[^>]*>.*?(?:</rp\s*>|(?=<rt\b|</ruby)|\z)"
    r"|!--.*?(?:-->|\z)"
    r"|[!?][^>]*>"
    r"""|/?[a-z][^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+'|)[^>=]*+)*+>)"""
)
_REFERENCE_OR_TEXT = (
    r"(&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[a-zA-Z][-.a-zA-Z0-9]*;?|[^&]+|&)"
)


def _named_references() -> str:
    return json.dumps({k[:-1]: v for k, v in html5.items() if k.endswith(";")})


def _legacy_code_points() -> str:
    """Bytes 128..159 read as windows-1252, which is what old pages mean by them."""
    table = {}
    for code in range(128, 160):
        try:
            table[str(code)] = bytes([code]).decode("cp1252")
        except UnicodeDecodeError:
            table[str(code)] = chr(code)
    return json.dumps(table)


def _code_point(c: Column) -> Column:
    as_utf32 = F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32")
    legacy = F.from_json(F.lit(_legacy_code_points()), "map<string,string>")
    valid = (c <= 0x10FFFF) & ~c.between(0xD800, 0xDFFF)
    return (
        F.when(c.between(128, 159), F.try_element_at(legacy, c.cast("string")))
        .when(valid, as_utf32)
        .otherwise(F.lit("\ufffd"))
    )


def _resolve_reference(token: Column) -> Column:
    body = F.rtrim(token, F.lit(";"))
    name, digits, hex_digits = (body.substr(F.lit(start), F.length(body)) for start in (2, 3, 4))
    named = F.from_json(F.lit(_named_references()), "map<string,string>")
    return (
        F.when(~token.startswith("&") | (token == "&"), token)
        .when(body == "&amp", F.lit("&"))
        .when(body == "&lt", F.lit("<"))
        .when(body == "&gt", F.lit(">"))
        .when(body == "&quot", F.lit('"'))
        .when(body == "&nbsp", F.lit("\u00a0"))
        .when(body.rlike("^&#[xX]"), _code_point(F.conv(hex_digits, 16, 10).cast("decimal(20,0)").try_cast("bigint")))
        .when(body.startswith("&#"), _code_point(F.conv(digits, 10, 10).cast("decimal(20,0)").try_cast("bigint")))
        .otherwise(F.coalesce(F.try_element_at(named, name), F.concat(F.lit("&"), name)))
    )


def unescape_html(c: ColumnLike) -> Column:
    """Resolve character references in one left-to-right pass.

    An unknown name stays in the text without its semicolon.
    """
    c = as_col(c)
    tokens = F.regexp_extract_all(c, F.lit(_REFERENCE_OR_TEXT), 1)
    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(tokens, _resolve_reference), "")).otherwise(c)


def clean_html(c: ColumnLike) -> Column:
    """Visible text of an HTML fragment: its text nodes, trimmed, one space apart."""
    nodes = F.split(F.coalesce(as_col(c), F.lit("")), _MARKUP, -1)
    nodes = F.transform(nodes, lambda n: strip_blank(unescape_html(n)))
    return F.array_join(F.filter(nodes, lambda n: n != ""), " ")
