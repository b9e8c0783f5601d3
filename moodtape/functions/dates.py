"""Publication dates of articles: the wall time as written, offset ignored."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodtape.functions.numeric import ColumnLike, as_col

_RFC822 = (
    r"^\s*(?:[A-Za-z]{3,9}\.?,?\s+)?(\d{1,2})[\s-]+([A-Za-z]{3})[A-Za-z]*[\s-]+(\d{2,4})"
    r"\s+(\d{1,2}):(\d{2})(?::(\d{2}))?"
)
_ISO = r"^(\d{4}-\d{2}-\d{2})(?:.(\d{2}):?(\d{2})(?::?(\d{2}))?(?:[.,]\d+)?(?:Z|[+-]\d{2}(?::?\d{2})?)?)?$"


def _part(c: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(c, pattern, group)


def parse_rfc822(c: ColumnLike) -> Column:
    """``Mon, 05 Jan 2026 10:20:30 +0530`` -> 2026-01-05 10:20:30, else NULL."""
    c = as_col(c)
    year = _part(c, _RFC822, 3)
    short = year.try_cast("int")
    full_year = (
        F.when(F.length(year) >= 4, year)
        .when(short < 69, (short + 2000).cast("string"))
        .otherwise((short + 1900).cast("string"))
    )
    seconds = F.when(_part(c, _RFC822, 6) == "", F.lit("00")).otherwise(_part(c, _RFC822, 6))
    text = F.concat_ws(
        " ",
        _part(c, _RFC822, 1),
        F.initcap(_part(c, _RFC822, 2)),
        full_year,
        F.concat_ws(":", F.lpad(_part(c, _RFC822, 4), 2, "0"), _part(c, _RFC822, 5), seconds),
    )
    return F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss"))


def parse_iso(c: ColumnLike) -> Column:
    """``2026-01-05T10:20:30Z`` -> 2026-01-05 10:20:30, else NULL."""
    c = as_col(c)
    clock = [F.when(_part(c, _ISO, g) == "", F.lit("00")).otherwise(_part(c, _ISO, g)) for g in (2, 3, 4)]
    text = F.concat_ws(" ", _part(c, _ISO, 1), F.concat_ws(":", *clock))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))


def first_date(parsed: list[Column], fallback: ColumnLike) -> Column:
    """First date that parses, else the time of ingest (given, never read here)."""
    return F.coalesce(*parsed, as_col(fallback))
