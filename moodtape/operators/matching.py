"""Which tickers does a text mention?  Whole-word keyword search by runs of characters.

Text and keyword are both cut into alternating runs of word and non-word
characters.  A keyword occurs as a whole word exactly when its runs appear as
consecutive runs of the text, so the search compares short run sequences
("grams") with the keyword table: no regular expression per keyword and no
pairing of every text with every keyword.  ``M&M`` or ``BAJAJ-AUTO`` need no
special case.

Keywords come in few shapes (how many runs, a word or a symbol at either end),
and one pattern per shape finds all grams of it in one pass over the text, the
overlapping ones too; its first run is as long as that of some keyword of the
shape, so the many other words of a text are passed over.  Grams of several runs
are looked for only in texts that hold the first word of such a keyword.  A dictionary of up to ``IN_PLACE`` keywords then comes to
every task as one array, and a text's grams are compared with it on the spot, so
texts are neither exploded nor shuffled.  A larger dictionary is joined on the
grams: broadcast up to ``BROADCAST_BYTES``, shuffled beyond, then by grams and
128-bit digests of texts; the side of the texts is never the one that is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtape.functions.numeric import ColumnLike, as_col
from moodtape.functions.text import WORD

IN_PLACE, BROADCAST_BYTES = 8192, 64 << 20
_WORD_START = rf"^[{WORD}]"
_WORD_RUN, _OTHER_RUN = f"[{WORD}]++", f"[^{WORD}]++"

Shape = tuple[int, bool, bool]
#: Of each shape the least and the greatest length of its keywords' first runs.
Shapes = dict[Shape, tuple[int, int]]


def _shape_pattern(n: int, word_first: bool, word_last: bool, least: int, most: int) -> str:
    """Finds, in group 1, every sequence of ``n`` whole runs, also where it overlaps another.

    The first run has ``least`` to ``most`` characters.  A keyword that starts
    (ends) with a symbol needs a word right before (after) it, as a word boundary
    lies between a word and a non-word character.
    """
    first = f"[{'' if word_first else '^'}{WORD}]{{{least},{most}}}+"
    runs = first + "".join(_WORD_RUN if (k % 2 == 0) == word_first else _OTHER_RUN for k in range(1, n))
    if n == 1 and word_first:
        return f"(?<![{WORD}])({runs})(?![{WORD}])"
    before = f"(?<![{WORD}])" if word_first else f"(?<=[{WORD}])"
    after = "" if word_last else f"(?=[{WORD}])"
    return f"{before}(?=({runs}){after})."


def _words(text: Column, least: int, most: int) -> Column:
    """The words of a text that have so many characters."""
    return F.regexp_extract_all(text, F.lit(_shape_pattern(1, True, True, least, most)), 1)


def _grams(text: Column, words: Column, shapes: Shapes, worthwhile: Column) -> Column:
    """The grams of all shapes that a text holds; of more than one run only where they are worthwhile."""
    found = []
    for shape, lengths in shapes.items():
        grams = F.regexp_extract_all(text, F.lit(f"(?s){_shape_pattern(*shape, *lengths)}"), 1)
        if shape == (1, True, True):
            grams = words
        elif shape[0] > 1:
            grams = F.when(worthwhile, grams).otherwise(F.array().cast("array<string>"))
        found.append(grams)
    return F.concat(*found)


def _prepared(keywords: DataFrame) -> DataFrame:
    """ticker, gram, the gram's shape and its first run's length."""
    runs = F.regexp_count("gram", F.lit(f"{_WORD_RUN}|{_OTHER_RUN}"))
    return (
        keywords.filter("keyword <> ''")
        .select("ticker", F.upper("keyword").alias("gram"))
        .distinct()
        .withColumn("n", runs)
        .withColumn("word_first", F.col("gram").rlike(_WORD_START))
        .withColumn("word_last", F.col("gram").rlike(rf"[{WORD}]$"))
        .withColumn("length", F.length(F.regexp_extract("gram", f"^({_WORD_RUN}|{_OTHER_RUN})", 1)))
    )


def with_tickers(
    df: DataFrame,
    keywords: DataFrame,
    text: ColumnLike = "raw_text",
    in_place: int = IN_PLACE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per (input row, mentioned ticker); rows without a mention are dropped.

    ``keywords`` has (ticker, keyword) rows.  Of these only the shapes, their
    number, their size and the lengths of their first runs and words come to the
    driver, and decide how they meet the texts.
    """
    first_word = F.when(F.col("n") > 1, F.regexp_extract("gram", f"({_WORD_RUN})", 1))
    table = _prepared(keywords).withColumn("first", first_word)
    size = [F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("gram") + F.octet_length("ticker") + 64).alias("bytes")]
    lengths = [F.min("length").alias("least"), F.max("length").alias("most")]
    word = F.length("first")
    kinds = table.groupBy("n", "word_first", "word_last").agg(*size, *lengths, F.min(word).alias("short"), F.max(word).alias("long")).collect()
    shapes = {(r["n"], r["word_first"], r["word_last"]): (r["least"], r["most"]) for r in sorted(kinds)}
    if not shapes:
        return df.withColumn("ticker", F.lit(None).cast("string")).filter(F.lit(False))
    entries = table.select("ticker", "gram", "first")
    if sum(r["rows"] for r in kinds) <= in_place:
        # words that are keywords themselves, and those that begin longer ones
        told = [shapes.get((1, True, True)), *((r["short"], r["long"]) for r in kinds if r["n"] > 1)]
        told = [x for x in told if x] or [(1, 1)]
        return _matched_in_place(df, entries, as_col(text), shapes, (min(x for x, _ in told), max(x for _, x in told)))
    return _matched_by_join(df, entries, as_col(text), shapes, sum(r["bytes"] for r in kinds) <= broadcast_bytes)


def _generated(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that is computed once, whatever is asked of it later: a filter on it is not pushed below it."""
    return df.withColumn(name, F.explode(F.array(value)))


def _matched_in_place(df: DataFrame, entries: DataFrame, text: Column, shapes: Shapes, words: tuple[int, int]) -> DataFrame:
    """Grams compared with the whole dictionary, an array that Spark makes once."""
    every, first = entries.agg(F.collect_set("gram")).scalar(), entries.agg(F.collect_set("first")).scalar()
    named = entries.agg(F.collect_list(F.struct("gram", "ticker"))).scalar()
    upper = F.upper(text)
    worded = _generated(df.drop("ticker"), "_words", _words(upper, *words))
    grams = _grams(upper, F.col("_words"), shapes, F.arrays_overlap("_words", first))
    found = _generated(worded, "_found", F.array_intersect(every, grams)).drop("_words").filter(F.size("_found") > 0)
    tickers = F.transform(F.filter("_named", lambda e: F.array_contains("_found", e.gram)), lambda e: e.ticker)
    return found.withColumn("_named", named).withColumn("ticker", F.explode(F.array_distinct(tickers))).drop("_found", "_named")


def _matched_by_join(df: DataFrame, entries: DataFrame, text: Column, shapes: Shapes, small: bool) -> DataFrame:
    """Grams joined with the dictionary.

    Mentions are found per digest of the text, as equal texts have equal mentions;
    so only digests and grams meet the keywords, copies of a text merge, and no
    key is asked of the rows.
    """
    keyed = df.withColumn("_digest", F.substring(F.unhex(F.sha2(text, 256)), 1, 16))
    upper = F.upper(text)
    words = _words(upper, *shapes.get((1, True, True), (1, 1)))
    grams = F.array_distinct(_grams(upper, words, shapes, F.lit(True)))
    exploded = keyed.select("_digest", F.explode(grams).alias("gram"))
    known = entries.select("ticker", "gram").hint("broadcast" if small else "merge")
    pairs = exploded.join(known, "gram").select("_digest", "ticker").distinct()
    return keyed.drop("ticker").join(pairs.hint("merge"), "_digest").drop("_digest")
