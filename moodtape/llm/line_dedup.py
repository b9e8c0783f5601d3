"""Dropping lines that repeat across documents, with levelled sorted runs of line hashes.

Documents come in batches.  A batch's line keys, counted by document, are joined with the runs already there: keys
not yet in any run (the anti-join) become a new sorted run on level 0, keys already known become updates.  When a
level holds ``fan`` runs they are merged into one run of the next level.  So each key is in exactly one run, and what
a batch costs depends on the batch and on narrow rows of hashes, not on the texts seen before.  At the end the counts
of a key are those of its run entry and its updates.

A key is hashed to 128 bits.  Everything is DataFrame operations; a line that a third of all documents hold is
combined before each shuffle, and the joins can be split.

Edge cases.  A null or empty text is one empty line.  Lines are counted once for each doc_id, rows that repeat a
doc_id together count as one document, null doc_ids as one more.  A row's lines are found again by doc_id and text,
so repeated doc_ids with different texts don't mix.  If all lines go, the rest is the empty text.  An empty table
gives an empty result.  Other columns of the input play no part in the decision; ``drop_lines`` keeps them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtape.llm.common import BLANKS, ascii_lower, staged, whole_text

MIN_CHARS, MIN_DOCS = 20, 3
BATCHES, FAN = 4, 2


class LineRuns:
    """Runs by level; each is (h1, h2, n_docs, last_doc), sorted, and no key is in two of them."""

    def __init__(self, fan: int = FAN):
        self.fan = fan
        self.levels: list[list[DataFrame]] = []
        self.updates: list[DataFrame] = []

    def runs(self) -> DataFrame | None:
        every = [run for level in self.levels for run in level]
        return reduce(DataFrame.unionByName, every) if every else None

    def add(self, counted: DataFrame) -> None:
        """Merge-anti-join a batch's (h1, h2, n_docs, last_doc) with the runs and add what is new."""
        before = self.runs()
        if before is None:
            fresh = counted
        else:
            known = before.select("h1", "h2", F.lit(True).alias("known"))
            split = counted.join(known, ["h1", "h2"], "left").withColumn("known", F.coalesce("known", F.lit(False)))
            split = staged(split.select(*counted.columns, "known"), "line-batch", "known")
            fresh = split.where(~F.col("known")).drop("known")
            self.updates.append(split.where("known").drop("known"))
        self._put(0, fresh)

    def _put(self, level: int, rows: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        run = rows.repartition("h1").sortWithinPartitions("h1", "h2")
        self.levels[level].append(staged(run, f"line-run-{level}"))
        if len(self.levels[level]) >= self.fan:
            merged = reduce(DataFrame.unionByName, self.levels[level])
            self.levels[level] = []
            self._put(level + 1, merged)

    def frequent(self, min_docs: int) -> DataFrame | None:
        """h1, h2, last_doc of the keys that at least ``min_docs`` documents hold."""
        runs = self.runs()
        if runs is None:
            return None
        n, last = F.col("n_docs"), F.col("last_doc")
        if self.updates:
            more = reduce(DataFrame.unionByName, self.updates).groupBy("h1", "h2")
            more = more.agg(F.sum("n_docs").alias("more"), F.max("last_doc").alias("later"))
            runs = runs.join(more, ["h1", "h2"], "left")
            n, last = n + F.coalesce("more", F.lit(0)), F.greatest(last, "later")
        return runs.select("h1", "h2", n.alias("n_docs"), last.alias("last_doc")).where(F.col("n_docs") >= min_docs)


def _row_key():
    return F.xxhash64(whole_text())


def _lines(docs: DataFrame, min_chars: int, batches: int) -> DataFrame:
    """doc_id, row, pos and hash of every line that is long enough to count."""
    lines = docs.select(
        F.col("doc_id").alias("doc_id"), _row_key().alias("row"), F.posexplode(F.split(whole_text(), "\n")).alias("pos", "line")
    )
    key = ascii_lower(F.btrim("line", F.lit(BLANKS)))
    lines = lines.withColumn("key", key).where(F.char_length("key") >= min_chars)
    return lines.select(
        "doc_id",
        "row",
        "pos",
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit("second"), "key").alias("h2"),
        F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"),
    )


def find_repeated(docs: DataFrame, min_chars=MIN_CHARS, min_docs=MIN_DOCS, batches=BATCHES, fan=FAN) -> DataFrame:
    """doc_id, row, drops: the positions of the lines that go, for each row that loses any."""
    lines = staged(_lines(docs, min_chars, batches), "lines", "batch")
    runs = LineRuns(fan)
    for batch in range(batches):
        held = lines.where(F.col("batch") == batch).groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
        runs.add(held.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")))
    frequent = staged(runs.frequent(min_docs).drop("n_docs"), "line-frequent")
    dropped = lines.join(frequent, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
    return dropped.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("drops"))


def _with_rest(docs: DataFrame, **limits: int) -> DataFrame:
    """Every row as ``it``, with n_lines, n_dropped and the text that is left."""
    drops = find_repeated(docs, **limits)
    drops = drops.select(F.col("doc_id").alias("drop_id"), F.col("row").alias("drop_row"), "drops")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("it"), _row_key().alias("row"))
    same = F.col("it.doc_id").eqNullSafe(F.col("drop_id")) & (F.col("row") == F.col("drop_row"))
    text = whole_text(F.col("it.text"))
    # The lines are a column of their own: inside the lambda the split would run once for each line.
    joined = rows.join(drops, same, "left").select("it", "drops", F.split(text, "\n").alias("lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    rest = F.array_join(F.transform(left, lambda i: F.col("lines")[i]), "\n")
    return joined.select(
        "it",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drops").isNull(), text).otherwise(rest).alias("rest"),
    )


def drop_lines(docs: DataFrame, **limits: int) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``; all columns stay."""
    kept = [F.col("rest").alias("text") if c == "text" else F.col(f"it.`{c}`").alias(c) for c in docs.columns]
    return _with_rest(docs, **limits).select(*kept)


def line_report(docs: DataFrame, **limits: int) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 for every row."""
    return _with_rest(docs, **limits).select(
        F.col("it.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("rest").cast("binary"), 256).alias("kept_sha256")
    )
