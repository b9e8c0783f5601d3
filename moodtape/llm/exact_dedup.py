"""Exact deduplication by a tree merge of sorted digest runs.

Texts are equal when they are identical after all blanks are deleted.  Every input partition becomes one run of
(digest, best row, rows), sorted by digest.  In each round groups of ``fan`` neighbouring runs are merged into one,
so after log_fan(partitions) rounds a single run is left; each level keeps, for every digest, the best row seen so
far and the number of rows.  A level is one shuffle of narrow rows, combined before they are sent, so a text that
makes up a third of the corpus costs one row a task.  Whole texts are never shuffled for the decision.

Edge cases.  A null text counts as empty; empty texts equal each other.  Among rows with equal texts the one with
most code points stays, then the smallest doc_id; a null doc_id comes last.  Rows that repeat the doc_id of the row
that stays count as that row in ``mark_copies``; ``drop_copies`` leaves one of them.  An empty table gives an empty
result.  Columns of the input other than doc_id and text play no part, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtape.llm.common import may_be_among, staged, whole_text, without_blanks

FAN = 16


def _digest(text):
    return F.unhex(F.sha2(without_blanks(text).cast("binary"), 256))


def _second_hash(text):
    bare = without_blanks(text)
    return F.xxhash64(bare, F.char_length(bare))


def _verified(value, low: str, high: str):
    """The value, unless the texts behind one digest differ."""
    clash = F.raise_error(F.concat(F.lit("one digest for different texts: "), F.hex("digest"))).cast("long")
    return F.when(F.col(low) == F.col(high), value).otherwise(clash)


def _runs(docs: DataFrame) -> DataFrame:
    """One sorted run of digests for each input partition."""
    text = whole_text()
    rows = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.char_length(text).cast("long").alias("chars"),
        _digest(text).alias("digest"),
        _second_hash(text).alias("second"),
        F.spark_partition_id().alias("run"),
    )
    return staged(rows.sortWithinPartitions("digest"), "digest-runs")


def _merge_runs(runs: DataFrame, fan: int) -> DataFrame:
    """digest, keep_id, group_size: all runs merged, ``fan`` at a time."""
    best = runs.select(
        "run",
        "digest",
        F.struct((-F.col("chars")).alias("shorter"), F.col("doc_id").isNull().alias("nameless"), "doc_id").alias("best"),
        F.lit(1).cast("long").alias("rows"),
        F.col("second").alias("low"),
        F.col("second").alias("high"),
    )
    left = (runs.agg(F.max("run")).first()[0] or 0) + 1
    while True:
        left = -(-left // fan)
        best = (
            best.withColumn("run", F.floor(F.col("run") / fan).cast("int"))
            .groupBy("run", "digest")
            .agg(F.min("best").alias("best"), F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"))
            .withColumn("rows", _verified(F.col("rows"), "low", "high"))
        )
        if left == 1:
            return best.select("digest", F.col("best.doc_id").alias("keep_id"), F.col("rows").alias("group_size"))


def _groups(runs: DataFrame, fan: int) -> DataFrame:
    """The texts that occur more than once."""
    return staged(_merge_runs(runs, fan).where("group_size > 1"), "digest-groups")


def mark_copies(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    runs = _runs(docs)
    joined = runs.drop("run", "second").join(_groups(runs, fan), "digest", "left")
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    columns = docs.columns
    runs = _runs(docs)
    groups = _groups(runs, fan)
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), _digest(whole_text()).alias("digest"))
    # Texts that surely have no copy stay where they are; only the others are shuffled.
    shared = may_be_among(F.col("digest"), groups.select("digest"))
    single = F.col("group_size").isNull()
    joined = marked.where(shared).join(groups, "digest", "left").where(single | F.col("row.doc_id").eqNullSafe(F.col("keep_id")))
    kept = marked.where(~shared).unionByName(joined.select("row", "digest"))
    repeated = staged(runs.groupBy("digest", "doc_id").agg(F.count("*").alias("rows")).where("rows > 1"), "digest-repeats")
    if not repeated.isEmpty():
        again = repeated.select(F.col("digest").alias("again"), F.col("doc_id").alias("again_id"))
        same = (F.col("digest") == F.col("again")) & F.col("row.doc_id").eqNullSafe(F.col("again_id"))
        once = kept.join(again, same, "left_semi").dropDuplicates(["digest"])
        kept = kept.join(again, same, "left_anti").unionByName(once)
    return kept.select("row.*")
