"""First-wins deduplication and key-based merges of frames."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtape.session import work_path


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order, one row per key.

    Spark keeps only the first row per key inside every map task before the
    shuffle (the row_number = 1 filter becomes a partial group limit), so a key
    that holds a third of all rows sends one row per task and no more.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def may_be_among(column: Column, keys: DataFrame, bits_a_key: int = 12, most_bits: int = 1 << 25) -> Column:
    """False only for values that ``keys`` (one column) does not hold: a Bloom filter of bounded size.

    It keeps rows from a shuffle that a semi-join would drop after it; with more keys than its bits can tell apart it
    lets everything through, so the semi-join must follow.  Spark makes it once, as an array of 64-bit words.
    """
    spark, key = keys.sparkSession, keys.columns[0]
    bits = 64
    wanted = bits_a_key * keys.count()
    while bits < min(wanted, most_bits):
        bits *= 2

    def places(value: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(k), value), F.lit(bits)) for k in range(3)]

    set_bits = keys.select(F.explode(F.array(*places(F.col(key)))).alias("at"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
    words = set_bits.groupBy(F.floor(F.col("at") / 64).alias("id")).agg(F.bit_or(one).alias("word"))
    every = spark.range(bits // 64).join(words, "id", "left").select("id", F.coalesce("word", F.lit(0).cast("long")).alias("word"))
    table = every.agg(F.sort_array(F.collect_list(F.struct("id", "word"))).alias("words")).select("words.word").scalar()
    held = F.lit(True)
    for at in places(column):
        held = held & (F.getbit(F.element_at(table, (F.floor(at / 64) + 1).cast("int")), (at % 64).cast("int")) == 1)
    return held


def first_of_few(
    df: DataFrame, key: Column, rows: Callable[[DataFrame], DataFrame], keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """As ``first_per_key`` over ``rows(df)``, where wide rows with a key of their own are not shuffled.

    ``rows`` makes the rows of each input row from that row alone.  ``key`` is taken from the input rows: those whose
    ``key`` differs never have the same ``keys``, nor does one input row make two rows with the same.  The inputs are
    read for it first, and what is shuffled then is one hash each; the hashes that occur more than once are stored, and
    only rows whose hash may be one of them go on to meet each other.
    """
    spark, hashed = df.sparkSession, F.xxhash64(key)
    path = work_path(spark, "repeated-keys")
    counted = df.select(hashed.alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    counted.filter("rows > 1").select("key").write.parquet(path)
    repeated = spark.read.schema("key bigint").parquet(path)
    if repeated.isEmpty():
        return rows(df)
    again = may_be_among(hashed, repeated)
    return rows(df.filter(~again)).unionByName(first_per_key(rows(df.filter(again)), keys, order))


def first_by_unique(df: DataFrame, keys: Sequence[str], unique: str) -> DataFrame:
    """As ``first_per_key`` where one column orders the rows and is unique.

    Only the keys and that column are shuffled to find the first rows; the rows
    themselves then meet nothing but the ids of those.
    """
    first = df.groupBy(*keys).agg(F.min(unique).alias(unique)).select(unique)
    return df.join(first, unique, "left_semi")


def first_per_full_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """As ``first_per_key``, but rows with a NULL in the key are all kept.

    That is how a SQL UNIQUE constraint treats them.  Each such row gets a group
    of its own, which also spreads them over the tasks.
    """
    incomplete = F.lit(False)
    for k in keys:
        incomplete = incomplete | F.col(k).isNull()
    own = df.withColumn("_own", F.when(incomplete, F.monotonically_increasing_id()))
    return first_per_key(own, [*keys, "_own"], order).drop("_own")


def not_stored(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet.

    The stored keys are first cut down to those that come in again.  The history
    is then the streamed side of a semi-join against one run's keys, which needs
    no shuffle of the history as long as these keys are small enough for Spark to
    broadcast by their measured size, and one shuffle of bare keys otherwise.
    """
    keys = list(keys)
    again = existing.select(*keys).join(incoming.select(*keys), keys, "left_semi")
    return incoming.join(again, keys, "left_anti")


def new_rows(incoming: DataFrame, existing: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first incoming row of each key that is not stored yet (insert-or-ignore)."""
    return not_stored(first_per_full_key(incoming, keys, order), existing, keys)


def replaced(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows with an incoming key removed, all incoming rows added."""
    keys = list(keys)
    kept = existing.join(incoming.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)
