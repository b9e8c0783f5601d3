"""Small helpers the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtape.operators.dedup import may_be_among  # noqa: F401
from moodtape.session import work_path

#: The blanks of the contracts: space, tab, newline, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[ \\t\\n\\x0B\\f\\r]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    path = work_path(df.sparkSession, label)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(text: Column | str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: Column) -> Column:
    """How many runs of characters other than BLANKS the text has."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, BLANK_RUN))).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is.  A text of ASCII alone takes the cheap way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def without_blanks(text: Column) -> Column:
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file; the package is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
