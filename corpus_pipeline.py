"""The corpus pipeline: each stage applies one operator to all that its predecessor kept.

Language identification, exact deduplication, near deduplication, mixing of sources, encoding.  The last stage's rows
are the encoded corpus; all others have the columns of ``documents``.

Edge cases.  Null, empty and blank texts, and others without a letter, go in the first stage, as no language can be told.
Rows that repeat are exact copies: one of them stays.  Of equal texts the longest original stays, then the smallest
doc_id; of near copies the smallest doc_id.  A document that the mix takes twice is two rows with one doc_id from then on.
Null sources are a source of their own, null labels are predicted like any other.  Texts of any length are taken whole.  An
empty table gives empty stages and an empty result.  Columns that ``documents`` doesn't have in the given tables go
through all stages but the last, whatever they are called.  A stage's table is written under the shared folder and
removed once the next stage has been written, so that two copies of the texts exist at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtape.llm import exact_dedup, language, mixing, near_dedup, pieces
from moodtape.llm.common import tokenizer_path
from moodtape.session import work_path
from moodtape.sources.files import Files

PIECES = "piece_bpe_32k.model"
#: Entries of the encoder's tables, smaller than alone, as the executors keep memory of the stages before.
TABLE = 60_000
#: Rows of an Arrow batch.  Batches of thousands of whole texts would be held beside the heap, by Spark and by each worker.
BATCH_ROWS, BATCH_SETTING = 500, "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches have up to BATCH_ROWS rows; a smaller setting stays."""
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts without a letter, in no learned language or in none at all go."""
    small_batches(spark)
    model = language.fit(docs.where(~language.held_out()))
    model = language.with_limits(model, docs.where(language.held_out()))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("it"), F.col("text").alias("text"))
    return language.identify(whole, model).where(F.col("lang_pred") != language.UNKNOWN).select("it.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal texts."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, a similarity of 0.8 or more."""
    small_batches(spark)
    return near_dedup.drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight asks."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens: the mixed corpus as token ids, an end id last."""
    small_batches(spark)
    # Texts go to the encoder and don't come back.
    made = pieces.with_ids(docs.select("doc_id", "lang", "source", "text"), tokenizer_path(PIECES), keep_text=False, table=TABLE)
    return made.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("source_mix", source_mix),
    ("encoding", encoded),
]

# Hashed sketches, trained classifiers and piece merges are beyond SQL; tests/llm holds the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        made = stage(spark, docs, sf_dir)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            Files(spark).delete(before)
        before = path
    return docs
