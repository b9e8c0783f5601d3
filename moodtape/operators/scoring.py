"""Scoring of articles: selection, model batches, lexicon scorer, labels."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodtape.functions.numeric import ColumnLike, as_col, round_half_up, softmax
from moodtape.functions.text import MIN_SCORED_TEXT, WORD, clean_text_rows

log = logging.getLogger(__name__)

# Fixed value: texts per model call.
MODEL_BATCH = 16

PROBABILITIES = ("p_positive", "p_negative", "p_neutral")

# A scorer takes cleaned texts and returns one (positive, negative, neutral)
# probability row per text.
Scorer = Callable[[list[str]], np.ndarray]


@dataclass(frozen=True)
class Lexicon:
    """Word weights for the built-in scorer, words in lower case."""

    positive: dict[str, float] = field(default_factory=dict)
    negative: dict[str, float] = field(default_factory=dict)
    sharpness: float = 4.0
    neutral: float = 1.0


MARKET_LEXICON = Lexicon(
    positive={
        **dict.fromkeys("gain gains growth profit profits rise rises rally up strong higher beat beats upgrade".split(), 1.0),
        **dict.fromkeys("surge surges soar soars record outperform bullish".split(), 2.0),
    },
    negative={
        **dict.fromkeys("fall falls loss losses drop drops decline down weak lower miss misses downgrade".split(), 1.0),
        **dict.fromkeys("plunge plunges crash fraud default bankruptcy bearish".split(), 2.0),
    },
)


def unscored(raw: DataFrame, scored: DataFrame, day: str | None = None) -> DataFrame:
    """Articles long enough to score that have no score yet.

    No ordering: scores do not depend on the order of the batches.
    """
    if day is not None:
        raw = raw.filter(F.col("collected_date") == F.to_date(F.lit(day)))
    todo = raw.filter(F.col("raw_text").isNotNull() & (F.length("raw_text") > MIN_SCORED_TEXT))
    return todo.join(scored.select(F.col("raw_id").alias("id")), "id", "left_anti")


def _weight_in(tokens: Column, words: dict[str, float]) -> Column:
    def count_of(group: list[str]) -> Column:
        return F.size(F.filter(tokens, lambda t: t.isin(group)))

    total = F.lit(0.0)
    for weight in sorted(set(words.values())):
        total = total + count_of(sorted(w for w, x in words.items() if x == weight)) * F.lit(weight)
    return total


def lexicon_probabilities(df: DataFrame, text: ColumnLike, lexicon: Lexicon = MARKET_LEXICON) -> DataFrame:
    """Probabilities from weighted word counts over the whole text, row by row in the JVM."""
    tokens = F.regexp_extract_all(F.lower(as_col(text)), F.lit(rf"([{WORD}]+)"), 1)
    known = [*lexicon.positive, *lexicon.negative]
    weighed = df.withColumn("_tokens", F.filter(tokens, lambda t: t.isin(known))).withColumns(
        {"_pos": _weight_in(F.col("_tokens"), lexicon.positive), "_neg": _weight_in(F.col("_tokens"), lexicon.negative)}
    )
    hits = F.col("_pos") + F.col("_neg") + 1.0
    shares = [F.col(c) * lexicon.sharpness / hits for c in ("_pos", "_neg")]
    probabilities = softmax(*shares, F.lit(lexicon.neutral))
    return weighed.withColumns(dict(zip(PROBABILITIES, probabilities))).drop("_tokens", "_pos", "_neg")


def batch_probabilities(
    df: DataFrame,
    text: str,
    load_scorer: Callable[[], Scorer],
    batch_size: int = MODEL_BATCH,
    failed: Accumulator | None = None,
) -> DataFrame:
    """The other columns with probabilities from any model, in Arrow batches on the executors.

    ``load_scorer`` runs once per task; memoise it in its own module to load once
    per worker process.  A model that cannot be loaded fails the task.  A batch
    the model fails on yields no rows, so its texts stay unscored and the next
    run takes them up again; ``failed``, an accumulator, counts them.  The text
    goes to the model whole and does not come back.
    """
    kept = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType(kept + [T.StructField(p, T.DoubleType()) for p in PROBABILITIES])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = None
        for frame in frames:
            if scorer is None and len(frame):
                scorer = load_scorer()
            for start in range(0, len(frame), batch_size):
                part = frame.iloc[start : start + batch_size]
                try:
                    found = np.asarray(scorer(part[text].tolist()), dtype="float64")
                except Exception:
                    log.exception("a batch of %d texts could not be scored", len(part))
                    if failed is not None:
                        failed.add(len(part))
                    continue
                yield part.drop(columns=text).assign(**{p: found[:, i] for i, p in enumerate(PROBABILITIES)})

    return df.mapInPandas(run, schema)


def scores(df: DataFrame) -> DataFrame:
    """Label, rounded scores, confidence and compound from the three probabilities.

    On a tie the label earlier in the order positive, negative, neutral wins.
    """
    pos, neg, neu = (F.col(p) for p in PROBABILITIES)
    label = (
        F.when((pos >= neg) & (pos >= neu), F.lit("positive")).when(neg >= neu, F.lit("negative")).otherwise(F.lit("neutral"))
    )
    return df.withColumns(
        {
            "label": label,
            "score_positive": round_half_up(pos, 4),
            "score_negative": round_half_up(neg, 4),
            "score_neutral": round_half_up(neu, 4),
            "confidence": round_half_up(F.greatest(pos, neg, neu), 4),
            "compound_score": round_half_up(pos - neg, 4),
        }
    ).drop(*PROBABILITIES)


def score_articles(
    raw: DataFrame,
    scored: DataFrame,
    day: str | None = None,
    load_scorer: Callable[[], Scorer] | None = None,
    lexicon: Lexicon = MARKET_LEXICON,
    failed: Accumulator | None = None,
) -> DataFrame:
    """New ``sentiment_scored`` rows: select, clean, score, label.

    With ``load_scorer`` the texts go through that model, without one the
    lexicon scorer reads them; either gets whole texts.
    """
    todo = unscored(raw, scored, day).select(
        F.col("id").alias("raw_id"),
        "ticker",
        "source",
        "upvotes",
        F.col("collected_date").alias("scored_date"),
        clean_text_rows("raw_text").alias("_text"),
    )
    found = (
        batch_probabilities(todo, "_text", load_scorer, failed=failed) if load_scorer else lexicon_probabilities(todo, "_text", lexicon)
    )
    return scores(found).drop("_text")


