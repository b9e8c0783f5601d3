"""Language identification in two levels: the family first, then the languages in it.

A text becomes hashed counts of byte trigrams of the lower-cased whole text, square-rooted and scaled to length one.
Linear support vector machines (squared hinge, one against one) first vote for the language family; machines that
separate just the languages of that family vote for the language.  They are trained with numpy on the driver, from a
sample of labelled texts that is bounded in rows only (``per_language``, evenly less where ``sample_rows`` do not hold
as many); every language with a usable row is learned.  More than ``FAMILY_SIZE`` languages that are each a family of
their own are put together in families of that size, so the machines stay few.  Features of the sample are computed on
the executors.  Prediction runs in Arrow batches where the texts are, without a shuffle.

Edge cases.  A null text and a text without a letter are ``und`` with score 0, as is every text when nothing could be
learned.  With one learned language every text with a letter gets it.  Rows with null lang, text or doc_id are not
learned from.  Very long texts are counted in pieces, whole.  Ties go to the first name by code point.  An empty
table gives an empty result.  Columns called lang_pred or score are replaced, all others stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtape.llm.common import staged

UNKNOWN = "und"
FEATURES = 4096
PER_LANGUAGE = 400
SAMPLE_ROWS = 24 * PER_LANGUAGE
FAMILY_SIZE = 16
LIMIT_QUANTILE, LIMIT_PART = 0.005, 0.3
#: A language's weight of 1 in whole numbers, whose sums are the same in any order; parts of a range; rows to sort at once.
WEIGHT, PARTS, FEW = 1 << 20, 512, 4096
PIECE = 1 << 20
FEATURE_ROWS = 256

# Families of languages by ISO 639-1 code.  A language not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "indo_iranian": "bn fa gu hi ku mr ne pa ps si ur",
    "uralic": "et fi hu se",
    "turkic": "az kk ky tk tr tt ug uz",
    "semitic": "am ar he mt",
    "sinitic": "yue zh",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_letter = re.compile(r"[^\W\d_]")


def trigram_counts(text: str) -> np.ndarray:
    """Hashed trigram counts of the whole text, square-rooted, of length one."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8)
    counts = np.zeros(FEATURES)
    for start in range(0, max(1, len(raw) - 2), PIECE):
        b = raw[start : start + PIECE + 2].astype(np.uint32)
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        counts += np.bincount((code * np.uint32(2654435761)) >> np.uint32(20), minlength=FEATURES)
    counts = np.sqrt(counts)
    return counts / (np.linalg.norm(counts) or 1.0)


@dataclass
class Machines:
    """One-against-one linear machines over some classes."""

    classes: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, FEATURES + 1)))

    def vote(self, x: np.ndarray) -> tuple[str, float, float]:
        """The class with most wins, then the largest summed margin; its confidence from 0 to 1; its mean margin."""
        k = len(self.classes)
        if k == 1:
            return self.classes[0], 1.0, np.inf
        margins = self.weights[:, :-1] @ x + self.weights[:, -1]
        wins, total = np.zeros(k), np.zeros(k)
        for (a, b), m in zip(combinations(range(k), 2), margins):
            wins[a if m >= 0 else b] += 1
            total[a] += m
            total[b] -= m
        best = max(range(k), key=lambda i: (wins[i], total[i], -i))
        margin = float(total[best] / (k - 1))
        return self.classes[best], float(1 / (1 + np.exp(-2 * np.clip(margin, -30, 30)))), margin


def fit_machines(x: np.ndarray, labels: np.ndarray, strength: float = 3e-4, steps: int = 150) -> Machines:
    """Squared-hinge machines by accelerated gradient descent; same input, same result."""
    classes = sorted(set(labels.tolist()))
    rows = []
    for a, b in combinations(classes, 2):
        pick = (labels == a) | (labels == b)
        y = np.where(labels[pick] == a, 1.0, -1.0)
        z = np.hstack([x[pick], np.ones((pick.sum(), 1))])
        weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
        w, ahead, rate = np.zeros(z.shape[1]), np.zeros(z.shape[1]), 0.25
        for step in range(steps):
            slack = np.maximum(0, 1 - y * (z @ ahead))
            moved = ahead - rate * (2 * strength * ahead - 2 * (z.T @ (weight * slack * y)))
            ahead = moved + step / (step + 3) * (moved - w)
            w = moved
        rows.append(w)
    return Machines(classes, np.array(rows) if rows else np.zeros((0, FEATURES + 1)))


@dataclass
class LanguageModel:
    families: Machines | None
    members: dict[str, Machines]
    #: Texts whose family or language wins with a smaller margin are unknown.
    limits: tuple[float, float] = (-np.inf, -np.inf)

    def judge(self, text: str | None) -> tuple[str, float, float, float]:
        """Language, score, and the winning margins of the family and of the language in it."""
        if not text or self.families is None or not _letter.search(text):
            return UNKNOWN, 0.0, -np.inf, -np.inf
        x = trigram_counts(text)
        family, sure, far = self.families.vote(x)
        language, surer, farther = self.members[family].vote(x)
        return language, sure * surer, far, farther

    def predict(self, text: str | None) -> tuple[str, float]:
        language, score, far, farther = self.judge(text)
        if far < self.limits[0] or farther < self.limits[1]:
            return UNKNOWN, 0.0
        return language, score


def family_of(language: str) -> str:
    return FAMILY_OF.get(language, f"only {language}")


def families(languages: list[str]) -> dict[str, str]:
    """The family of each language; many languages without one share families, in the order of their codes."""
    out = {x: family_of(x) for x in sorted(set(languages))}
    alone = [x for x in out if x not in FAMILY_OF]
    if len(alone) > FAMILY_SIZE:
        out |= {x: f"others {k // FAMILY_SIZE}" for k, x in enumerate(alone)}
    return out


def usable(docs: DataFrame) -> DataFrame:
    """The rows with a label, a text and a doc_id."""
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())


def texts_of_each(languages: int, per_language: int, sample_rows: int) -> int:
    """How many texts a language counts for at most."""
    return max(1, min(per_language, sample_rows // max(1, languages)))


def training_sample(docs: DataFrame, per_language: int, sample_rows: int) -> DataFrame:
    """doc_id, lang, text of labelled rows of every language, drawn by a hash of the doc_id, one a doc_id."""
    labelled = usable(docs)
    ticks = 1 << 30
    draw = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(ticks))
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n"), F.min(draw).alias("first")).collect()
    each = texts_of_each(len(sizes), per_language, sample_rows)
    # a language's first row is always drawn
    most = [(r["lang"], max(int(ticks * each / r["n"]), r["first"] + 1)) for r in sizes]
    shares = docs.sparkSession.createDataFrame(most, "lang string, most long")
    drawn = labelled.select("doc_id", "lang", "text").join(F.broadcast(shares), "lang").where(draw < F.col("most"))
    return drawn.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """A model from the labelled rows of ``docs`` (doc_id, text, lang)."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, FEATURE_ROWS):  # a row of features has 16 KB
                rows = batch.slice(start, FEATURE_ROWS)
                made = [trigram_counts(t.as_py()).astype(np.float32).tobytes() for t in rows.column("text")]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("lang"), pa.array(made, pa.binary())], ["doc_id", "lang", "x"])

    sample = training_sample(docs, per_language, sample_rows)
    kinds = f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, lang string, x binary"
    rows = sample.mapInArrow(features, kinds).collect()
    rows.sort(key=lambda r: (r["lang"], r["doc_id"], bytes(r["x"])))
    if not rows:
        return LanguageModel(None, {})
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows], dtype=np.float64)
    languages = np.array([r["lang"] for r in rows])
    family = families(languages.tolist())
    groups = np.array([family[x] for x in languages])
    return LanguageModel(
        fit_machines(x, groups), {g: fit_machines(x[groups == g], languages[groups == g]) for g in sorted(set(groups))}
    )


def with_limits(model: LanguageModel, docs: DataFrame) -> LanguageModel:
    """The model with margin limits from all labelled ``docs``, which it has not learned from.

    A limit is ``LIMIT_PART`` of the margin that all but ``LIMIT_QUANTILE`` of the rightly told texts exceed.
    Learned languages stay well above it, short texts included, while texts in other languages, encoded data, code and
    letter noise win by chance and by little.  Every text is judged; the texts of a common language weigh less, so that
    it counts as much as ``PER_LANGUAGE`` of them and a rare one still has its say.  A row that repeats counts once.
    Without such texts there are no limits.  The driver gets a row per language, and few of each margin.
    """

    @F.pandas_udf("lang string, far double, farther double")
    def judged(texts: pd.Series) -> pd.DataFrame:
        made = [model.judge(t) for t in texts]
        return pd.DataFrame([(m[0], m[2], m[3]) for m in made], columns=["lang", "far", "farther"])

    told = usable(docs).select("doc_id", "lang", judged("text").alias("guess"))
    told = staged(told.select("doc_id", "lang", (F.col("guess.lang") == F.col("lang")).alias("right"), "guess.far", "guess.farther"), "margins")
    sizes = told.groupBy("lang").agg(F.count("*").alias("n")).collect()
    each = texts_of_each(len(sizes), PER_LANGUAGE, SAMPLE_ROWS)
    weights = [(r["lang"], max(1, WEIGHT * min(each, r["n"]) // r["n"])) for r in sizes]
    shares = docs.sparkSession.createDataFrame(weights, "lang string, weight long")
    told = staged(told.where("right").distinct().join(F.broadcast(shares), "lang").select("far", "farther", "weight"), "margins")

    def limit(column: str) -> float:
        low = low_margin(told.select(F.col(column).alias("m"), "weight"))
        return min(low, LIMIT_PART * low)

    return LanguageModel(model.families, model.members, (limit("far"), limit("farther")))


def low_margin(margins: DataFrame, quantile: float = LIMIT_QUANTILE) -> float:
    """The quantile of the finite margins (m, weight), exact: between the two next to its place, as numpy does it."""
    margins = margins.where(F.abs("m") < np.inf)
    least, most, total = margins.agg(F.min("m"), F.max("m"), F.sum("weight")).first()
    if total is None:
        return -np.inf
    place = max(0.0, quantile * (total / WEIGHT - 1))
    ends = [_margin_at(margins, least, most, min(k * WEIGHT, total - 1)) for k in (int(place), int(place) + 1)]
    return float(np.quantile(ends, place - int(place)))


def _margin_at(margins: DataFrame, least: float, most: float, place: int) -> float:
    """The margin below which, in their order, lies a weight of ``place``; found by narrowing its range to few rows."""
    before = 0
    while least < most:
        inside = margins.where(F.col("m").between(least, most))
        part = F.least(F.floor((F.col("m") - least) / (most - least) * PARTS), F.lit(PARTS - 1))
        parts = inside.groupBy(part.alias("part")).agg(F.sum("weight"), F.count("*"), F.min("m"), F.max("m")).collect()
        for _, weight, n, least, most in sorted(parts):  # noqa: B007
            if before + weight > place:
                break
            before += weight
        if n <= FEW:
            for m, weight in sorted(margins.where(F.col("m").between(least, most)).collect()):
                before += weight
                if before > place:
                    return m
    return least


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred and score."""

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*others, predicted("text").alias("__guess")).select(*others, "__guess.lang_pred", "__guess.score")


def held_out():
    """Whether a document is kept from learning: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the documents that are not held out."""
    model = fit(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
