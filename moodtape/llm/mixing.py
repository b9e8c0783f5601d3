"""Mixing sources to target weights by Pareto order sampling.

Targets.  The sources, ordered by code point with null last, weigh 1, 2, 3, 1, 2, 3, ... and share the words of the
whole corpus.  No target exceeds ``MAX_REPEATS`` times its source; what is cut off goes to the others by weight until
none is above.  That is a water level: with sources ordered by (cap / weight), those whose cap is below the level get
their cap, the others weight x level.  It takes windows over one row per source.

Documents.  A source repeats each of its documents target / size times on average: the whole part is a certain number
of copies, the rest is the inclusion probability p of one more copy.  Documents are ranked by Pareto order,
(u / (1 - u)) / (p / (1 - p)), with u a hash of the document, so reruns agree; the first in rank are included until
their words come nearest to what the source lacks.  The end of that prefix is found without sorting a source: sums of
words by bin of the ranked value, in two levels of ``BINS`` bins, leave about one document in a million for the exact
window.  A source with a third of all rows costs no task more than that.

Edge cases.  A null or empty text has size 0 and is taken 0 words; its number of copies still follows the rule.  A
null source is a source.  A source without words has target 0 and contributes nothing.  Documents with the same
doc_id and text tie and rank together: they are included together, or not at all; a null doc_id ranks by its text.
Rank ties are broken by doc_id.  An empty table gives an empty result.  Columns other than doc_id, text and source
play no part; ``mix`` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtape.llm.common import staged, whole_text, word_count

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BINS = 1024
SEED = "mix-1"


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, source, size, text_hash, draw (0 to 2^52 - 1, by the document alone) for every row."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.sha2(whole_text().cast("binary"), 256))
    digest = F.sha2(F.concat(F.lit(SEED + "|"), name).cast("binary"), 256)
    return docs.select(
        F.col("doc_id").alias("doc_id"),
        F.col("source").alias("source"),
        word_count(whole_text()).alias("size"),
        F.xxhash64(whole_text()).alias("text_hash"),
        F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").alias("draw"),
        *more,
    )


def targets(sized: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target, copies, chance: one row per source."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.array(*[F.lit(w) for w in weights])[place])
    cap = F.col("source_size") * max_repeats
    filled = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    level = weighed.select(
        "*",
        F.coalesce(F.sum(cap).over(before), F.lit(0)).alias("capped"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("gone"),
        F.sum("source_size").over(Window.partitionBy()).alias("total"),
        F.sum("weight").over(Window.partitionBy()).alias("weights"),
    )
    # The share a source would get if all sources before it were cut to their caps; below its cap, that is the level.
    share = (F.col("total") - F.col("capped")).cast("double") / (F.col("weights") - F.col("gone"))
    level = level.withColumn("share", share).withColumn("cut", F.col("weight") * F.col("share") > cap)
    settled = F.min(F.when(~F.col("cut"), F.col("gone"))).over(Window.partitionBy())
    water = F.min(F.when(F.col("gone") == F.col("settled"), F.col("share"))).over(Window.partitionBy())
    level = level.withColumn("settled", settled).withColumn("water", water)
    target = F.when(F.col("gone") < F.col("settled"), cap.cast("double")).otherwise(F.col("weight") * F.col("water"))
    target = F.least(cap.cast("double"), target)
    repeats = F.when(F.col("source_size") > 0, F.least(F.lit(float(max_repeats)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    out = level.select("source", "source_size", target.alias("target")).withColumn("repeats", repeats)
    copies = F.floor("repeats").cast("long")
    return out.select("source", "source_size", "target", copies.alias("copies"), (F.col("repeats") - copies).alias("chance"))


def _place():
    """Position in Pareto order; exact copies have the same."""
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("chance") / (1 - F.col("chance")))
    return F.struct(
        (odds / (1 + odds)).alias("rank"),
        F.col("doc_id").isNull().alias("nameless"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        "text_hash",
    )


def _with_sources(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Every row with its source's figures and its place."""
    named = sources.withColumnRenamed("source", "of")
    rows = sized.withColumn("u", (F.col("draw") + 0.5) / float(1 << 52))
    rows = rows.join(named, F.col("source").eqNullSafe(F.col("of")))
    return rows.withColumn("place", F.when(F.col("chance") > 0, _place()))


def _edges(sized: DataFrame, sources: DataFrame, bins: int) -> DataFrame:
    """edge_of, edge, included: where each source's prefix of the Pareto order ends."""
    lacks = F.col("target") - F.col("copies") * F.col("source_size")
    left = _with_sources(sized, sources.where("chance > 0")).select("of", "size", lacks.alias("lacks"), "place")
    whole = Window.partitionBy("of")
    for level in (1, 2):
        cell = F.floor(F.col("place.rank") * bins**level).cast("long")
        sums = left.groupBy("of", cell.alias("cell")).agg(F.sum("size").alias("words"), F.max("lacks").alias("lacks"))
        sums = sums.withColumn("upto", F.sum("words").over(whole.orderBy("cell")))
        # the first cell up to which there are words enough, else the last
        reach = F.min(F.when(F.col("upto") >= F.col("lacks"), F.col("cell"))).over(whole)
        sums = sums.withColumn("reach", F.coalesce(reach, F.max("cell").over(whole)))
        edge = sums.where(F.col("cell") == F.col("reach"))
        edge = edge.select(F.col("of").alias("in_of"), "cell", (F.col("lacks") - F.col("upto") + F.col("words")).alias("still"))
        inside = F.col("of").eqNullSafe(F.col("in_of")) & (cell == F.col("cell"))
        left = left.join(staged(edge, f"mix-edge-{level}"), inside).select("of", "size", F.col("still").alias("lacks"), "place")
    left = left.groupBy("of", "place").agg(F.sum("size").alias("size"), F.max("lacks").alias("lacks"))
    sums = left.withColumn("upto", F.sum("size").over(whole.orderBy("place")))
    reach = F.min(F.when(F.col("upto") >= F.col("lacks"), F.col("place"))).over(whole)
    sums = sums.withColumn("reach", F.coalesce(reach, F.max("place").over(whole)))
    nearer = F.abs(F.col("upto") - F.col("lacks")) <= F.abs(F.col("upto") - F.col("size") - F.col("lacks"))
    ends = sums.where(F.col("place") == F.col("reach"))
    return staged(ends.select(F.col("of").alias("edge_of"), F.col("place").alias("edge"), nearer.alias("included")), "mix-ends")


def _plan(sized: DataFrame, weights, max_repeats: int, bins: int) -> tuple[DataFrame, DataFrame]:
    """The figures of each source, and where its prefix ends."""
    sources = staged(targets(sized, weights, max_repeats), "mix-targets")
    return sources, _edges(sized, sources, bins)


def _repeated(sized: DataFrame, sources: DataFrame, edges: DataFrame) -> DataFrame:
    """``sized`` with its source's figures and how often each row is taken."""
    rows = _with_sources(sized, sources).join(edges, F.col("of").eqNullSafe(F.col("edge_of")), "left")
    before = (F.col("place") < F.col("edge")) | ((F.col("place") == F.col("edge")) & F.col("included"))
    once_more = F.when(F.col("chance") > 0, F.coalesce(before, F.lit(False)).cast("long")).otherwise(0)
    return rows.withColumn("times", F.col("copies") + once_more)


def mix_report(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, bins: int = BINS) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row."""
    sized = staged(_sized(docs), "mix-sizes")
    rows = _repeated(sized, *_plan(sized, weights, max_repeats, bins))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, bins: int = BINS) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as it is taken, with all its columns."""
    sources, edges = _plan(staged(_sized(docs), "mix-sizes"), weights, max_repeats, bins)
    whole_rows = _sized(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("it"))
    taken = _repeated(whole_rows, sources, edges).where("times > 0")
    return taken.select("it", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("it.*")
