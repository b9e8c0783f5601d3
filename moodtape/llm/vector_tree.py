"""Nearest neighbours by largest inner product, with a hierarchical k-means tree searched best bin first.

Index.  Vectors that are equal are one entry with their smallest ids, as many as an answer can hold, so a vector with
a third of all rows fills no leaf.  A tree of k-means splits is fitted on a bounded sample (``sample_rows``) on the
driver, with leaves for about ``LEAF_ENTRIES`` entries as far as the sample can tell; so its size is bounded.  Every entry is then put in a leaf by descending the tree, in Arrow batches.

Search.  A query walks the tree through a priority queue: the best child is followed, the others wait by their score,
and leaves come out in the order in which they are visited.  How many leaves are visited is calibrated: the exact
neighbours of a bounded sample of queries (``calibration_queries``, against all entries, in blocks) tell at which
number of leaves the recall reaches ``recall``; ``margin`` more are visited, and still more while the visited ones hold
too few entries to fill the answer, whichever of them have the query's own id.  Queries meet the leaves in groups of
neighbouring leaves, about ``BLOCK`` entries each and larger leaves split, each scored by one matrix product of which
only the visited leaves count.  Scores that can reach the answer
are computed anew in double precision, the same way for every pair, so equal vectors tie exactly.

Edge cases.  Vectors that are null or zero, or hold null or non-finite components, take no part, nor does a null id;
the dimension is the most frequent one, other lengths take no part.  Repeated ids are rows of their own, but a query
never finds rows with its own id.  With fewer candidates than asked for, all are returned, and
with up to ``BLOCK`` entries all leaves are visited.  Ties go to the smaller id.  An empty table gives an empty result.
Columns other than the id and the vector are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodtape.llm.common import staged

TOP = 20
SAMPLE_ROWS, BRANCHES, LEAF_SAMPLE, LEAF_ENTRIES = 20_000, 8, 40, 1000
CALIBRATION_QUERIES, RECALL, MARGIN = 200, 0.95, 1.1
BLOCK = 4096
_CLOSE = 1e-9


@dataclass
class Tree:
    """Inner nodes with their children's centres; children are inner nodes (>= 0) or leaves (-1 - leaf)."""

    centres: list[np.ndarray]
    children: list[list[int]]
    leaves: int

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest centre at every level."""
        out = np.zeros(len(vectors), np.int64)
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                c = self.centres[node]
                best = np.argmin((c * c).sum(1)[None, :] - 2 * vectors[rows] @ c.T, axis=1)
                for k, child in enumerate(self.children[node]):
                    waiting.append((child, rows[best == k]))
        return out

    def leaves_in_order(self, query: np.ndarray, most: int, held: list[int] | None = None, least: int = 0) -> list[int]:
        """``most`` leaves, best bin first, and more until they hold ``least`` entries; ``held`` are the leaves' sizes."""
        found, heap, tick, entries = [], [(0.0, 0, 0)], 0, 0
        while heap and (len(found) < most or entries < least):
            _, _, node = heapq.heappop(heap)
            if node < 0:
                found.append(-1 - node)
                entries += held[-1 - node] if held else 0
                continue
            for score, child in zip(self.centres[node] @ query, self.children[node]):
                tick += 1
                heapq.heappush(heap, (-float(score), tick, child))
        return found


def _k_means(x: np.ndarray, k: int, rng: np.random.RandomState, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.argmin((centres * centres).sum(1)[None, :] - 2 * x @ centres.T, axis=1)
        centres = np.array([x[near == j].mean(0) if (near == j).any() else centres[j] for j in range(k)])
    return centres, np.argmin((centres * centres).sum(1)[None, :] - 2 * x @ centres.T, axis=1)


def fit_tree(sample: np.ndarray, branches: int = BRANCHES, leaf_sample: int = LEAF_SAMPLE) -> Tree:
    rng = np.random.RandomState(7)
    tree = Tree([], [], 0)

    def grow(x: np.ndarray) -> int:
        different = len(np.unique(x, axis=0)) if len(x) else 0
        if tree.centres and (len(x) <= leaf_sample or different < branches):
            tree.leaves += 1
            return -tree.leaves
        k = min(branches, different)
        centres, near = _k_means(x, k, rng)
        node = len(tree.centres)
        tree.centres.append(centres)
        tree.children.append([])
        tree.children[node] = [grow(x[near == j]) for j in range(k)]
        return node

    grow(sample)
    return tree


def _usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """id, vector (doubles) of the rows that take part."""
    v = F.transform(vector, lambda x: x.cast("double"))
    sound = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vector", lambda x: x != 0)
    out = rows.select(F.col(key).cast("long").alias("id"), v.alias("vector")).where(F.col("id").isNotNull() & F.col("vector").isNotNull())
    out = out.where(sound)
    usual = out.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    return out.where(F.size("vector") == (usual["dim"] if usual else -1))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _exact(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of one query with some rows, each summed in the same order."""
    return (rows * query).sum(axis=1)


def _best(queries: np.ndarray, query_ids, vectors: np.ndarray, ids, top: int, visited=None) -> Iterator[tuple[int, int, float]]:
    """For each query the entries of a block that can be among its ``top``; ids are lists of equal vectors' ids.

    ``visited`` says which entries each query looks at; without it, all.
    """
    rough = queries @ vectors.T
    if visited is not None:
        rough[~visited] = -np.inf
    for row, query_id, q in zip(rough, query_ids, queries):
        at = np.flatnonzero(row > -np.inf)
        if len(row) > top + 1:
            # one more than asked for, as one entry may be the query alone
            limit = np.partition(row, len(row) - top - 1)[len(row) - top - 1]
            if limit > -np.inf:
                at = np.flatnonzero(row >= limit - _CLOSE * (1 + abs(limit)))
        found = []
        for k, score in zip(at, _exact(q, vectors[at])):
            found += [(-score, int(i)) for i in ids[k] if i != query_id]
        for score, i in heapq.nsmallest(top, found):
            yield int(query_id), i, -score


def nearest(rows: DataFrame, queries: DataFrame, key="vec_id", vector="embedding", top=TOP, sample_rows=SAMPLE_ROWS,
            calibration_queries=CALIBRATION_QUERIES, recall=RECALL, margin=MARGIN, block=BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found for every row of ``queries``."""
    spark = rows.sparkSession
    asked = _usable(queries, key, vector).select(F.col("id").alias("query_id"), "vector")
    # Equal vectors are one entry. No answer can use more than the top + 1 smallest of their ids.
    several = Window.partitionBy("vector").orderBy("id")
    usable = _usable(rows, key, vector)
    few = usable.withColumn("nth", F.row_number().over(several)).where(F.col("nth") <= top + 1)
    entries = staged(few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "vectors")
    total = entries.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if total == 0:
        return empty
    drawn = F.pmod(F.xxhash64(F.lit("tree"), "vector"), F.lit(1 << 30)) / (1 << 30)
    sample = entries.where(drawn < sample_rows / total).limit(2 * sample_rows).select("ids", "vector").collect()
    sample = np.array([r["vector"] for r in sorted(sample, key=lambda r: r["ids"][0])] or [entries.first()["vector"]])
    tree = fit_tree(sample, leaf_sample=max(LEAF_SAMPLE, LEAF_ENTRIES * len(sample) // total))

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(leaf=tree.leaf_of(_matrix(batch["vector"])))

    index = staged(entries.mapInPandas(put, "vector array<double>, ids array<long>, leaf long"), "vector-index")
    visits, least = tree.leaves, 0
    if total > block:
        # No answer has fewer rows than asked for while there are candidates: entries with the query's own id are none.
        own = index.select(F.explode("ids").alias("id")).groupBy("id").count().agg(F.max("count")).first()[0]
        least = top + own
        reached = _calibrate(index, asked, tree, top, calibration_queries, recall)
        visits = min(tree.leaves, int(np.ceil(reached * margin)))

    # Leaves next to each other in the tree make groups of about a block of entries; a larger leaf is a group of several
    # blocks. There are as many rows as leaves, which the sample bounds.
    sizes = dict(index.groupBy("leaf").agg(F.count("*").alias("n")).collect())
    leaf_sizes = [sizes.get(leaf, 0) for leaf in range(tree.leaves)]
    group_of, held = np.zeros(tree.leaves, np.int64), [0]
    for leaf in range(tree.leaves):
        if held[-1] and held[-1] + sizes.get(leaf, 0) > block:
            held.append(0)
        held[-1] += sizes.get(leaf, 0)
        group_of[leaf] = len(held) - 1

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            visits_of = []
            for v in batch["vector"]:
                groups: dict[int, list[int]] = {}
                for leaf in tree.leaves_in_order(np.asarray(v, float), visits, leaf_sizes, least):
                    groups.setdefault(int(group_of[leaf]), []).append(leaf)
                visits_of.append([{"group": g, "leaves": leaves} for g, leaves in groups.items()])
            yield batch.assign(visits=visits_of)

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, float]] = []
        if len(right):
            vectors, leaves, ids = _matrix(right["vector"]), right["leaf"].to_numpy(), right["ids"].tolist()
            for start in range(0, len(left), 256):
                part = left[start : start + 256]
                visited = np.zeros((len(part), tree.leaves), bool)
                for row, own in enumerate(part["leaves"]):
                    visited[row, own] = True
                found += _best(_matrix(part["vector"]), part["query_id"], vectors, ids, top, visited[:, leaves])
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    # A group is cut into blocks of entries, its queries into parts; every two of them meet in one task.
    walked = asked.mapInPandas(walk, "query_id long, vector array<double>, visits array<struct<group: long, leaves: array<int>>>")
    walked = walked.select("query_id", "vector", F.explode("visits").alias("visit")).select("query_id", "vector", "visit.*")
    walked = staged(walked, "vector-visits")
    parts = walked.groupBy("group").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    blocks = [(g, max(1, -(-n // (2 * block)))) for g, n in enumerate(held)]
    plan = staged(parts.join(spark.createDataFrame(blocks, "group long, blocks int"), "group"), "vector-blocks")
    placed = index.withColumn("group", F.element_at(F.array(*[F.lit(int(g)) for g in group_of]), (F.col("leaf") + 1).cast("int")).cast("long"))
    keys = ["group", "block", "part"]

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = walked.join(plan, "group").select("group", every("blocks").alias("block"), F.pmod(F.xxhash64("query_id"), "parts").cast("int").alias("part"), "query_id", "vector", "leaves")
    right = placed.join(plan, "group").select("group", F.pmod(F.xxhash64("vector"), "blocks").cast("int").alias("block"), every("parts").alias("part"), "ids", "vector", "leaf")
    left = left.toDF(*keys, "query_id", "vector", "leaves")
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _calibrate(index: DataFrame, asked: DataFrame, tree: Tree, top: int, queries: int, recall: float) -> int:
    """How many leaves a query must visit for the recall, from exact neighbours of a sample of queries."""
    order = F.xxhash64(F.lit("calibration"), "query_id")
    chosen = asked.orderBy(order, "query_id").limit(queries).collect()
    if not chosen:
        return tree.leaves
    q_ids = [r["query_id"] for r in chosen]
    q = np.array([r["vector"] for r in chosen])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            leaf_of = {int(i): leaf for ids, leaf in zip(batch["ids"], batch["leaf"]) for i in ids}
            found = list(_best(q, q_ids, _matrix(batch["vector"]), batch["ids"].tolist(), top))
            out = pd.DataFrame(found, columns=["query_id", "vec_id", "score"])
            yield out.assign(leaf=[leaf_of[i] for i in out["vec_id"]])

    best = index.mapInPandas(scan, "query_id long, vec_id long, score double, leaf long")
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = best.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= top).select("query_id", "leaf").collect()
    place = {i: {leaf: n for n, leaf in enumerate(tree.leaves_in_order(v, tree.leaves), 1)} for i, v in zip(q_ids, q)}
    needed = sorted(place[r["query_id"]][r["leaf"]] for r in true)
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)] if needed else tree.leaves
