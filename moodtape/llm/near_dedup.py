"""Near-duplicate documents by HyperMinHash.

A document is its set of distinct word shingles, hashed to 64 bits.  Eight hash functions each deal the set over 32
buckets; a bucket stores its smallest hash as a leading-zero count plus ten mantissa bits, 16 bits in all.  (One
function with 256 buckets would leave most buckets of a short text empty, and texts that share a line would meet in
the few that aren't.)  Documents with the same set are one node.  Bands of five registers, each of another function,
that agree make candidates if the set sizes allow a link; at a similarity of 0.8 a link shares no band with a
probability of about 2e-9.  The share of agreeing registers, corrected for the collisions the short mantissa makes,
must come within six standard errors of the limit; then the link is confirmed on the full sets, made again from the
whole texts of candidates only.

No pairs within a group are listed.  First every node is compared with one centre, the node of its buckets that
shares most buckets; nodes that link are one component.  Then nodes are compared across components only.  In buckets
of up to ``CROWD`` nodes that takes at most that many pairs a node.  Crowded buckets are joined to regions; a region's
nodes outside its largest component are compared with all its nodes in square blocks, by matrix products over the
shingles two blocks share, and a block gives one link per node and component.  So many thousand near copies cost
about one comparison each, texts that nearly link are never listed as pairs, and no link between components is lost.

Edge cases.  Words are runs of anything but blanks with A-Z lower-cased; a text with fewer words than a shingle is
one shingle; a null, empty or blank text has an empty set, links with nothing and is kept.  Rows that repeat a doc_id
count as one document whose links are those of all its rows.  A row with a null doc_id takes no part: its component is
null and it is kept.  An empty table gives an empty result.  Columns other than doc_id and text are not read by the
decision.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodtape.llm.common import may_be_among, staged
from moodtape.llm.components import components

WORDS, PERCENT = 5, 80
FUNCTIONS, BUCKETS, BAND_ROWS, MANTISSA_BITS = 8, 32, 5, 10
REGISTERS = FUNCTIONS * BUCKETS
BANDS = REGISTERS // BAND_ROWS
CROWD, BLOCK, SALTS = 64, 1024, 64
PIECE = 1 << 16

_U = np.uint64
_random = np.random.RandomState(20240101)
_BYTE_VALUE = _random.randint(0, 2**63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_PLACE = _random.randint(0, 2**63, 64, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_FUNCTION = _random.randint(0, 2**63, FUNCTIONS, dtype=np.int64).astype(_U)
_BUCKET_BITS = BUCKETS.bit_length() - 1
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.full(PIECE, _BASE, _U), dtype=_U)
_INVERSE = np.cumprod(np.full(PIECE, pow(_BASE, -1, 2**64), _U), dtype=_U)
_ONE_BLANK = bytes(32 if c in b" \t\n\x0b\f\r" else c for c in range(256))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _piece_hashes(piece: bytes) -> np.ndarray:
    b = np.frombuffer(piece, np.uint8)
    inside = np.zeros(len(b) + 2, bool)
    inside[1:-1] = b != 32
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    sums = np.zeros(len(b) + 1, _U)
    np.cumsum(_BYTE_VALUE[b] * _POWERS[: len(b)], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * _INVERSE[starts] + (ends - starts).astype(_U))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash for each word of the whole text, in pieces that end between words."""
    raw = text.encode("utf-8", "replace").lower().translate(_ONE_BLANK).strip(b" ")
    out, start = [], 0
    while start < len(raw):
        end = start + PIECE
        if end >= len(raw):
            end = len(raw)
        else:
            cut = raw.rfind(b" ", start, end + 1)
            if cut > start:
                end = cut
            elif cut < 0:  # a word longer than a piece
                end = raw.find(b" ", end)
                end = len(raw) if end < 0 else end
                digest = hashlib.blake2b(raw[start:end], digest_size=8).digest()
                out.append(np.frombuffer(digest, _U))
                start = end
                continue
            else:
                start += 1
                continue
        out.append(_piece_hashes(raw[start:end]))
        start = end
    return np.concatenate(out) if out else np.zeros(0, _U)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The sorted distinct shingle hashes of the text."""
    w = word_hashes(text or "")
    size = min(words, len(w))
    if size == 0:
        return w
    h = np.full(len(w) - size + 1, size, _U)
    for k in range(size):
        h += w[k : len(w) - size + 1 + k] * _PLACE[k % len(_PLACE)]
        if k % len(_PLACE) == len(_PLACE) - 1:
            h = _mixed(h)
    return np.unique(_mixed(h))


def registers(shingles: np.ndarray) -> np.ndarray:
    """For each bucket 1 + the leading zeros of its smallest hash, then its mantissa bits; 0 for an empty bucket.

    The register of function f and bucket b is at b * FUNCTIONS + f, so neighbours come from different functions.
    """
    out = np.zeros((FUNCTIONS, BUCKETS), np.uint16)
    if len(shingles):
        dealt = np.sort(_mixed(shingles[None, :] + _FUNCTION[:, None]), axis=1)
        bucket = (dealt >> _U(64 - _BUCKET_BITS)).astype(np.int64)
        function, first = np.nonzero(np.diff(bucket, prepend=-1, axis=1))
        rest = dealt[function, first] & _U((1 << (64 - _BUCKET_BITS)) - 1)
        fraction, exponent = np.frexp(rest.astype(np.float64))
        mantissa = np.clip((fraction * 2 - 1) * (1 << MANTISSA_BITS), 0, (1 << MANTISSA_BITS) - 1).astype(np.int64)
        zeros = np.maximum(0, 64 - _BUCKET_BITS - exponent).astype(np.int64)
        out[function, bucket[function, first]] = ((zeros + 1) << MANTISSA_BITS) | mantissa
    return out.T.reshape(-1)


def may_link(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the collision-corrected similarity of register rows comes within six standard errors of the limit."""
    used = np.maximum(1, ((a > 0) | (b > 0)).sum(1))
    equal = ((a == b) & (a > 0)).sum(1)
    chance = 0.169919487 * 2.0**-MANTISSA_BITS * 4 * n_a * n_b / (n_a + n_b) ** 2
    limit = percent / 100
    similar = (equal / used - chance) / (1 - chance)
    return similar >= limit - 6 * np.sqrt(limit * (1 - limit) / used)


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_hash, registers; set_hash is null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, sketches = [], [], []
            for text in batch.column("text"):  # one text at a time leaves the Arrow batch
                s = shingle_set(text.as_py(), words)
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sketches.append(registers(s).tobytes() if len(s) else None)
            made = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], ["doc_id", "n_shingles", "set_hash", "registers"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return staged(rows.mapInArrow(run, "doc_id long, n_shingles long, set_hash binary, registers binary"), "sketches")


def _nodes(sketches: DataFrame) -> DataFrame:
    """set_hash, node, n, registers: one row for each different set; the node is the set's smallest doc_id."""
    rows = sketches.where(F.col("doc_id").isNotNull() & F.col("set_hash").isNotNull())
    first = F.min(F.struct("doc_id", F.col("n_shingles").alias("n"), "registers")).alias("first")
    out = rows.groupBy("set_hash").agg(first)
    return staged(out.select("set_hash", F.col("first.doc_id").alias("node"), "first.n", "first.registers"), "nodes")


def _bands(nodes: DataFrame) -> DataFrame:
    """bucket, node: the hash of each band of registers that isn't all empty."""
    width = 2 * BAND_ROWS
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.struct(b.alias("band"), F.col("registers").substr(b * width + 1, F.lit(width)).alias("part")),
    )
    rows = nodes.select("node", F.explode(bands).alias("b")).where(F.col("b.part") != F.lit(bytes(width)))
    return rows.select(F.xxhash64("b.band", "b.part").alias("bucket"), "node")


def _sizes_fit(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The links among ``pairs`` (low, high): first by registers, then on the full sets."""

    @F.pandas_udf("boolean")
    def promising(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
        rows = [np.frombuffer(b"".join(x), np.uint16).reshape(-1, REGISTERS) for x in (a, b)]
        return pd.Series(may_link(*rows, n_a.to_numpy(float), n_b.to_numpy(float), percent))

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * shared >= percent * (len(x) + len(y) - shared))
        return pd.Series(out, dtype=bool)

    def side(name: str, table: DataFrame, *columns: str) -> DataFrame:
        return table.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns])

    near = pairs.join(side("low", nodes, "n", "registers"), "low").join(side("high", nodes, "n", "registers"), "high")
    near = near.where(_sizes_fit("low_n", "high_n", percent)).where(promising("low_registers", "high_registers", "low_n", "high_n"))
    near = staged(near.select("low", "high").distinct(), "near-pairs")
    wanted = near.select(F.col("low").alias("node")).unionByName(near.select(F.col("high").alias("node"))).distinct()
    sets = _full_sets(docs, wanted, nodes, words)
    full = near.join(side("low", sets, "shingles"), "low").join(side("high", sets, "shingles"), "high")
    return full.where(linked("low_shingles", "high_shingles")).select("low", "high")


def _full_sets(docs: DataFrame, wanted: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node, shingles: the sets of the wanted nodes, from their whole texts."""
    kinds = "node long, shingles binary"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(text, words) for text in batch["text"]]
            # a doc_id's other rows may have other sets
            same = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() == bytes(h) for s, h in zip(sets, batch["set_hash"])]
            yield pd.DataFrame({"node": batch["node"][same], "shingles": [s.tobytes() for s, ok in zip(sets, same) if ok]})

    wanted = staged(wanted.join(nodes.select("node", "set_hash"), "node"), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").alias("text")).where("node IS NOT NULL")
    # Of other texts next to none are shuffled.
    texts = texts.where(may_be_among(F.col("node"), wanted.select("node"))).join(wanted, "node")
    return staged(texts.select("node", "text", "set_hash").mapInPandas(run, kinds), "full-sets")


def _first_links(members: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links of every node with one centre: of the nodes in its buckets, the one that shares most buckets."""
    degree = members.groupBy("node").agg(F.sum("size").alias("degree"))
    ranked = members.join(degree, "node").select("bucket", "node", F.struct("degree", (-F.col("node")).alias("other")).alias("rank"))
    top = ranked.groupBy("bucket").agg(F.max("rank").alias("top"))
    tried = ranked.join(top, "bucket").groupBy("node").agg((-F.max("top")["other"]).alias("centre"))
    pairs = tried.where("node <> centre").select(F.least("node", "centre").alias("low"), F.greatest("node", "centre").alias("high"))
    return _confirmed(pairs.distinct(), nodes, docs, words, percent)


def _region_links(labelled: DataFrame, crowded: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links across components in crowded buckets: at least one for each node outside its region's largest component
    and each component it links with."""

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        sides = [[np.frombuffer(x, _U) for x in side["shingles"]] for side in (left, right)]
        sizes = [np.array([len(x) for x in side], np.int64) for side in sides]
        flat = [np.concatenate(side) if side else np.zeros(0, _U) for side in sides]
        rows = [np.repeat(np.arange(len(side)), size) for side, size in zip(sides, sizes)]
        both = np.intersect1d(*[np.unique(x) for x in flat], assume_unique=True)
        shared = np.zeros((len(sides[0]), len(sides[1])), np.float32)
        places = [np.searchsorted(both, x) for x in flat]
        hit = [(p < len(both)) & (both[np.minimum(p, len(both) - 1)] == x) if len(both) else np.zeros(len(x), bool) for p, x in zip(places, flat)]
        for start in range(0, len(both), 4096):
            columns = []
            for side, place, ok, row in zip(sides, places, hit, rows):
                inside = ok & (place >= start) & (place < start + 4096)
                matrix = np.zeros((len(side), min(4096, len(both) - start)), np.float32)
                matrix[row[inside], place[inside] - start] = 1
                columns.append(matrix)
            shared += columns[0] @ columns[1].T
        union = sizes[0][:, None] + sizes[1][None, :] - shared
        a, b = np.nonzero((100 * shared >= percent * union) & (shared > 0))
        found = pd.DataFrame({"low": left["node"].to_numpy()[a], "high": right["node"].to_numpy()[b]})
        found["of"], found["to"] = left["component"].to_numpy()[a], right["component"].to_numpy()[b]
        found = found[found["of"] != found["to"]].drop_duplicates(["low", "to"])
        return found[["low", "high"]]

    there = labelled.join(crowded, "bucket")
    lead = there.groupBy("bucket").agg(F.min("node").alias("low"))
    tied = there.join(lead, "bucket").select("low", F.col("node").alias("high"))
    region = components(tied).select("node", F.col("component").alias("region"))
    inside = there.select("node", "component").distinct().join(region, "node")
    sizes = inside.groupBy("region", "component").agg(F.count("*").alias("size"))
    top = F.max(F.struct("size", "component"))["component"]
    stats = sizes.groupBy("region").agg(F.sum("size").alias("nodes"), top.alias("major"))
    minor = sizes.join(stats, "region").where("component <> major").groupBy("region").agg(F.sum("size").alias("minors"))
    stats = stats.join(minor, "region")  # a region that is one component has nothing to compare
    # A region may hold most rows: its nodes are dealt over SALTS keys, each with a copy of the region's few figures.
    dealt = inside.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    every_salt = stats.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    inside = staged(dealt.join(every_salt, ["region", "salt"]).drop("salt"), "regions")
    sets = _full_sets(docs, inside.select("node").distinct(), nodes, words)
    full = staged(inside.join(sets, "node"), "region-sets")
    across, down = F.ceil(F.col("nodes") / BLOCK).cast("int"), F.ceil(F.col("minors") / BLOCK).cast("int")
    column, row = F.pmod(F.xxhash64("node"), across).cast("int"), F.pmod(F.xxhash64("node"), down).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), n - 1))

    left = full.where("component <> major").select("region", row.alias("row"), every(across).alias("column"), "node", "component", "shingles")
    right = full.select("region", every(down).alias("row"), column.alias("column"), "node", "component", "shingles")
    left = left.toDF("region", "row", "column", "node", "component", "shingles")  # columns of its own, apart from right's
    keys = ["region", "row", "column"]
    out = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "low long, high long")
    return out.select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high"))


def _later_links(members: DataFrame, found: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """All links that are left between components; of those to one component in a crowd, at least one."""
    labelled = members.join(found, "node", "left")
    labelled = staged(labelled.select("bucket", "node", "size", F.coalesce("component", "node").alias("component")), "labelled")
    sizes = labelled.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.max("size").alias("size"))
    mixed = staged(sizes.where("least <> most").select("bucket", (F.col("size") > CROWD).alias("crowded")), "mixed")
    few = labelled.join(mixed.where("NOT crowded").select("bucket"), "bucket").select("bucket", "node", "component")
    few = few.join(nodes.select("node", "n"), "node")
    other = few.select("bucket", *[F.col(c).alias(f"other_{c}") for c in ("node", "n", "component")])
    apart = F.col("component") != F.col("other_component")
    tried = few.join(other, "bucket").where(apart & (F.col("node") < F.col("other_node")) & _sizes_fit("n", "other_n", percent))
    pairs = tried.select(F.col("node").alias("low"), F.col("other_node").alias("high")).distinct()
    links = _confirmed(pairs, nodes, docs, words, percent)
    crowded = mixed.where("crowded").select("bucket")
    if crowded.isEmpty():
        return links
    return links.unionByName(_region_links(labelled, crowded, nodes, docs, words, percent))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    sketches = _sketches(docs, words)
    nodes = _nodes(sketches)
    bands = _bands(nodes)
    # One exchange of the bands: they are counted where they lie.
    counted = bands.withColumn("size", F.count("*").over(Window.partitionBy("bucket")))
    members = staged(counted.where("size > 1"), "members")
    # Few nodes share a bucket with another; the registers of all others are not shuffled again.
    sharers = staged(members.select("node").distinct(), "sharers")
    sharing = nodes.where(may_be_among(F.col("node"), sharers)).join(sharers, "node", "left_semi")
    sharing = staged(sharing, "sharing-nodes")
    links = _first_links(members, sharing, docs, words, percent)
    # a doc_id with several different sets ties them together
    several = sketches.where("doc_id IS NOT NULL").groupBy("doc_id")
    several = several.agg(F.count_distinct(F.coalesce("set_hash", F.lit(b""))).alias("sets")).where("sets > 1").drop("sets")
    several = staged(several, "several-sets")
    tied = sketches.join(several, "doc_id").join(nodes.select("set_hash", "node"), "set_hash")
    found = components(links.unionByName(tied.select(F.col("node").alias("low"), F.col("doc_id").alias("high"))))
    more = staged(_later_links(members, found, sharing, docs, words, percent), "later-links")
    if not more.isEmpty():
        stars = found.select(F.col("component").alias("low"), F.col("node").alias("high"))
        found = components(more.unionByName(stars))

    labels = nodes.select("set_hash", "node").join(found, "node", "left")
    labels = labels.select("set_hash", F.coalesce("component", "node").alias("by_set"))
    by_id = found.select(F.col("node").alias("doc_id"), F.col("component").alias("by_id"))
    rows = sketches.drop("registers").join(labels, "set_hash", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("by_set", "doc_id"))
    if not several.isEmpty():
        rows = rows.join(by_id, "doc_id", "left")
        own = F.when(F.col("doc_id").isNotNull(), F.coalesce("by_set", "by_id", "doc_id"))
    return rows.select("doc_id", "n_shingles", own.alias("component_id"), own.eqNullSafe(F.col("doc_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are their component's smallest doc_id, with all their columns."""
    gone = staged(near_duplicates(docs, words, percent).where("NOT kept").select(F.col("doc_id").alias("gone")).distinct(), "gone")
    # Only texts that may have to go are shuffled.
    wide = docs["doc_id"].cast("long")
    dropped = F.coalesce(may_be_among(wide, gone), F.lit(False))
    return docs.where(~dropped).unionByName(docs.where(dropped).join(gone, wide == gone["gone"], "left_anti"))
