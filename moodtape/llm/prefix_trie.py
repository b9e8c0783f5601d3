"""The prefix trie of conversations: one row for each distinct sequence of first turns.

A turn is a 128-bit digest of its role and text, so a conversation is a byte string whose order is the order of its
turns, and whole texts are read once and never shuffled.  Distinct conversations are sorted by one range exchange and
cut into blocks.  In a block, the numbers of first turns that neighbours share (LCPs) are kept in a sparse table of
range minima.  Every candidate prefix, a conversation's first turns up to its whole length or up to what it shares with
the one before, looks for its members on both sides on its own, by binary search over the table: to the left and right
as far as the minimum stays at its depth or above.  That gives a member interval without any stack, all candidates at
once; prefixes of which nothing branches off share the interval of the next candidate below them.  Sums over an interval
are differences of running sums, the smallest member is a range minimum of a second table.

A node whose interval ends inside its block is complete.  Those that touch an edge (the prefixes of a block's first and
last conversation) may go on in the next block; their figures are sums and minima, so one aggregation by the prefix's
digest completes them.  What two neighbouring blocks count twice, the turns and children that the last conversation of
one shares with the first of the other, is taken off by rows of its own.  Blocks are bounded by turns; a node that holds
a third of all conversations costs a row for each block.

The digest of a node's members that end there runs over their ids in order: ids are range-sorted by (conversation, id)
and joined to texts within each part; conversations that go on over an edge of a part send these texts on, where one
pass joins them without holding more than one of them.

Edge cases.  Rows with a null conv_id take no part.  Null roles and texts are empty; turns come in order of ``turn``,
null first, those with equal ``turn`` in order of their digest.  Rows that repeat are turns of their own.  A conversation
without turns after rebuilding is a member of the root.  A conversation is one row of 20 bytes a turn, its texts are not
in it, so its length is the only thing that one task must hold.  An empty table has no nodes.  Columns other than
conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtape.llm.common import staged, whole_text, word_count

WIDTH = 16
BLOCK_TURNS, BLOCK_ROWS = 1 << 19, 1 << 15
IDS = 1 << 12
NOTHING = hashlib.sha256(b"").digest()


def _digest(binary) -> Column:
    return F.substring(F.unhex(F.sha2(binary, 256)), 1, WIDTH)


def turn_sequences(conversations: DataFrame, key="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """conv_id, path, words: the digests of a conversation's turns in order, and their numbers of words."""
    by, said = whole_text(F.col(role)), whole_text(F.col(text))
    digest = _digest(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said).cast("binary"))
    turns = conversations.select(
        F.col(key).cast("long").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), digest.alias("digest"), word_count(said).cast("int").alias("words")).alias("t"),
    )
    rows = turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return rows.select("conv_id", F.col("turns.digest").alias("path"), F.col("turns.words").alias("words"))


def branched(sequences: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation c with its first h turns taken from c - c % every; h is crc32(c) % most."""
    sequences = staged(sequences, "turn-sequences")
    base = (F.col("conv_id") - F.col("conv_id") % every).alias("base")
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int").alias("h")
    first = sequences.where(F.col("conv_id") % every == 0)
    first = first.select(F.col("conv_id").alias("base"), *[F.slice(c, 1, most).alias(f"base_{c}") for c in ("path", "words")])

    def rebuilt(column: str) -> Column:
        own, nothing = F.col(column), F.slice(column, 1, 0)
        start = F.coalesce(F.slice(f"base_{column}", F.lit(1), F.col("h")), nothing)
        rest = F.when(F.size(own) > F.col("h"), F.slice(own, F.col("h") + 1, F.size(own))).otherwise(nothing)
        return F.concat(start, rest).alias(column)

    return sequences.select("*", base, taken).join(first, "base", "left").select("conv_id", rebuilt("path"), rebuilt("words"))


class Minima:
    """A sparse table of range minima."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The minimum from low to high, both inside; low <= high."""
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(low), self.levels[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][low[at]], self.levels[k][high[at] - (1 << k) + 1])
        return out

    def left(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest l with all values from l + 1 to start at ``least`` or above."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            low = at - (1 << k) + 1
            ok = low >= 0
            ok[ok] = self.levels[k][low[ok]] >= least[ok]
            at[ok] = low[ok] - 1
        return at

    def right(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The largest r with all values from start + 1 to r at ``least`` or above."""
        size, at = len(self.levels[0]), start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            ok = at + (1 << k) < size
            ok[ok] = self.levels[k][at[ok] + 1] >= least[ok]
            at[ok] += 1 << k
        return at


def prefix_key(path: bytes, depths: int | None = None) -> list[bytes]:
    """A digest for each of the path's prefixes, the empty one first."""
    running, out = hashlib.blake2b(digest_size=WIDTH), []
    out.append(running.digest())
    for k in range(len(path) // WIDTH if depths is None else depths):
        running.update(path[k * WIDTH : (k + 1) * WIDTH])
        out.append(running.copy().digest())
    return out


def shared_turns(a: bytes, b: bytes) -> int:
    """How many first turns two paths share."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * WIDTH] == b[: middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


_NODE = pa.schema(
    [
        ("kind", pa.int8()),
        ("block", pa.int64()),
        ("key", pa.binary()),
        ("parent_key", pa.binary()),
        ("depth", pa.int64()),
        ("conv_id", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("ends", pa.binary()),
        ("path", pa.binary()),
        ("words", pa.list_(pa.int32())),
    ]
)
_NODE_SQL = (
    "kind byte, block long, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends binary, path binary, words array<int>"
)
COMPLETE, OPEN, FIRST, LAST = 0, 1, 2, 3


def _batch(**columns) -> pa.RecordBatch:
    size = len(columns["kind"])
    return pa.record_batch([pa.array(columns.get(f.name, [None] * size), f.type) for f in _NODE], schema=_NODE)


def block_nodes(block: int, paths: list[bytes], counts: np.ndarray, least: np.ndarray, ends: list[bytes], words: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The nodes of a block of sorted distinct paths: complete ones, and those that touch an edge."""
    n = len(paths)
    sizes = np.array([len(p) // WIDTH for p in paths], np.int64)
    turns = np.frombuffer(b"".join(paths), "<u8").reshape(-1, WIDTH // 8)
    starts = np.cumsum(sizes) - sizes
    # turns shared with the path before; the first row shares less than nothing
    shorter = np.minimum(sizes[1:], sizes[:-1])
    at = np.arange(shorter.sum()) - np.repeat(np.cumsum(shorter) - shorter, shorter)
    differ = (turns[np.repeat(starts[1:], shorter) + at] != turns[np.repeat(starts[:-1], shorter) + at]).any(1)
    lcp = np.append(-1, shorter)
    np.minimum.at(lcp, np.repeat(np.arange(1, n), shorter)[differ], at[differ])
    after = np.append(lcp[1:], -1)

    shared, smallest = Minima(lcp), Minima(least)
    # running sums; words up to a depth d of row i are spoken[starts[i] + d] - spoken[starts[i]]
    spoken = np.append(0, np.cumsum(np.concatenate(words) if len(turns) else np.zeros(0, np.int64), dtype=np.int64))

    def first_words(row, depth):
        return spoken[starts[row] + depth] - spoken[starts[row]]

    rows = np.arange(n)
    whole = first_words(rows, sizes)
    members = np.append(0, np.cumsum(counts))
    all_words = np.append(0, np.cumsum(counts * whole))
    own_words = np.append(0, np.cumsum(whole - first_words(rows, np.maximum(lcp, 0))))
    leaves = np.append(0, np.cumsum(sizes > after))
    by_depth = np.sort(lcp * np.int64(n) + rows)

    # candidates: what a row shares with the one before, and all of it
    row, depth = np.concatenate([rows[1:], rows]), np.concatenate([lcp[1:], sizes])
    left, right = shared.left(row, depth), shared.right(row, depth)
    _, once = np.unique(left * np.int64(sizes.max() + 1) + depth, return_index=True)
    left, right, depth = left[once], right[once], depth[once]
    # the candidate above, and the prefixes between, which have the same members
    above = np.maximum(lcp[left], np.where(right + 1 < n, after[right], -1))
    chain = depth - above
    low, high, bottom = np.repeat(left, chain), np.repeat(right, chain), np.repeat(depth, chain)
    d = np.repeat(depth, chain) - (np.arange(chain.sum()) - np.repeat(np.cumsum(chain) - chain, chain))
    top = d == np.repeat(above + 1, chain)

    n_convs = members[high + 1] - members[low]
    before = first_words(low, np.maximum(d - 1, 0))
    saved = (all_words[high + 1] - all_words[low] - n_convs * before) - (own_words[high + 1] - own_words[low + 1] + whole[low] - before)
    inside = np.searchsorted(by_depth, d * np.int64(n) + high, "right") - np.searchsorted(by_depth, d * np.int64(n) + low, "right")
    n_children = np.where(d < bottom, 1, inside + (sizes[low] > d))
    n_leaves = leaves[high + 1] - leaves[low]
    conv = smallest.between(low, high)
    # a prefix's parent has its members, or those of the candidate above
    up_low, up_high = low.copy(), high.copy()
    up = np.flatnonzero(top & (d > 0))
    up_low[up], up_high[up] = shared.left(low[up], d[up] - 1), shared.right(low[up], d[up] - 1)
    parent = smallest.between(up_low, up_high)
    is_open, open_parent = (low == 0) | (high == n - 1), (up_low == 0) | (up_high == n - 1)
    keys = [prefix_key(paths[0]), prefix_key(paths[-1])]

    def key(at_first: bool, depth: int) -> bytes:
        return keys[0 if at_first else 1][depth]

    for start in range(0, len(d), BLOCK_ROWS):
        k = slice(start, start + BLOCK_ROWS)
        outer = zip(is_open[k].tolist(), open_parent[k].tolist(), low[k].tolist(), up_low[k].tolist(), d[k].tolist(), parent[k].tolist())
        named = [
            (
                key(i == 0, depth) if touches else None,
                key(i_up == 0, depth - 1) if depth and touches_up else None,
                above if depth and not touches_up else None,
            )
            for touches, touches_up, i, i_up, depth, above in outer
        ]
        own, parents, parent_ids = zip(*named)
        ended = (sizes[low[k]] == d[k]).tolist()
        yield _batch(
            kind=np.where(is_open[k], OPEN, COMPLETE).astype(np.int8),
            block=np.full(len(own), block, np.int64),
            key=own,
            parent_key=parents,
            depth=d[k],
            conv_id=conv[k],
            parent_conv_id=parent_ids,
            n_convs=n_convs[k],
            n_children=n_children[k],
            n_leaves=n_leaves[k],
            saved_tokens=saved[k],
            ends=[ends[i] if it_ends else None for i, it_ends in zip(low[k].tolist(), ended)],
        )


def seam(last: bytes, first: bytes, words) -> pa.RecordBatch:
    """What two blocks count twice: the shared prefixes of one's last path and the other's first; ``words`` are either's."""
    common = shared_turns(last, first)
    keys = prefix_key(first, common)
    upto = np.append(0, np.cumsum(np.asarray(words[:common], np.int64)))
    d = np.arange(common + 1)
    ends_within = len(last) // WIDTH == common  # the first path goes on where the last one ends, which is no leaf then
    return _batch(
        kind=np.full(len(d), OPEN, np.int8),
        key=keys,
        parent_key=[None, *keys[:-1]],
        depth=d,
        n_convs=np.zeros(len(d), np.int64),
        n_children=-(d < common).astype(np.int64),
        n_leaves=np.full(len(d), -int(ends_within), np.int64),
        saved_tokens=upto[common] - upto[np.maximum(d - 1, 0)],
    )


def _ended(rebuilt: DataFrame, most_ids: int) -> DataFrame:
    """path_key, least, n, ends: of equal conversations the smallest id, how many they are and the digest of their ids."""
    schema = pa.schema([("path_key", pa.binary()), ("least", pa.int64()), ("n", pa.int64()), ("ends", pa.binary()), ("ids", pa.binary())])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for conversations whose ids all lie within the part; of others the ids, in rows of a bounded size."""
        out: list[tuple] = []
        key, held, inner = None, [], False

        def close(complete: bool) -> None:
            if held:
                ids = ",".join(map(str, held)).encode()
                out.append((key, held[0], len(held), *((hashlib.sha256(ids).digest(), None) if complete else (None, ids))))
                held.clear()

        for batch in batches:
            for this, conv_id in zip(batch.column("path_key").to_pylist(), batch.column("conv_id").to_pylist()):
                if this != key:
                    close(inner)
                    key, inner = this, key is not None
                held.append(conv_id)
                if len(held) == most_ids:
                    close(False)
                    inner = False
            yield _rows(out, schema)
        close(False)
        yield _rows(out, schema)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of ids in order to one row for each conversation."""
        out: list[tuple] = []
        key, least, n, running = None, None, 0, None
        for batch in batches:
            for this, first, some, ids in zip(*[batch.column(c).to_pylist() for c in ("path_key", "least", "n", "ids")]):
                if this != key:
                    if key is not None:
                        out.append((key, least, n, running.digest(), None))
                    key, least, n, running = this, first, 0, hashlib.sha256()
                else:
                    running.update(b",")
                n += some
                running.update(ids)
            yield _rows(out, schema)
        if key is not None:
            out.append((key, least, n, running.digest(), None))
        yield _rows(out, schema)

    kind = "path_key binary, least long, n long, ends binary, ids binary"
    ids = rebuilt.select("path_key", "conv_id").repartitionByRange("path_key", "conv_id").sortWithinPartitions("path_key", "conv_id")
    parts = staged(ids.mapInArrow(joined, kind), "member-ids")
    over = parts.where("ids IS NOT NULL").repartition("path_key").sortWithinPartitions("path_key", "least").mapInArrow(finished, kind)
    return parts.where("ends IS NOT NULL").unionByName(over).drop("ids")


def _rows(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """The held rows as a batch; they are let go."""
    columns = list(zip(*held)) or [()] * len(schema)
    held.clear()
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _blocks(paths: DataFrame, block_rows: int, block_turns: int) -> DataFrame:
    """Nodes, complete or open, of all blocks of the sorted paths, and each part's first and last path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, before, held, turns = None, None, [], 0

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal number, before, turns
            paths, words, counts, least, ends = zip(*held)
            held.clear()
            turns = 0
            if before is None:
                yield _batch(kind=[FIRST], block=[number], path=[paths[0]], words=[words[0]])
            else:
                yield seam(before, paths[0], words[0])
            spoken = [np.array(w, np.int64) for w in words]
            yield from block_nodes(number, list(paths), np.array(counts, np.int64), np.array(least, np.int64), list(ends), spoken)
            number, before = number + 1, paths[-1]

        for batch in batches:
            if number is None and batch.num_rows:
                number = batch.column("part")[0].as_py() << 32
            for row in zip(*[batch.column(c).to_pylist() for c in ("path", "words", "n", "least", "ends")]):
                held.append(row)
                turns += len(row[1])
                if len(held) >= block_rows or turns >= block_turns:
                    yield from block()
        if held:
            yield from block()
        if before is not None:
            yield _batch(kind=[LAST], block=[number], path=[before])

    rows = paths.repartitionByRange("path").sortWithinPartitions("path").withColumn("part", F.spark_partition_id().cast("long"))
    return staged(rows.mapInArrow(run, _NODE_SQL), "trie-nodes")


def _seams(made: DataFrame) -> DataFrame:
    """What neighbouring parts count twice.  There are two rows for each part of the range exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("before", "path", "words")]):
                yield seam(*row)

    edges = made.where(F.col("kind").isin(FIRST, LAST)).select("kind", "block", "path", "words")
    order = Window.orderBy("block", "kind")
    met = edges.withColumn("before", F.lag("path").over(order)).where((F.col("kind") == FIRST) & F.col("before").isNotNull())
    return met.select("before", "path", "words").mapInArrow(run, _NODE_SQL)


def trie_nodes(sequences: DataFrame, block_rows: int = BLOCK_ROWS, block_turns: int = BLOCK_TURNS, most_ids: int = IDS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    ``sequences`` has conv_id, path (an array of turn digests) and words.
    """
    path = F.unhex(F.array_join(F.transform("path", F.hex), ""))
    rebuilt = staged(sequences.select("conv_id", path.alias("path"), _digest(path).alias("path_key"), "words"), "rebuilt")
    paths = rebuilt.groupBy("path_key").agg(F.first("path").alias("path"), F.first("words").alias("words"))
    made = _blocks(paths.join(_ended(rebuilt, most_ids), "path_key").drop("path_key"), block_rows, block_turns)

    figures = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    is_open = made.where(F.col("kind") == OPEN)
    parts = is_open.unionByName(_seams(made))
    merged = parts.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"),
        F.max("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in figures],
        F.max("ends").alias("ends"),
    )
    merged = staged(merged, "trie-merged")
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", *figures, "ends"]
    top = merged.join(above, "parent_key", "left").select(columns)
    # Most nodes may have the root above them, so its id is looked up by block.
    here = is_open.select("block", F.col("key").alias("parent_key")).join(above, "parent_key")
    complete = made.where(F.col("kind") == COMPLETE)
    inner = complete.where("parent_key IS NULL").select(columns)
    outer = complete.where("parent_key IS NOT NULL").drop("parent_conv_id").join(here, ["block", "parent_key"]).select(columns)
    nodes = top.unionByName(inner).unionByName(outer)
    ends = F.lower(F.hex(F.coalesce("ends", F.lit(NOTHING))))
    return nodes.select(*columns[:-1], ends.alias("ends_sha256"))
