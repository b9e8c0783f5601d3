"""Compression of vectors to codes: a small codebook for each part of the vector, learned in whole numbers.

A component x becomes the integer floor(4096 x).  Vectors are cut into equal consecutive parts, and each part position
has a codebook that starts as the parts of the vectors with the smallest ids.  In each round every part goes to its
nearest entry and every entry becomes the floored mean of its parts.  A vector's code names, part by part, the nearest
entries of the last codebooks.

Equal parts are one row with a count.  They are counted within Arrow batches first, so a very common vector costs one
row a batch; one range exchange by (position, part) then sorts them, adds up the counts and deals them evenly, however
common a part or its first components are.  The sorted parts are written once, and a round reads them in blocks.  A
block's sorted parts are a trie: parts that begin alike share the nodes of their common dimensions.  The trie is walked
depth first.  A node adds its dimension's squared differences from all entries to its parent's distances, so what
common dimensions cost is paid once; at a leaf the nearest entry is taken (the lowest of equally near ones) and the
part, times its count, is added to that entry's sum.  Only sums and counts leave a block.  The same walk, over the
distinct parts of an Arrow batch of vectors, gives the codes and errors at the end.

The driver holds the codebooks, entries x dimension numbers, and nothing that grows with the table.

Edge cases.  Vectors that are null, or hold null or non-finite components, are dropped; so are those whose length is
not the most frequent one (of equally frequent ones the smaller) among lengths that the parts divide.  Rows that repeat
an id are vectors of their own, equal ones in no particular order; a null id comes last.  With fewer vectors than
entries the codebooks are that much smaller.  Components may be up to 2**50: where 64 bits could overflow, Python's
integers are used; larger ones count as non-finite, and an error beyond a long is null and adds nothing to its label's.
An empty table gives an empty result.  Columns other than the id, the vector and the label are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtape.llm.common import staged

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LARGEST = float(1 << 50)
BLOCK = 1 << 15
_SIGN = np.uint64(1 << 63)

Codebook = list[list[int]]


def _usable(rows: DataFrame, key: str, vector: str, label: str, parts: int) -> DataFrame:
    """id, vector (doubles), label of the rows that take part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    out = rows.select(F.col(key).cast("long").alias("id"), v.alias("vector"), F.col(label).alias("label"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > LARGEST))
    out = out.where(F.col("vector").isNotNull() & ~odd & (F.size("vector") > 0) & (F.size("vector") % parts == 0))
    usual = out.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    return out.where(F.size("vector") == (usual["length"] if usual else -1))


def integers(vectors: pa.Array) -> np.ndarray:
    """A row of integers for each vector; all have one length."""
    flat = np.floor(vectors.values.slice(vectors.offsets[0].as_py()).to_numpy() * float(SCALE)).astype(np.int64)
    flat = flat[: vectors.offsets[-1].as_py() - vectors.offsets[0].as_py()]
    return flat.reshape(len(vectors), -1)


def _keys(parts: np.ndarray) -> np.ndarray:
    """Rows of integers as bytes that sort as the rows do."""
    raw = np.ascontiguousarray((parts.view(np.uint64) ^ _SIGN).astype(">u8"))
    return raw.view(f"V{8 * parts.shape[1]}").reshape(-1)


def _from_keys(keys: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(keys), ">u8").reshape(len(keys), -1)
    return (raw.astype(np.uint64) ^ _SIGN).view(np.int64)


def _distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct rows, for each row its place among them, and their counts."""
    order = np.lexsort(parts.T[::-1])
    rows = parts[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(1)
    place = np.empty(len(rows), np.int64)
    place[order] = np.cumsum(new) - 1
    return rows[new], place, np.diff(np.append(np.flatnonzero(new), len(rows)))


def walk_trie(parts: np.ndarray, codebook: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """For each of some sorted distinct parts the nearest entry and the squared distance from it.

    The rows are the leaves of a trie; the rows from ``low`` to ``high`` that begin alike are a node.  A branch without
    forks needs no walk: such rows are kept and finished together, depth by depth.
    """
    rows, depths = parts.shape
    entries = np.array(codebook, np.int64)
    most = max(int(np.abs(parts).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.int64 if 4 * most * most * depths < 1 << 62 else object
    parts, entries = parts.astype(kind), entries.astype(kind)
    nearest, distance = np.zeros(rows, np.int64), np.zeros(rows, kind)
    alone: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(depths + 1)]
    waiting = [(0, rows, 0, np.zeros(len(entries), kind))] if rows else []
    while waiting:
        low, high, depth, so_far = waiting.pop()
        values = parts[low:high, depth]
        starts = np.append(0, np.flatnonzero(values[1:] != values[:-1]) + 1)
        ends = np.append(starts[1:], high - low)
        sums = so_far + (values[starts][:, None] - entries[None, :, depth]) ** 2
        single = ends - starts == 1
        alone[depth + 1].append((low + starts[single], sums[single]))
        for k in np.flatnonzero(~single)[::-1]:  # the first child is taken up next
            waiting.append((low + int(starts[k]), low + int(ends[k]), depth + 1, sums[k]))
    at, sums = np.zeros(0, np.int64), np.zeros((0, len(entries)), kind)
    for depth in range(depths + 1):
        if depth and len(at):
            sums = sums + (parts[at, depth - 1][:, None] - entries[None, :, depth - 1]) ** 2
        if alone[depth]:
            at = np.concatenate([at, *[a for a, _ in alone[depth]]])
            sums = np.concatenate([sums, *[s for _, s in alone[depth]]])
    if len(at):
        nearest[at] = np.argmin(sums, axis=1)  # the first of equal ones
        distance[at] = sums[np.arange(len(at)), nearest[at]]
    return nearest, distance


def _counted_parts(usable: DataFrame, parts: int) -> DataFrame:
    """position, part, times: the distinct parts in order, written once."""
    schema = pa.schema([("position", pa.int32()), ("part", pa.binary()), ("times", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = integers(batch.column("vector"))
            for position, part in enumerate(np.split(rows, parts, axis=1)):
                different, _, counts = _distinct(part)
                keys = pa.array(_keys(different).tolist(), pa.binary())
                yield pa.record_batch([pa.array(np.full(len(counts), position, np.int32)), keys, pa.array(counts)], schema=schema)

    rows = usable.select("vector").mapInArrow(cut, "position int, part binary, times long")
    rows = rows.repartitionByRange("position", "part").groupBy("position", "part").agg(F.sum("times").alias("times"))
    return staged(rows.sortWithinPartitions("position", "part"), "vector-parts")


def _sums(counted: DataFrame, codebooks: list[Codebook]) -> DataFrame:
    """position, entry, times, sums: what every block's parts add to the entries nearest to them."""
    schema = pa.schema([("position", pa.int32()), ("entry", pa.int32()), ("times", pa.int64()), ("at", pa.int32()), ("total", pa.string())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[tuple[int, int], list] = {}
        for batch in batches:
            positions, times = batch.column("position").to_numpy(), batch.column("times").to_numpy()
            for position in np.unique(positions):
                chosen = np.flatnonzero(positions == position)
                for start in range(0, len(chosen), BLOCK):
                    rows = chosen[start : start + BLOCK]
                    block = _from_keys(batch.column("part").take(pa.array(rows)).to_pylist())
                    order = np.lexsort(block.T[::-1])  # a file's rows are in order, those of several files may not be
                    block, weights = block[order], times[rows][order]
                    nearest, _ = walk_trie(block, codebooks[position])
                    wide = int(np.abs(block).max()) * int(weights.sum()) >= 1 << 62
                    block, heavy = (block.astype(object), weights.astype(object)) if wide else (block, weights)
                    for entry in np.unique(nearest):
                        mine = nearest == entry
                        total = (block[mine] * heavy[mine][:, None]).sum(0)
                        held = out.setdefault((int(position), int(entry)), [0, [0] * block.shape[1]])
                        held[0] += int(weights[mine].sum())
                        held[1] = [a + int(b) for a, b in zip(held[1], total)]
        rows = [(p, e, n, k, str(t)) for (p, e), (n, totals) in out.items() for k, t in enumerate(totals)]
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    made = counted.mapInArrow(add, "position int, entry int, times long, at int, total string")
    return made.groupBy("position", "entry", "at").agg(F.sum("times").alias("times"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def fit(usable: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[Codebook]:
    """The codebook of each position after all rounds; no codebooks for an empty table."""
    ids = [F.col("id").isNull(), F.col("id"), F.transform("vector", lambda x: F.floor(x * SCALE))]
    first = usable.orderBy(*ids).limit(entries).select("vector").toArrow().column("vector").combine_chunks()
    if not len(first):
        return []
    start = integers(first)
    codebooks = [part.tolist() for part in np.split(start, parts, axis=1)]
    counted = _counted_parts(usable, parts)
    for _ in range(rounds):
        for r in _sums(counted, codebooks).collect():  # entries x dimension rows
            codebooks[r["position"]][r["entry"]][r["at"]] = int(r["total"]) // r["times"]
    return codebooks


def codebooks_sha256(codebooks: list[Codebook]) -> str:
    said = ",".join(str(x) for book in codebooks for entry in book for x in entry)
    return hashlib.sha256(said.encode()).hexdigest()


def encode(usable: DataFrame, codebooks: list[Codebook]) -> DataFrame:
    """id, label, code, error for every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(start, BLOCK)
                codes, errors = [], 0
                for part, book in zip(np.split(integers(rows.column("vector")), len(codebooks), axis=1), codebooks):
                    different, place, _ = _distinct(part)
                    nearest, distance = walk_trie(different, book)
                    codes.append(nearest[place].astype(np.uint8))
                    errors = errors + distance[place].astype(object)
                code = [row.tobytes().hex() for row in np.stack(codes, 1)]
                error = [int(e) if e < 1 << 63 else None for e in errors]
                columns = [rows.column("id"), rows.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "label", "code", "error"])

    label = usable.schema["label"].dataType.simpleString()
    return usable.mapInArrow(run, f"id long, label {label}, code string, error long")


def compress(rows: DataFrame, key="vec_id", vector="embedding", label="label", parts=PARTS, entries=ENTRIES, rounds=ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for every vector that takes part."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's index has two hexadecimal digits")
    usable = _usable(rows, key, vector, label, parts)
    codebooks = fit(usable, parts, entries, rounds)
    if not codebooks:
        return rows.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = staged(encode(usable, codebooks), "vector-codes")
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error")
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(total)
    out = coded.join(by_label, coded["label"].eqNullSafe(by_label["of_label"]))
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codebooks_sha256(codebooks)).alias("codebooks_sha256"))
