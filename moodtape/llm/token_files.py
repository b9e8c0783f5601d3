"""Token ids in Parquet files: list columns with chosen encodings, row groups and page indexes.

A file row is one document: its id, where its ids start, how many they are, and the ids as a list.  Ids are
dictionary-encoded, or delta-encoded by parameter; the number columns are always delta-encoded.  Row groups and pages
are sized by parameter, and as pages carry indexes and the numbers are columns of their own, a reader that wants some
documents' lengths, or the ids of a range of documents, reads just those pages (``read_tokens``).

Documents are written in ascending doc_id order: a range exchange of the texts, a sort in each part, and the ids made
in that order in Arrow batches.  A row stores its start within its part; the start in the whole corpus adds the sums
of the parts before, a table of one small row per file, which a reader broadcasts.  No part needs another one, so a lost
executor costs its parts only.  There are as many parts as Spark's estimate of the input's size asks for.

Runs of letters repeat, so their ids are looked up in a bounded table first.  That is exact for a tokenizer that brings
texts into composed form and lower case, drops white space and cuts a text into such runs, which is read from its file;
with any other one, texts are encoded as a whole.

Edge cases.  A null text has the end id alone.  A null doc_id comes first.  Rows with equal doc_id are ordered by a
hash of their text; equal rows are interchangeable.  Long texts are written whole; a batch is cut by its number of
ids.  An empty table gives files without rows.  Columns other than doc_id and text are not written.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodtape.llm.common import whole_text

ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 64 << 10, 2000
BATCH_IDS = 1 << 21
LEARN_CHARS = 1 << 20
#: Entries after which the newer of two tables of known runs becomes the older one; what is found there moves back.
TABLE = 350_000
#: Bytes of input for each part of the range exchange, and the most parts.
PART_BYTES, MOST_PARTS = 32 << 20, 100_000
#: Files up to which their starts are broadcast, at most 24 bytes each.
BROADCAST_FILES = 1 << 20

# What a tokenizer's file says if it makes its runs as this module does.
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_RUN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_RUN_SPLIT = {"type": "Split", "pattern": {"Regex": _RUN_PATTERN}, "behavior": "Removed", "invert": True}


def makes_known_runs(tokenizer: str) -> bool:
    """Whether the tokenizer (its JSON) cuts texts into the runs that ``RunTable`` makes, each with an end of its own."""
    told = json.loads(tokenizer)
    normalizer, cutter, model = told.get("normalizer") or {}, told.get("pre_tokenizer") or {}, told.get("model") or {}
    steps = cutter.get("pretokenizers") or [{}]
    return (
        normalizer.get("normalizers") == _NORMALIZERS
        and steps[0] == _RUN_SPLIT
        and [(p.get("type"), p.get("use_regex"), p.get("add_prefix_space")) for p in steps[1:]] == [("ByteLevel", False, False)]
        and model.get("type") == "BPE"
        and model.get("end_of_word_suffix") == "</w>"
        and not model.get("dropout")
        and not told.get("truncation")
        and not told.get("padding")
        and all(t["special"] and not t["normalized"] and t["content"].startswith("<|") for t in told.get("added_tokens", []))
    )


class RunTable:
    """Ids of texts as little-endian 32-bit integers, put together from those of their runs.

    The tokenizer first cuts a text into runs (letters, one digit, other signs, short endings such as 's), whose ids
    don't depend on each other; a table holds the runs known so far.  A new run goes straight to the tokenizer's merges.
    Where a text holds anything whose runs this module doesn't make for sure as the tokenizer does, it is cut at blanks,
    and such words are encoded alone.
    """

    def __init__(self, path: str, whole_texts: bool | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.whole = not makes_known_runs(self.tokenizer.to_str()) if whole_texts is None else whole_texts
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _units(self, text: str) -> list[str]:
        runs = _runs(text)
        if runs is not None:
            return runs
        out: list[str] = []
        for word in text.replace("\n", " ").split(" "):
            runs = _runs(word)
            if runs is None:
                if word not in self.known:
                    self.known[word] = self._ids(word).tobytes()
                runs = [word]
            out += runs
        return out

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if self.whole:
            return [self._ids(text).tobytes() for text in texts]
        if len(self.known) >= TABLE:
            self.older, self.known = self.known, {}
        units, new = [self._units(text) for text in texts], set()
        for of_text in units:
            new.update(of_text)
        self._learn(new.difference(self.known))
        known = self.known.__getitem__
        return [b"".join(map(known, of_text)) for of_text in units]

    def _learn(self, new: set[str]) -> None:
        again = new.intersection(self.older)
        self.known.update(zip(again, map(self.older.__getitem__, again)))
        tokenize, known = self.tokenizer.model.tokenize, self.known
        for run in new.difference(again):
            # Runs are as the tokenizer's own first steps leave them, so its model takes them, with a letter for each byte.
            raw = run if run.isascii() else run.encode("utf-8", "replace").decode("latin-1").translate(_BYTE_LETTERS)
            known[run] = array("I", [token.id for token in tokenize(raw)]).tobytes()


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where it can be seen, else the next of those from 256 on."""
    seen = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    unseen = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(unseen)}


_BYTE_LETTERS = _byte_letters()


# The tokenizer's own runs, in lower case: for printable ASCII, and with other letters.
_ASCII_RUNS = re.compile(r"[a-z]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^\sa-z0-9]+")
_LETTER_RUNS = re.compile(r"[^\W\d_]+|[0-9]|'(?:[stmd]|re|ve|ll)|(?:[^\s\w]|_)+")
_PLAIN = re.compile(r"(?:[a-z]+|[ \n\t]+|[.,](?![.,]))*+")
_PLAIN_LETTERS = re.compile(r"(?:[^\W\d_]+|[ \n\t]+|[.,](?![.,]))*+")
_UNSURE = re.compile(r"[\x00-\x08\x0b-\x1f\x7f]|<\|")


def _runs(text: str) -> list[str] | None:
    """The tokenizer's runs of a text, or None where they aren't sure: control characters, special tokens, and letters
    that normalisation could join, or that aren't one letter when lower-cased."""
    if _UNSURE.search(text):
        return None
    if text.isascii():
        low = text.lower()
        return _plain_runs(low) if _PLAIN.fullmatch(low) else _ASCII_RUNS.findall(low)
    for c in set(text):
        if c > "\x7f" and not (c.isalpha() and len(c.lower()) == 1 and c.lower().isalpha() and c != "Σ"):
            return None
    if not unicodedata.is_normalized("NFC", text):
        return None
    low = text.lower()
    return _plain_runs(low) if _PLAIN_LETTERS.fullmatch(low) else _LETTER_RUNS.findall(low)


def _plain_runs(text: str) -> list[str]:
    """Runs of letters with single commas and stops between them: they need no pattern."""
    return text.replace(",", " , ").replace(".", " . ").split()


@lru_cache(1)
def _table(path: str, whole_texts: bool | None) -> RunTable:
    return RunTable(path, whole_texts)


def _encoded(table: RunTable, column: pa.Array) -> Iterator[bytes]:
    """The ids of a column's texts, about a million characters at a time."""
    held, size = [], 0
    for value in column:
        held.append(value.as_py())
        size += len(held[-1])
        if size >= LEARN_CHARS:
            yield from table.encode_all(held)
            held, size = [], 0
    yield from table.encode_all(held)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    encoding: str = "dictionary",
    whole_texts: bool | None = None,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Write part, doc_id, first, n_tokens, ids; ``first`` counts the ids before it in its part.

    ``whole_texts`` says that runs are not to be looked up; unset, the tokenizer's file decides.
    """
    kind = docs.schema["doc_id"].dataType
    out = pa.schema(
        [("part", pa.int32()), ("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))]
    )
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, before = _table(tokenizer, whole_texts), 0

        def batch(part: pa.Array, ids: pa.Array, encoded: list[bytes], first: int) -> pa.RecordBatch:
            sizes = np.array([len(e) // 4 for e in encoded], np.int64)
            ends = np.cumsum(sizes)
            values = pa.array(np.frombuffer(b"".join(encoded), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), values)
            return pa.record_batch([part, ids, pa.array(first + ends - sizes), pa.array(sizes), lists], schema=out)

        for rows in batches:
            start, held, encoded = 0, 0, []
            for ids in _encoded(table, rows.column("text")):
                encoded.append(ids + end)
                held += len(encoded[-1]) // 4
                if held >= BATCH_IDS:
                    stop = start + len(encoded)
                    yield batch(rows.column("part")[start:stop], rows.column("doc_id")[start:stop], encoded, before)
                    before, start, held, encoded = before + held, stop, 0, []
            if encoded:
                yield batch(rows.column("part")[start:], rows.column("doc_id")[start:], encoded, before)
                before += held

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), F.xxhash64(whole_text()).alias("tie"))
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, min(MOST_PARTS, size // PART_BYTES))
    rows = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    made = rows.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(
        run, "part int, doc_id long, first long, n_tokens long, ids array<int>"
    )
    made = made.withColumn("doc_id", F.col("doc_id").cast(kind))
    writer = made.write.option("compression", "zstd").option("parquet.writer.version", "v2")
    writer = writer.option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
    writer = writer.option("parquet.page.row.count.limit", page_rows)
    for name in ("part", "doc_id", "first", "n_tokens", *(["ids.list.element"] if encoding == "delta" else [])):
        writer = writer.option(f"parquet.enable.dictionary#{name}", "false")
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids of written files; unused columns are not read, filters on doc_id reach the pages."""
    files = spark.read.parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    if len(files.inputFiles()) <= BROADCAST_FILES:  # a part is one file
        starts = F.broadcast(starts)
    return files.join(starts, "part").select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids")


def token_report(written: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what ``read_tokens`` reads."""

    @F.arrow_udf("long")
    def crc32(lists: pa.Array) -> pa.Array:
        ends = lists.offsets.to_numpy()
        raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(), dtype="<i4")).cast("B")
        return pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:])], pa.int64())

    return written.select("doc_id", "start", "n_tokens", crc32("ids").alias("ids_crc32"))
