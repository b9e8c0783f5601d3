"""SentencePiece encoding and decoding for merge-type models.

The encoding is exact and found by backtracking instead of by merging: an Aho-Corasick automaton gives the longest
piece at every position; a piece is taken if it is compatible with the one before it, which holds when merging the
two pieces' characters again gives just these two; else the next shorter piece is tried, else the last piece is given
up and its end is marked in a bitfield of failed positions, so no position is tried twice.  A sequence whose
neighbours are all compatible is the one that merging gives.

Merging two pieces again is decided by ranks, without any strings.  Every piece keeps the two pieces of its last merge.
Going back in time from two finished neighbours, the one that was made later comes apart into these two, and what lies
at the border then are its nearer part and the other piece.  The two conflict if at some such time the parts at the
border would have merged before either was taken into the piece it belongs to.

Words repeat, so chunks (a run of spaces and the word after it) are looked up in a bounded table first; that is exact
as no piece continues over a space, which is checked when the model is loaded, and without that property the whole
text is one chunk.  Characters in no piece become byte pieces, and part a chunk.  A chunk's ids are kept as decimal
text, the smallest form Python has for them; a whole text's ids are read from the joined texts at once.  Decoding is
the library's.

Edge cases.  A null text encodes like an empty one: the end id alone.  Texts of any length are encoded whole; ties
between merges go to the left one, as in the library.  Rows are independent, so repeated rows and empty tables need
no care.  ``with_ids`` replaces a column called like its output and keeps all others.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
_CHUNKS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Entries of the table of known neighbours, which is emptied when full, and of each of the two tables of known
#: chunks: the newer one, when full, becomes the older one, and what is found there moves back.
TABLE = 250_000
#: Letters in a chunk that is kept in the table.
LONGEST = 100
#: Ids after which ``with_ids`` cuts a batch.
BATCH_IDS = 1 << 20


class MergeEncoder:
    """Encodes texts with a merge-type SentencePiece model, an end id at the end."""

    def __init__(self, path: str, table: int = TABLE):
        import sentencepiece

        self.table = table

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(sp.get_piece_size())
        if any(sp.is_unused(i) for i in every):
            raise ValueError("models with unused pieces are not supported")
        special = {i for i in every if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)}
        self.end = sp.eos_id()
        self.bytes = {int(sp.id_to_piece(i)[3:-1], 16): i for i in special if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        ids = {sp.id_to_piece(i): i for i in every if i not in special}
        scores = {p: sp.get_score(i) for p, i in ids.items()}
        self.letters = frozenset("".join(ids))
        # Pieces by number: first the letters, which no merge makes, then the rest in the order of their merges.
        longer = sorted((p for p in ids if len(p) > 1), key=lambda p: -scores[p])
        pieces = [*sorted(self.letters), *longer]
        number = {p: n for n, p in enumerate(pieces)}
        self.said = [str(ids[p]) if p in ids else self._as_bytes(p) for p in pieces]
        self.size = [len(p) for p in pieces]
        # Pieces of one score merge at one time, the left one first.
        self.rank, rank = [-1] * len(pieces), -1
        for n in range(len(self.letters), len(pieces)):
            if n == len(self.letters) or scores[pieces[n]] != scores[pieces[n - 1]]:
                rank += 1
            self.rank[n] = rank
        self._ranked = {p: self.rank[number[p]] for p in longer}
        self.left, self.right = list(range(len(pieces))), list(range(len(pieces)))
        self.merges: dict[int, int] = {}  # two pieces, as one number, to the rank of their merge
        self._many = len(pieces)
        trie = self.trie = ahocorasick.Automaton()
        for piece, n in number.items():
            last = self._last_merge(piece)
            if last is not None:  # else merging never gives this piece
                if len(piece) > 1:
                    self.left[n], self.right[n] = number[last[0]], number[last[1]]
                trie.add_word(piece, n)
        for piece in longer:  # any two pieces that give one merge, not only those of its own last merge
            for cut in range(1, len(piece)):
                a, b = number.get(piece[:cut]), number.get(piece[cut:])
                if a is not None and b is not None:
                    self.merges[a * self._many + b] = self.rank[number[piece]]
        trie.make_automaton()
        self.shorter = [-1] * len(pieces)
        for n, piece in enumerate(pieces):
            cuts = (number.get(piece[:k]) for k in range(len(piece) - 1, 0, -1))
            self.shorter[n] = next((m for m in cuts if m is not None and pieces[m] in trie), -1)
        self.over_space = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in ids)
        self.fits: list[dict[int, bool]] = [{} for _ in pieces]  # for each piece, what may or may not come after it
        self.known_fits = 0
        self.chunks: dict[str, str] = {}
        self.older: dict[str, str] = {}

    def _as_bytes(self, text: str) -> str:
        if not self.bytes:
            return str(self.unknown)
        return " ".join([str(self.bytes[b]) for b in text.encode("utf-8", "replace")])

    def _last_merge(self, piece: str) -> tuple[str, ...] | None:
        """The two parts that merging the piece's letters joins last; None if it doesn't give the piece."""
        parts, last = list(piece), (piece,)
        while len(parts) > 1:
            ranked = [(self._ranked.get(a + b, -1), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))]
            best = min(((r, k) for r, k in ranked if r >= 0), default=None)
            if best is None:
                return None
            last = tuple(parts[best[1] : best[1] + 2])
            parts[best[1] : best[1] + 2] = ["".join(last)]
        return last

    def _fit(self, a: int, b: int) -> bool:
        """Whether merging the letters of two pieces again gives the two."""
        many, rank, merge = self._many, self.rank, self.merges.get
        limit = 1 << 60  # when the first of the parts at the border is taken into a larger one
        while True:
            joined = merge(a * many + b)
            if joined is not None and joined < limit:
                return False
            if rank[a] > rank[b]:
                limit = rank[a]
                a = self.right[a]
            elif rank[b] >= 0:  # of two merges of one rank the right one came later
                limit = rank[b] + 1  # a merge at the border is left of it, so it wins a tie
                b = self.left[b]
            else:
                return True

    def _fits_after(self, before: int, piece: int) -> bool:
        if self.known_fits >= self.table:
            self.fits, self.known_fits = [{} for _ in self.fits], 0
        self.known_fits += 1
        ok = self.fits[before][piece] = self._fit(before, piece)
        return ok

    def segment(self, text: str) -> list[int] | None:
        """The pieces of a text, by backtracking; None if a letter of it is in no piece."""
        longest, size = [-1] * len(text), self.size
        for end, piece in self.trie.iter(text):
            longest[end + 1 - size[piece]] = piece  # a later end is a longer piece
        if -1 in longest:
            return None
        taken: list[int] = []
        at, piece, stop, failed = 0, longest[0], len(text), None
        while True:
            end = at + size[piece]
            ok = failed is None or not failed[end >> 3] >> (end & 7) & 1
            if ok and at:
                before = taken[-1]
                ok = self.fits[before].get(piece)
                if ok is None:
                    ok = self._fits_after(before, piece)
            if ok:
                taken.append(piece)
                at = end
                if at == stop:
                    return taken
                piece = longest[at]
                continue
            while self.shorter[piece] < 0:
                if failed is None:
                    failed = bytearray(stop // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                piece = taken.pop()
                at -= size[piece]
            piece = self.shorter[piece]

    def _chunk(self, chunk: str) -> str:
        """The ids of a chunk in decimal."""
        known = self.older.get(chunk)
        if known is None:
            pieces = self.segment(chunk)
            if pieces is not None:
                known = " ".join([self.said[p] for p in pieces])
            else:
                parts = [(known, "".join(run)) for known, run in groupby(chunk, self.letters.__contains__)]
                said = [" ".join(map(self.said.__getitem__, self.segment(p))) if known else self._as_bytes(p) for known, p in parts]
                known = " ".join(said)
        if len(chunk) <= LONGEST:
            if len(self.chunks) >= self.table:
                self.older, self.chunks = self.chunks, {}
            self.chunks[chunk] = known
        return known

    def _chunks_of(self, text: str | None) -> list[str]:
        if not text:
            return []
        text = self.library.normalize(text)
        if not text:
            return []
        if self.over_space:
            return [self._chunk(text)]
        known = self.chunks.get
        return [known(c) or self._chunk(c) for c in _CHUNKS.findall(text)]

    def forget(self) -> None:
        """Empty the tables of chunks."""
        self.chunks, self.older = {}, {}

    def encode_as_text(self, text: str | None) -> str:
        """The ids in decimal, one space between, the end id last."""
        return " ".join([*self._chunks_of(text), str(self.end)])

    def encode_array(self, text: str | None) -> np.ndarray:
        return np.fromstring(self.encode_as_text(text), np.int32, sep=" ")

    def encode(self, text: str | None) -> list[int]:
        return self.encode_array(text).tolist()

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(1)
def encoder(path: str, table: int = TABLE) -> MergeEncoder:
    """One encoder for each worker process."""
    return MergeEncoder(path, table)


def with_ids(docs: DataFrame, path: str, output: str = "ids", text: str = "text", keep_text: bool = True, table: int = TABLE) -> DataFrame:
    """``docs`` with the ids of every text, the end id last; ``keep_text=False`` leaves the text column out.

    ``table`` bounds a worker's tables, for jobs that need its memory: about 250 bytes an entry, in three tables.
    """
    kept = [f for f in docs.schema.fields if f.name != output]
    out = [f for f in kept if keep_text or f.name != text]
    # Names of their own on the way, as mapInArrow takes none that hold a dot.
    schema = T.StructType([T.StructField(f"c{k}", f.dataType) for k, f in enumerate(out)] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path, table)
        for batch in batches:
            columns = [batch.column(k) for k, f in enumerate(kept) if keep_text or f.name != text]
            texts = batch.column([f.name for f in kept].index(text))
            held: list[np.ndarray] = []
            start = size = 0
            for k in range(batch.num_rows + 1):
                if held and (size >= BATCH_IDS or k == batch.num_rows):
                    ends = np.cumsum([0, *map(len, held)]).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(held)))
                    yield pa.RecordBatch.from_arrays([*[c.slice(start, k - start) for c in columns], ids], names=schema.names)
                    held, start, size = [], k, 0
                if k < batch.num_rows:
                    held.append(made.encode_array(texts[k].as_py()))
                    size += len(held[-1])
        made.forget()  # a worker that goes on to other stages of a pipeline needs its memory

    plain = docs.select(*[F.col(f"`{f.name}`").alias(f"c{k}") for k, f in enumerate(kept)])
    return plain.mapInArrow(run, schema).toDF(*[f.name for f in out], output)


def with_text(encoded: DataFrame, path: str, ids: str = "ids", output: str = "text") -> DataFrame:
    """The ids decoded; null ids decode to null."""

    @F.arrow_udf("string")
    def texts(values: pa.Array) -> pa.Array:
        made = encoder(path)
        return pa.array([None if v is None else made.decode(v) for v in values.to_pylist()], pa.string())

    return encoded.withColumn(output, texts(ids))


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()


def encoding_digests(docs: DataFrame, path: str, *others: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row: encoded, then decoded from the ids."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pd.Series) -> pd.DataFrame:
        made, rows = encoder(path), []
        for text in texts:
            said = made.encode_as_text(text)
            ids = np.fromstring(said, np.int32, sep=" ")
            rows.append((len(ids), _sha256(said), _sha256(made.decode(ids.tolist()))))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    made = docs.select("doc_id", *others, digests("text").alias("made"))
    return made.select("doc_id", *others, "made.*")
