"""The whole pipeline against a plain version of every stage after the first."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from moodtape.llm import catalog, language
from moodtape.llm.common import tokenizer_path
from tests.llm.brute import near_components
from tests.llm.conftest import BLANKS

REJECTED = [(900_001, None), (900_002, ""), (900_003, "12 34 -- 56"), (900_004, " \n\t ")]


def plain_stages(rows):
    """doc_id with ids, as often as they are taken, from (doc_id, text, source) of the documents in some language."""
    best = {}
    for doc_id, text, source in rows:
        bare = "".join(c for c in text if c not in BLANKS)
        rank = (-len(text), doc_id)
        if bare not in best or rank < best[bare][0]:
            best[bare] = (rank, (doc_id, text, source))
    rows = [row for _, row in best.values()]
    component = near_components([(i, t) for i, t, _ in rows], 5)
    rows = [row for row in rows if component[row[0]] == row[0]]
    con = duckdb.connect()
    table = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "source": [r[2] for r in rows]})
    con.register("given", table)
    con.execute("create table documents as select * from given")
    taken = {i: (n, size) for i, size, n in con.execute(f"select doc_id, size, taken from ({catalog.ORACLE['op3_source_mix']})").fetchall()}
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(corpus_pipeline.PIECES))
    out = Counter()
    for doc_id, text, _ in rows:
        n, size = taken[doc_id]
        if n:
            out[doc_id, (*library.encode(text), library.eos_id())] += n // size
    return out


def test_run_equals_plain_stages(spark, tmp_path):
    rng = random.Random(12)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns = docs.schema
    rows = [tuple(r) for r in docs.collect()]
    at = {n: k for k, n in enumerate(columns.names)}
    whole = [r for r in rows if r[at["text"]] and len(r[at["text"]].split()) > 60][:12]
    for k, r in enumerate(whole):  # exact copies with other blanks, near copies
        words = r[at["text"]].split()
        edited = list(words)
        edited[rng.randrange(len(words))] = "changed"
        for n, text in ((910_000 + k, "  ".join(words)), (920_000 + k, " ".join(edited))):
            rows.append(tuple(n if c == "doc_id" else text if c == "text" else r[at[c]] for c in columns.names))
    rows += [rows[0], rows[0]]
    for doc_id, text in REJECTED:
        rows.append(tuple({"doc_id": doc_id, "text": text, "lang": "en", "source": "s"}.get(c) for c in columns.names))
    spark.createDataFrame(rows, columns).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())

    given = spark.read.parquet(f"{tmp_path}/documents.parquet")
    first = [tuple(r) for r in corpus_pipeline.STAGES[0][1](spark, given, str(tmp_path)).select("doc_id", "text", "source").collect()]
    kept = {i for i, _, _ in first}
    assert not kept & {i for i, _ in REJECTED}
    told = [r for r in rows if r[at["lang"]] and r[at["text"]] and any(c.isalpha() for c in r[at["text"]])]
    assert len({r[at["doc_id"]] for r in told} - kept) <= 0.03 * len(told)
    assert got == plain_stages(first)


def test_run_on_an_empty_table(spark, none, tmp_path):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("n", [1, 2, 7, 3000])
def test_low_margin_is_the_exact_quantile(spark, n):
    rng = random.Random(n)
    values = [rng.choice([rng.gauss(1, 2), 0.25]) for _ in range(n)]
    rows = spark.createDataFrame([(v, language.WEIGHT) for v in [*values, np.inf]], "m double, weight long")
    for q in (0.0, 0.005, 0.3, 1.0):
        assert language.low_margin(rows, q) == np.quantile(values, q)
    many = rows.withColumn("m", F.explode(F.array(*[F.col("m")] * 2))).repartition(5)
    assert language.low_margin(many, 0.3) == np.quantile(values * 2, 0.3)


def test_limits_come_from_all_held_out_texts(spark):
    words = {"en": "the house was there with them and that", "fr": "les maisons sont pour nous avec une"}
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choices(words[x].split(), k=rng.randrange(1, 9))), x) for k in range(3000) for x in [rng.choice(["en", "fr"])]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language.fit(docs.where(~language.held_out()))
    limits = language.with_limits(model, docs.where(language.held_out())).limits
    judged = [(*model.judge(t), x) for i, t, x in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    each = {x: min(1, language.PER_LANGUAGE / sum(y == x for *_, y in judged)) for x in words}
    assert min(each.values()) < 1
    right = sorted((m, each[x]) for told, _, m, _, x in judged if told == x)
    place, below = language.LIMIT_QUANTILE * (sum(w for _, w in right) - 1), 0
    ends = []
    for k in (int(place), int(place) + 1):
        below = 0
        for m, w in right:
            below += w
            if below > k + 1e-3:
                ends.append(m)
                break
    low = np.quantile(ends, place - int(place))
    assert limits[0] == pytest.approx(min(low, language.LIMIT_PART * low), rel=1e-4)


def test_batches_of_the_pipeline_are_small(spark):
    before = spark.conf.get(corpus_pipeline.BATCH_SETTING)
    try:
        for given, expect in (("10000", "500"), ("0", "500"), ("20", "20")):
            spark.conf.set(corpus_pipeline.BATCH_SETTING, given)
            corpus_pipeline.small_batches(spark)
            assert spark.conf.get(corpus_pipeline.BATCH_SETTING) == expect
    finally:
        spark.conf.set(corpus_pipeline.BATCH_SETTING, before)
