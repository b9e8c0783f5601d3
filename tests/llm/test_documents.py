"""The document operators on odd rows, against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
import zlib
import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from moodtape.llm import exact_dedup, language, licenses, line_dedup, mixing, near_dedup, pieces, token_files
from moodtape.llm.common import tokenizer_path
from moodtape.session import work_path
from tests.llm.brute import LOWER, near_components, shingles
from tests.llm.conftest import BLANKS, make_rows

sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
ROWS = [(r[0], r[1]) for r in make_rows()]
PIECES = tokenizer_path("piece_bpe_32k.model")


def test_exact_dedup(odd):
    groups = defaultdict(list)
    bare = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    for i, t in ROWS:
        groups[bare(t)].append((-len(t or ""), i is None, i))
    keep = {t: min(g)[2] for t, g in groups.items()}
    expected = Counter((i, keep[bare(t)], len(groups[bare(t)]), i == keep[bare(t)], sha(bare(t))) for i, t in ROWS)
    for fan in (2, 16):
        assert Counter(map(tuple, exact_dedup.mark_copies(odd, fan).collect())) == expected
    left = exact_dedup.drop_copies(odd)
    assert left.columns == odd.columns
    assert sorted(sha(bare(r.text)) for r in left.collect()) == sorted(map(sha, groups))


@pytest.mark.parametrize("batches,fan", [(1, 2), (4, 2), (7, 3)])
def test_line_dedup(odd, batches, fan):
    holders = defaultdict(set)
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    for i, t in ROWS:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(i)
    last = {k: max(x for x in h if x is not None) for k, h in holders.items() if len(h) >= 3}
    expected = []
    for i, t in ROWS:
        lines = (t or "").split("\n")
        kept = [x for x in lines if last.get(key(x), i) == i]
        expected.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    got = line_dedup.line_report(odd, batches=batches, fan=fan)
    assert Counter(map(tuple, got.collect())) == Counter(expected)
    assert any(e[2] for e in expected)


def test_line_dedup_keeps_columns(odd):
    assert line_dedup.drop_lines(odd).columns == odd.columns


@pytest.mark.parametrize("crowd,block", [(64, 1024), (2, 3)])
def test_near_duplicates(odd, monkeypatch, crowd, block):
    monkeypatch.setattr(near_dedup, "CROWD", crowd)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    component = near_components(ROWS, 4)
    expected = Counter((i, len(shingles(t, 4)), component.get(i), i == component.get(i)) for i, t in ROWS)
    got = near_dedup.near_duplicates(odd, words=4)
    assert Counter(map(tuple, got.collect())) == expected
    assert max(Counter(component.values()).values()) > 8


def test_near_duplicates_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    component = near_components(rows, 5)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    assert got == component


def test_registers_estimate_similarity():
    a = near_dedup.shingle_set(" ".join(map(str, range(2000))), 5)
    b = near_dedup.shingle_set(" ".join(map(str, range(200, 2200))), 5)
    ra, rb = (near_dedup.registers(x) for x in (a, b))
    assert abs((ra == rb).mean() - 1796 / 2196) < 0.1
    one = np.array([1.0])
    assert near_dedup.may_link(ra[None], rb[None], one * len(a), one * len(b), 80)[0]
    far = near_dedup.registers(near_dedup.shingle_set(" ".join(map(str, range(3000, 5000))), 5))
    assert not near_dedup.may_link(ra[None], far[None], one * len(a), one * 1996, 80)[0]
    assert near_dedup.word_hashes("A b\tc" + "x" * 70_000 + " " + "y " * 70_000).shape == (70_003,)
    assert len(set(near_dedup.word_hashes("aB Ab É é").tolist())) == 3


def test_mix(odd):
    rows = mixing.mix_report(odd).collect()
    size = lambda t: len((t or "").encode().split())
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((i, size(t)) for i, t in ROWS)
    assert all(r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0) for r in rows)
    assert abs(sum({r.target: r.target for r in rows}.values()) - sum(r["size"] for r in rows)) < 1e-6
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.mix_report(odd, bins=3).collect()), key=repr)
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    taken = Counter()
    for r in rows:
        taken[r.doc_id] += r.taken
    got = Counter()
    for r in mixed.collect():
        got[r.doc_id] += size(r.text)
    assert +got == +taken


def test_mix_comes_near_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    report = mixing.mix_report(docs).join(docs.select("doc_id", "source"), "doc_id")
    for r in report.groupBy("source").agg(F.max("target").alias("t"), F.sum("taken").alias("n"), F.max("size").alias("m")).collect():
        assert abs(r.n - r.t) <= r.m / 2 + 1


def test_water_level(spark):
    rows = [(1, "w " * 10, "a"), (2, "w " * 10, "b"), (3, "w " * 1000, "c"), (4, "w " * 5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.target for r in mixing.mix_report(docs).collect()}
    assert got == {1: 30.0, 2: 30.0, 4: 15.0, 3: 950.0}


def test_pieces(odd):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = []
    for i, t in ROWS:
        ids = library.encode(t or "") + [library.eos_id()]
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    assert Counter(map(tuple, pieces.encoding_digests(odd, PIECES).collect())) == Counter(expected)
    encoded = pieces.with_ids(odd, PIECES)
    again = pieces.with_text(encoded, PIECES, output="again").select("text", "again").collect()
    assert all(r.again == (r.text or "") for r in again)


def test_pieces_are_those_of_merging():
    import random

    made = pieces.MergeEncoder(PIECES)
    rng = random.Random(3)
    parts = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "é", "ß", "日", "▁", "\x00", "😀", "===", "https://", "    ", "aaaa"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 20)))
        assert made.encode(text) == made.library.encode(text) + [made.end]
    assert made.encode("aaaaabab" * 5000)[:-1] == made.library.encode("aaaaabab" * 5000)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, odd, encoding):
    from tokenizers import Tokenizer

    path, words = work_path(spark, "tokens"), tokenizer_path("word_bpe_49k.json")
    token_files.write_tokens(odd, path, words, 1, encoding=encoding, page_rows=5)
    got = token_files.token_report(token_files.read_tokens(spark, path)).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(words)
    expected, start = Counter(), 0
    for i, t in ROWS:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        expected[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    assert [r.doc_id is not None for r in got] == sorted(r.doc_id is not None for r in got)
    known = [r.doc_id for r in got if r.doc_id is not None]
    assert known == sorted(known)
    for r in got:
        assert r.start == start
        start += r.n_tokens


def test_words_encode_like_whole_texts():
    import random

    table = token_files.RunTable(tokenizer_path("word_bpe_49k.json"))
    rng = random.Random(2)
    parts = "a B the It's 's 'S don't I'LL . , ... ,. é É ß 日本 İ ς Σ 1 12 <|endoftext|> ﬁ Ⅳ _ -".split() + [" ", "  ", "\n", "\t", "́", "　"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(table.encode_all([text])[0], "<u4").tolist() == table.tokenizer.encode(text, add_special_tokens=False).ids


def test_language_on_odd_rows(odd):
    rows = language.language_report(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in ROWS)
    for r in rows:
        assert 0 <= r.score <= 1 and r.lang_pred in ("en", "de", "und")
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert {r.lang_pred for r in rows if r.doc_id in (0, 1, 2)} == {"und"}


def test_language_accuracy_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_every_language_is_learned(spark):
    import random

    rng, rows = random.Random(4), []
    codes = sorted(language.FAMILY_OF)[:20] + [f"x{k:02}" for k in range(20)]
    for n, code in enumerate(codes):
        own = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(30)]
        rows += [(100 * n + k, " ".join(rng.choices(own, k=40)), code) for k in range(24 if n % 2 else 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, sample_rows=8 * len(codes))
    guessed = [(model.predict(t)[0], lang) for _, t, lang in rows]
    assert {g for g, _ in guessed} == set(codes)
    assert sum(g == lang for g, lang in guessed) / len(rows) > 0.95
    assert language.training_sample(docs, 400, 1).select("lang").distinct().count() == len(codes)


def test_licenses(odd, spark):
    got = {(r.doc_id, r.license): (r.score, r.n_passages) for r in licenses.find_licenses(odd).collect()}
    by_text = {t: i for i, t in ROWS}
    assert got[by_text["Released under the MIT License."], "MIT"] == (1.0, 1)
    assert got[by_text["intro\nLicensed under the Apache License, Version 2.0.\nend"], "Apache-2.0"][0] == 1.0
    assert len(got) == 2
    whole = "\n".join(licenses._MIT.replace(", ", ",\n").split("\n"))
    docs = spark.createDataFrame([(1, "Copyright 2020 X\n\n" + whole + "\n\nmore text follows here")], "doc_id long, text string")
    assert [(r.license, r.score) for r in licenses.find_licenses(docs).collect()] == [("MIT", 1.0)]


def test_licenses_inside_texts(spark):
    prose = " ".join(f"word{k} other{k}" for k in range(300))
    mit = licenses._MIT.replace("conditions: The", "conditions:\n\nThe").replace("Software. THE", "Software.\n\nTHE")
    words = licenses._APACHE.split(" ")
    wrapped = "\n".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9))
    changed = " ".join(w for k, w in enumerate(licenses._MPL.split(" ")) if k != 7)
    texts = {
        1: f"{prose}\n\n{mit}\n\n{prose}",
        2: "Released under the MIT License. Copyright 2020 Example Authors.",
        3: "The code in this repository is released under the MIT License.",
        4: f"def f():\n{wrapped}\n{prose}",
        5: f"{prose} Licensed under CC BY 4.0. {prose} licensed under CC BY 4.0 {prose}\nLicensed under CC BY 4.0.\n{prose}",
        6: f"{prose} {changed} {prose}",
        7: "under the under the under the mit the mit the mit license or mit license mit license",
        8: f"{prose} the license {prose}",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r.doc_id, r.license): (r.score, r.n_passages) for r in licenses.find_licenses(docs).collect()}
    assert got[1, "MIT"] == got[2, "MIT"] == got[3, "MIT"] == (1.0, 1)
    assert got[4, "Apache-2.0"] == (1.0, 1)
    assert got[5, "CC-BY-4.0"] == (1.0, 3)
    assert 0.9 < got[6, "MPL-2.0"][0] < 1 and got[6, "MPL-2.0"][1] == 1
    assert {i for i, _ in got} == {1, 2, 3, 4, 5, 6}


def test_empty_tables(none, spark):
    for run in (
        exact_dedup.mark_copies, exact_dedup.drop_copies, line_dedup.line_report, line_dedup.drop_lines, near_dedup.near_duplicates,
        near_dedup.drop_near_duplicates, mixing.mix_report, mixing.mix, language.language_report, licenses.find_licenses,
        lambda d: pieces.encoding_digests(d, PIECES),
    ):
        assert run(none).count() == 0
    path = work_path(spark, "tokens")
    token_files.write_tokens(none, path, tokenizer_path("word_bpe_49k.json"), 1)
    assert token_files.token_report(token_files.read_tokens(spark, path)).count() == 0


def test_pipeline_stages(spark, odd, none):
    for docs in (odd, none):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, "")
            if k < 4:
                assert docs.columns == odd.columns
        assert "ids" in docs.columns
        docs.count()


def test_pipeline_drops_unlearned_languages_and_noise(spark):
    import base64
    import random

    rng = random.Random(1)
    planted = [
        base64.b64encode(rng.randbytes(600)).decode(),
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(800)),
        "def f(x):\n    return [i for i in range(x) if i % 2 == 0]\nclass A(object):\n    def __init__(self, y): self.y = y\n" * 4,
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    ]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rows = [(10**9 + k, t, None) for k, t in enumerate(planted)]
    kept = corpus_pipeline.language_id(spark, docs.union(spark.createDataFrame(rows, docs.schema)), "")
    kept = {r.doc_id for r in kept.select("doc_id").collect()}
    assert not [i for i in kept if i >= 10**9]
    assert len(kept) >= 0.998 * docs.count()


def test_pipeline_against_plain_python(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, sf)
    first = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, sf).select("doc_id").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in first]
    best = {}
    for i, t in rows:
        best.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    alive = {min(g)[1] for g in best.values()}
    rows = [(i, t) for i, t in rows if i in alive]
    component = near_components(rows, 5)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, _ in rows if component[i] == i}
    assert len(first) >= docs.count() - 5


def test_neighbours_conflict_as_merging_says():
    made = pieces.MergeEncoder(PIECES)
    library = made.library
    import random

    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdeinrst ▁éß中x") for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    texts += ["a" * n for n in range(1, 40)] + [" " * n + "x" for n in range(8)] + ["ab" * 50, "\x00\x01", "🙂🙂 é🙂", "퟿"]
    for text in texts:
        assert made.encode(text) == [*library.encode(text), library.eos_id()], text


def test_ids_beside_the_other_columns(spark, odd):
    fields = odd.columns
    whole = pieces.with_ids(odd, PIECES, output="size")  # replaces a column
    assert whole.columns == [*[c for c in fields if c != "size"], "size"]
    assert "text" not in pieces.with_ids(odd, PIECES, keep_text=False).columns
    got = Counter((r["doc_id"], r["a.b"], tuple(r["size"])) for r in whole.collect())
    library = pieces.MergeEncoder(PIECES).library
    expected = Counter((r["doc_id"], r["a.b"], (*library.encode(r["text"] or ""), library.eos_id())) for r in odd.collect())
    assert got == expected


def test_tokenizers_that_cut_otherwise_are_seen():
    words = open(tokenizer_path("word_bpe_49k.json")).read()
    assert token_files.makes_known_runs(words)
    assert not token_files.makes_known_runs(open(tokenizer_path("byte_bpe_50k.json")).read())
    assert not token_files.makes_known_runs(words.replace('"Lowercase"', '"NFKC"'))


def test_files_of_another_tokenizer(spark, odd):
    from tokenizers import Tokenizer

    path, other = work_path(spark, "tokens"), tokenizer_path("byte_bpe_50k.json")
    token_files.write_tokens(odd, path, other, 1)
    tokenizer = Tokenizer.from_file(other)
    expected = Counter((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t in ROWS)
    assert Counter((r.doc_id, tuple(r.ids)) for r in token_files.read_tokens(spark, path).collect()) == expected


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_written_encodings_and_indexes(spark, tmp_path, encoding):
    import pyarrow.parquet as pq

    docs = spark.createDataFrame([(i, f"word {i} and " * 200) for i in range(3000)], "doc_id long, text string").repartition(4)
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, tokenizer_path("word_bpe_49k.json"), 1, encoding=encoding, page_rows=100, page_bytes=4096, row_group_bytes=100_000)
    for file in (tmp_path / "tokens").glob("*.parquet"):
        told = pq.ParquetFile(file).metadata
        for g in range(told.num_row_groups):
            for c in range(told.num_columns):
                column = told.row_group(g).column(c)
                assert column.has_offset_index and column.has_column_index
                if column.path_in_schema.startswith("ids"):
                    assert ("DELTA_BINARY_PACKED" in column.encodings) == (encoding == "delta")
                    assert ("RLE_DICTIONARY" in column.encodings) == (encoding == "dictionary")
                else:
                    assert "DELTA_BINARY_PACKED" in column.encodings


def test_selective_reads_touch_the_columns_and_rows_asked_for(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"word {i}") for i in range(3000)], "doc_id long, text string")
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, tokenizer_path("word_bpe_49k.json"), 1)
    some = token_files.read_tokens(spark, path).where("doc_id BETWEEN 100 AND 110")
    plan = some.select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert not any("ids:" in line for line in scans)  # ids are not read for lengths
    assert any("GreaterThanOrEqual(doc_id,100)" in line for line in scans)  # the range reaches the pages
    assert some.count() == 11
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:  # the ids are not shuffled to find their starts
        plan = token_files.read_tokens(spark, path)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_runs_are_those_of_the_tokenizer():
    import random

    from tokenizers import Tokenizer

    words = tokenizer_path("word_bpe_49k.json")
    table, library = token_files.RunTable(words), Tokenizer.from_file(words)
    rng = random.Random(10)
    parts = ["The", "and", "Éa", "ß", "naïve", "don't", "it's", "'", "''", ".", ",", "..", ".,", " ", "  ", "\n", "\t", "\r", "7", "42", "_", "-", "日本", "ﬁ", "İ", "é", "<|endoftext|>", "\x00", " "]
    plain = ["Word", "other", "éà", ",", ".", " ", "\n"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(0, 25))) for some in (parts, plain) for _ in range(2000)]
    for text, raw in zip(texts, table.encode_all(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_a_digest_of_two_texts_fails_the_job(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(10)], "doc_id long, text string").repartition(4)
    monkeypatch.setattr(exact_dedup, "_digest", lambda text: F.unhex(F.lit("00")))
    with pytest.raises(Exception, match="one digest for different texts"):
        exact_dedup.mark_copies(docs).collect()


@pytest.mark.parametrize(
    "text, name",
    [
        (licenses._BSD, "BSD-2-Clause"),
        ("Intro words.\n\n" + licenses._BSD_NAMES + "\n\nmore", "BSD-3-Clause"),
        ("# SPDX-License-Identifier: MIT\nimport os", "MIT"),
        ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
        ("This is free and unencumbered software released into the public domain.\nAnyone is free to copy", "Unlicense"),
        ("Distributed under the Boost Software License, Version 1.0. (See accompanying file)", "BSL-1.0"),
        ("all of it is licensed under GPLv3 since then", "GPL-3.0"),
        ("Mozilla Public License Version 2.0", "MPL-2.0"),
    ],
)
def test_more_licences(spark, text, name):
    found = licenses.find_licenses(spark.createDataFrame([(1, text), (2, "plain words of a text")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.license) for r in found] == [(1, name)]
