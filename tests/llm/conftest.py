import random

import pytest

BLANKS = " \t\n\x0b\x0c\r"


def words(rng, n):
    return [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()) for _ in range(n)]


def make_rows():
    """doc_id, text, lang, source and columns whose names clash with those the operators use inside."""
    rng = random.Random(5)
    base = words(rng, 120)
    texts = [None, "", " \n\t ", "one", "two words", "İstanbul ÉCOLE naïve", " ".join(base), " ".join(base).upper(), "  ".join(base)]
    for k in range(12):  # near copies, a chain in which not every two link
        edited = list(base)
        for j in range(k):
            edited[5 * j + 3] = f"edit{j}"
        texts.append(" ".join(edited))
    texts += ["a common line of some length\n" + " ".join(words(rng, 30)) for _ in range(6)]
    texts += ["  A COMMON line of some length \nrest", "x" * 200_000, " ".join(words(rng, 60_000))]
    texts += ["Released under the MIT License.", "intro\nLicensed under the Apache License, Version 2.0.\nend"]
    rows = [(k, t, ("en", "de", None)[k % 3], (None, "s1", "s2", "é")[k % 4]) for k, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, "no id at all here", "en", "s1"), (None, None, None, None), (7, "another text for seven", "de", "s1")]
    return [(*r, "x", 1, 2.0, "y") for r in rows]


SCHEMA = "doc_id long, text string, lang string, source string, digest string, size int, target double, `a.b` string"


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(make_rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)
