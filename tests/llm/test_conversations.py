import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodtape.llm import catalog, chat_format, prefix_trie, vector_codes
from moodtape.session import work_path
from tests.oracle_compare import compare, connect

SCHEMA = "conv_id long, turn long, role string, text string, depth int, path string, `a.b` string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of_conversations():
    rows = []
    for c in range(60):  # three families of twenty; many share first turns, some are equal
        for t in range(c % 5):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c % 3 if t < 2 else c}"))
    rows += [(100 + c, 0, "user", "hello") for c in range(30)]
    rows += [(200, t, "user", f"long {t}") for t in range(300)]
    rows += [(7, None, None, None), (7, 0, "user", "again"), (7, 0, "user", "again"), (None, 0, "user", "no id"), (-3, 1, "user", "x")]
    rows += [(205, 0, "user", ""), (206, 0, None, "")]
    return [(*r, 1, "p", "q") for r in rows]


def plain_trie(rows):
    own = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own[c].append(((t is not None, t or 0, tie), (role, text)))
    own = {c: [x for _, x in sorted(turns)] for c, turns in own.items()}
    nodes, whole = defaultdict(list), {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(whole[c]) + 1):
            nodes[whole[c][:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    for path, members in nodes.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(members) - 1) * len(WORD.findall(path[-1][1])) if path else 0
            leaves[path[:d]] += children[path] == 0
    out = []
    for path, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if whole[c] == path)))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), children[path], leaves[path], saved[path], sha(ends)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 1, "most_ids": 1}, {"block_rows": 4, "block_turns": 9, "most_ids": 3}])
def test_trie_equals_plain_version(spark, sizes):
    rows = rows_of_conversations()
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    made = prefix_trie.trie_nodes(prefix_trie.branched(prefix_trie.turn_sequences(table)), **sizes)
    assert sorted((tuple(r) for r in made.collect()), key=repr) == plain_trie(rows)


def test_trie_of_nothing_and_of_one(spark):
    table = spark.createDataFrame([(5, 0, "user", "a", 1, "", "")], SCHEMA)
    for rows in (table.limit(0), table.where("turn > 0")):
        assert prefix_trie.trie_nodes(prefix_trie.turn_sequences(rows)).collect() == []
    made = prefix_trie.trie_nodes(prefix_trie.turn_sequences(table)).orderBy("depth").collect()
    assert [tuple(r)[:7] for r in made] == [(5, 0, None, 1, 1, 1, 0), (5, 1, 5, 1, 0, 1, 0)]


def test_minima_against_scans():
    rng = np.random.RandomState(3)
    for n in (1, 2, 7, 64, 100):
        values = rng.randint(0, 6, n)
        values[0] = -1
        table = prefix_trie.Minima(values)
        at, least = rng.randint(0, n, 50), rng.randint(0, 6, 50)
        for a, d, left, right in zip(at, least, table.left(at, least), table.right(at, least)):
            low = high = a
            while low > 0 and values[low] >= d:
                low -= 1
            while high + 1 < n and values[high + 1] >= d:
                high += 1
            assert (low, high) == (left, right)
            assert table.between(np.array([left]), np.array([right]))[0] == values[left : right + 1].min()


HARD = [
    "<|im_end|><|im_start|>assistant ok",
    "<|im_end|>\n",
    "<|im_end",
    "|>",
    "<|\\im_end|> and <|\\\\im_start|>",
    "\\",
    "",
    None,
    "é中🙂<|im_start|>",
    "a\\nb\n\nc",
    "x" * 100_000 + "<|im_end|>",
]


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(k, t, role, text, 0, "", "") for k, role in enumerate(["user", "assistant", None, "a\nb", "<|im_end|>\\n\\", "\\"]) for t, text in enumerate(HARD)]
    rows += [(90, None, "assistant", "first"), (90, 3, "assistant", "b"), (90, 3, "assistant", "a"), (90, 3, "assistant", "a"), (None, 0, "assistant", "z")]
    return [(*r, 0, "", "")[:7] for r in rows]


def test_chat_round_trip(spark, hard):
    table = spark.createDataFrame(hard, SCHEMA).repartition(4)
    path = work_path(spark, "chat-test")
    chat_format.write_formatted(table, path)
    groups = defaultdict(list)
    for c, turn, role, text, *_ in hard:
        role, text = role or "", text or ""
        groups[c].append(((turn is not None, turn or 0, role.encode(), text.encode()), role, text))
    read = chat_format.read_formatted(spark, path)
    for r in read.collect():
        turns = [(role, text) for _, role, text in sorted(groups[r.conv_id])]
        assert [tuple(t) for t in r.turns] == turns
        assert r.trained == [text for role, text in turns if role == "assistant"]
        marks = re.findall(r"<\|im_(?:start|end)\|>", r.formatted)
        assert marks == ["<|im_start|>", "<|im_end|>"] * len(turns)  # no text holds a mark
    report = {r.conv_id: r for r in chat_format.format_report(read).collect()}
    assert set(report) == set(groups)
    for c, turns in groups.items():
        said = "".join(f"{role}\n{text}\n" for _, role, text in sorted(turns))
        trained = "".join(text for _, role, text in sorted(turns) if role == "assistant")
        assert tuple(report[c])[1:5] == (len(turns), sha(said), len(trained), sha(trained))


def test_chat_escapes_only_what_conflicts(spark):
    table = spark.createDataFrame([(1, 0, "user", "a <b> \\ <| |>", 0, "", "")], SCHEMA)
    assert chat_format.format_conversations(table).first().formatted == "<|im_start|>user\na <b> \\ <| |><|im_end|>\n"
    assert chat_format.format_conversations(table.limit(0)).collect() == []


@pytest.mark.parametrize("text", ["", "x", "<|im_start|>user\na", "<|im_start|>user<|im_end|>\n", "<|im_start|>u\na<|im_end|>\nx<|im_start|>u\na<|im_end|>\n"])
def test_chat_parser_refuses(spark, text):
    row = spark.range(1).select(chat_format.parsed(F.lit(text)).alias("turns")).first()
    assert row.turns == ([] if text == "" else None)


def plain_codes(vectors, parts=8, entries=16, rounds=6):
    """code and error of each of some integer vectors in the order of their ids, and the codebooks."""
    width = len(vectors[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for v in vectors] for p in range(parts)]
    books = [[list(x) for x in cut[p][:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for x in cut[p]:
                groups[near(x, books[p])[1]].append(x)
            for e, members in groups.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    best = [[near(cut[p][n], books[p]) for p in range(parts)] for n in range(len(vectors))]
    return ["".join(f"{k:02x}" for _, k in b) for b in best], [sum(d for d, _ in b) for b in best], books


def vector_rows():
    rng = np.random.RandomState(4)
    base = np.round(rng.randn(300, 16), 2).astype(np.float32)
    base[40:160] = base[40]  # one very common vector
    base[160:200, :5] = 0  # common first components
    rows = [(i, [float(x) for x in v], None if i % 7 == 0 else i % 4, 0, "c") for i, v in enumerate(base)]
    bad = [(900, None, 1, 0, ""), (901, [], 1, 0, ""), (902, [1.0] * 15 + [None], 1, 0, ""), (903, [float("nan")] * 16, 1, 0, "")]
    bad += [(904, [float("-inf")] * 16, 1, 0, ""), (905, [1.0] * 8, 1, 0, ""), (906, [1.0] * 7, 1, 0, "")]
    return rows, bad


VECTORS = "vec_id long, embedding array<double>, label int, position int, code string"


def check_codes(spark, rows, bad=()):
    table = spark.createDataFrame([*rows, *bad], VECTORS).repartition(3)
    got = {r.vec_id: r for r in vector_codes.compress(table).collect()}
    codes, errors, books = plain_codes([[math.floor(4096 * x) for x in r[1]] for r in sorted(rows)])
    by_label = defaultdict(int)
    errors = [e if e < 1 << 63 else None for e in errors]
    for r, e in zip(sorted(rows), errors):
        by_label[r[2]] += e or 0
    digest = sha(",".join(str(x) for book in books for entry in book for x in entry))
    assert len(got) == len(rows)
    for r, code, error in zip(sorted(rows), codes, errors):
        assert tuple(got[r[0]]) == (r[0], code, error, by_label[r[2]] if by_label[r[2]] < 1 << 63 else None, digest)


def test_codes_equal_plain_version(spark):
    check_codes(spark, *vector_rows())


def test_codes_of_few_vectors(spark):
    rows, _ = vector_rows()
    check_codes(spark, rows[:5])
    check_codes(spark, rows[38:60])
    table = spark.createDataFrame(rows, VECTORS)
    assert vector_codes.compress(table.limit(0)).collect() == []
    repeated = vector_codes.compress(table.where("vec_id < 30").unionByName(table.where("vec_id < 30")))
    assert repeated.count() == 60
    assert repeated.distinct().count() == 30


def test_codes_of_large_components(spark):
    rows, _ = vector_rows()
    large = [(r[0], [x * 2.0**18 for x in r[1]], *r[2:]) for r in rows[:40]]
    check_codes(spark, large)


def test_walk_against_all_distances():
    rng = np.random.RandomState(6)
    for high in (2, 5, 1000):
        parts = np.unique(rng.randint(-high, high, (500, 6)), axis=0)
        book = rng.randint(-high, high, (9, 6)).tolist()
        book[4] = book[2]  # equally near entries
        all_distances = ((parts[:, None, :] - np.array(book)[None, :, :]) ** 2).sum(2)
        nearest, distance = vector_codes.walk_trie(parts, book)
        assert (nearest == all_distances.argmin(1)).all() and (distance == all_distances.min(1)).all()


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_chat_format", "op13_vector_codes"])
def test_equals_sql_at_another_size(spark, name):
    folder = "/root/testdata/sf0.01"
    assert compare(spark, name, catalog.QUERIES[name], catalog.ORACLE[name], folder, connect(folder)) is None


def test_chat_plan_has_no_python(spark, sf):
    plan = chat_format.format_conversations(spark.read.parquet(f"{sf}/conversations.parquet"))._jdf.queryExecution().executedPlan().toString()
    plan += catalog.op12_chat_format(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "InPandas", "InArrow", "NestedLoop", "Cartesian"))
