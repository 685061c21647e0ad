"""The conversation trie against one built in memory, and its SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest

from hoptrail.llm import conversation_trie as ct
from hoptrail.llm import sql

SCHEMA = "conv_id long, turn long, role string, text string, path string, shard int, depth int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def mark(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def in_memory(rows, family=True):
    turns = {}
    for r in rows:
        if r.conv_id is not None:
            role, text = r.role or "", r.text or ""
            turns.setdefault(r.conv_id, []).append(((r.turn is not None, r.turn or 0), role, mark(role, text), text))
    turns = {c: [(x[1], x[3]) for x in sorted(t)] for c, t in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6 if family else 0
        rebuilt[c] = turns.get(c - c % 100, [])[:h] + own[h:]
    members, ends = {}, {}
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
        ends.setdefault(tuple(path), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[: len(node)] == node]
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, [])),
            sum(x not in children for x in below),
            sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x),
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def turns(spark):
    """Many shared beginnings and copies; null ids, turns, roles and texts; ties, repeats, a long one."""
    rng = random.Random(3)
    rows = []
    for c in range(260):
        rows += [(c, t, "user" if t % 2 else "assistant", rng.choice(["a", "Bé", "\U0001f600"])) for t in range(rng.randint(1, 7))]
    rows += [(1000 + c, t, "user", f"copy {t}") for c in range(90) for t in range(3)]
    rows += [(2000, t, "user", "again") for t in range(400)] + [(2001, 0, "user", "y" * 200_000)]
    rows += [(None, 0, "user", "x"), (300, None, None, None), (300, 0, None, "t"), (300, 0, "a", "t"), (300, 0, "a", "t")]
    rows += [(100 * c + 407, None, "r", "alone") for c in range(9)]
    rng.shuffle(rows)
    return spark.createDataFrame([(*r, "p", 1, 2) for r in rows], SCHEMA).cache()


@pytest.mark.parametrize(("shard", "skeleton"), [(1000, 1 << 20), (40, 1 << 20), (3, 1 << 20), (3, 60), (3, 1)])
def test_nodes_equal_those_in_memory(turns, shard, skeleton):
    own = ct.conversations(turns)
    trie = ct.Trie(ct.rebuilt(own), shard, skeleton)
    assert len(list(trie.skeleton.nodes())) <= skeleton
    assert found(trie.nodes()) == in_memory(turns.collect())


def test_copies_of_one_path_are_split(turns):
    copies = ct.conversations(turns.filter("conv_id BETWEEN 1000 AND 1089"))
    trie = ct.Trie(copies, 10)
    assert trie.paths.select("shard").distinct().count() > 4
    assert found(trie.nodes()) == in_memory(turns.filter("conv_id BETWEEN 1000 AND 1089").collect(), family=False)


def test_turnless_conversations_and_no_rows(spark, turns):
    few = spark.createDataFrame([(407, 0, "r", "t"), (507, 0, "r", "t")], SCHEMA[: SCHEMA.index(", path")])
    assert found(ct.Trie(ct.rebuilt(ct.conversations(few))).nodes()) == in_memory(few.collect())
    assert ct.Trie(ct.rebuilt(ct.conversations(turns.filter("false")))).nodes().collect() == []


def test_sql_says_the_same(spark, turns):
    connection = duckdb.connect()
    connection.register("conversations", turns.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    rows = connection.sql(f"SELECT {', '.join(COLUMNS)} FROM ({sql.conversation_trie()})").fetchall()
    assert sorted(rows, key=str) == in_memory(turns.collect())


def test_skeleton_names_each_prefix_once():
    m = lambda text: "".join(mark("", x) for x in text)
    paths = sorted(map(m, ("abc", "abd", "abd", "ab", "x", "xyzzy", "abde")))
    skeleton = ct.Skeleton(paths)
    expected = {p[: ct.DIGITS * d] for p in paths for d in range(len(p) // ct.DIGITS + 1)}
    nodes = list(skeleton.nodes())
    assert {paths[i][: ct.DIGITS * d] for i, d in nodes} == expected
    assert len(nodes) == len(expected)
    for i, path in enumerate(paths):
        for d in range(len(path) // ct.DIGITS + 1):
            owner = skeleton.name(i, d)[0]
            assert paths[owner][: ct.DIGITS * d] == path[: ct.DIGITS * d]
            assert (owner, d) in nodes
