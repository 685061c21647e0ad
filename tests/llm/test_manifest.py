"""The Merkle manifest against trees built by hand in memory."""

import hashlib
import zlib

import duckdb
import pytest

from hoptrail.llm import manifest, sql

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, tree string, place int"
RESULT = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(doc):
    fields = (doc[c] for c in ("doc_id", "source", "lang", "n_chars", "text"))
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path(tree, place):
    for nodes in tree[:-1]:
        low = place // 8 * 8
        yield nodes[low:place], nodes[place + 1 : low + 8]
        place //= 8


def by_hand(docs):
    groups = {}
    for doc in docs:
        groups.setdefault(doc["lang"], []).append(doc)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for name in names:
        groups[name].sort(key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, leaf(d)))
    trees = {name: levels([leaf(d) for d in groups[name]]) for name in names}
    top = levels([trees[name][-1][0] for name in names])
    for i, name in enumerate(names):
        for place, doc in enumerate(groups[name]):
            proof = [*path(trees[name], place), *path(top, i)]
            bad = dict(doc)
            if doc["doc_id"] is not None and zlib.crc32(str(doc["doc_id"]).encode()) % 3 == 0 and doc["text"]:
                bad["text"] = doc["text"].translate(LOWER)
            folded = leaf(bad)
            for left, right in proof:
                folded = digest(*left, folded, *right)
            root = top[-1][0]
            beside = digest(*(x for left, right in proof for x in (*left, *right)))
            yield doc["doc_id"], leaf(doc), trees[name][-1][0], root, beside, folded, folded == root


def found(df):
    return sorted((tuple(r[c] for c in RESULT) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    """Groups of many sizes; null groups, keys and texts; repeated keys and rows; a long text."""
    rows = [(i, "s", f"l{i % 11}", i, f"Text {i}") for i in range(90)]
    rows += [(1000 + i, None, "big", 3, "Ä same Text") for i in range(513)]
    rows += [(7, "s", "big", 1, "Copy")] * 70 + [(8, "s", "big", 1, f"Other {i}") for i in range(20)]
    rows += [(None, None, None, None, None)] * 3 + [(1, "s", None, 0, ""), (2, "s", "", None, "A"), (3, "s", "=", 1, "A" * 300_000)]
    return spark.createDataFrame([(*r, "x", "y", 5) for r in rows], SCHEMA).cache()


@pytest.mark.parametrize("run", [1000, 64, 5])
def test_audit_equals_trees_built_by_hand(docs, run):
    expected = sorted(by_hand([r.asDict() for r in docs.collect()]), key=str)
    got = manifest.audit(docs, run=run)
    assert found(got) == expected
    assert not all(r.verified for r in got.collect())


def test_one_row_and_none(docs):
    one = docs.filter("doc_id = 1000")
    assert found(manifest.audit(one)) == list(by_hand([one.first().asDict()]))
    assert manifest.audit(docs.filter("false")).collect() == []


def test_sql_says_the_same(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    connection = duckdb.connect()
    connection.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    result = connection.sql(sql.manifest())
    rows = [dict(zip(result.columns, row)) for row in result.fetchall()]
    assert found(manifest.audit(docs, run=17)) == sorted((tuple(r[c] for c in RESULT) for r in rows), key=str)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 517])
def test_missing_nodes_are_few_and_enough(n):
    leaves = [digest(str(i)) for i in range(n)]
    tree = levels(leaves)
    for first, last in {(0, n), (0, 1), (n - 1, n), (n // 3, n // 3 + n // 2 + 1), (n // 2, n // 2 + 1)}:
        last = min(last, n)
        asked = manifest.missing(range(first, last), n)
        assert sorted(asked) == sorted(manifest.edges(first, last - first, n))
        assert len(asked) <= 2 * (manifest.FAN - 1) * len(tree)
        known = {(level, place): tree[level][place] for level, place in asked}
        run = manifest.Octopus(first, leaves[first:last], n, known)
        assert run.root == tree[-1][0]
        for place in range(first, last):
            assert run.proof(place) == list(path(tree, place))
            assert manifest.fold(leaves[place], run.proof(place)) == tree[-1][0]


def test_whole_nodes_cover_a_run_once():
    n = 600
    tree = levels([digest(str(i)) for i in range(n)])
    for first, last in ((0, n), (3, 4), (5, 599), (64, 128), (7, 600)):
        covered = []
        for level, place, node in manifest.whole_nodes(first, tree[0][first:last], n):
            assert node == tree[level][place]
            covered += range(place * 8**level, min(n, (place + 1) * 8**level))
        assert sorted(covered) == list(range(first, last))


def test_proofs_of_any_forest(spark):
    leaves = spark.createDataFrame([("t", i, digest(str(i))) for i in range(100)], "tree string, key int, leaf string")
    rows = manifest.prove(manifest.plant(leaves, run=9)).collect()
    root = levels([digest(str(i)) for i in range(100)])[-1][0]
    assert len(rows) == 100
    for row in rows:
        assert row.root == root == manifest.fold(row.leaf, [(x.left, x.right) for x in row.proof])
