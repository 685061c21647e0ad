"""Large families of near copies against all pairs."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hoptrail.llm import common, near_dedup


def family(n, changes, seed, words=60):
    """Texts of one template: most with few words changed, some so far off that only others link them."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.choice(changes)):
            text[rng.randrange(words)] = f"x{rng.randrange(40)}"
        out.append((i, " ".join(text)))
    return out


def by_all_pairs(rows, width):
    sets = [{tuple(t.split()[i : i + width]) for i in range(len(t.split()) - width + 1)} for _, t in rows]
    names = {s: i for i, s in enumerate(set().union(*sets))}
    x = np.zeros((len(rows), len(names)), np.float32)
    for i, s in enumerate(sets):
        x[i, [names[v] for v in s]] = 1
    both, size = x @ x.T, x.sum(1)
    linked = both * 100 >= (size[:, None] + size[None] - both) * 80
    label = np.arange(len(rows))
    while True:
        least = np.where(linked, label[None], len(rows)).min(1)
        if (least == label).all():
            return {key: int(label[i]) for i, (key, _) in enumerate(rows)}
        label = least


@pytest.mark.parametrize(("n", "block"), [(3000, 512), (400, 16)])
def test_a_large_family(spark, monkeypatch, n, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = family(n, [0, 1, 1, 2, 2, 3, 5, 9], 3) + [(n + i, t.replace("w1 ", "y ")) for i, t in family(40, [4, 6, 8], 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc: r.component_id for r in near_dedup.NearCopies(docs, width=2).groups().collect()}
    expected = by_all_pairs(rows, 2)
    assert got == expected
    assert len(set(expected.values())) > 20


def test_materialize_leaves_no_shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = files.getAllFiles()
        return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}

    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before, setting = shuffled(), spark.conf.get(common.SHUFFLE_CLEANUP)
    table = common.materialize(df)
    assert shuffled() <= before
    assert spark.conf.get(common.SHUFFLE_CLEANUP) == setting
    assert table.count() == 7 and df.count() == 7


def test_many_texts_are_hashed_a_part_at_a_time():
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(n)) for n in [9000] * 300 + [0, 1, 400_000]]
    texts = [*texts[:50], None, *texts[50:]]
    held = pa.array(texts)
    tracemalloc.start()
    got = [n for _, values in near_dedup._scan(held, 5) for n in (len(values), int(values.sum()))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole = near_dedup.shingle_sets([t and t.encode() for t in texts], 5)
    assert got == [n for values in whole for n in (len(values), int(values.sum()))]
    assert peak < 200e6


def test_only_texts_that_are_asked_for_are_shuffled(spark, monkeypatch, tmp_path):
    rng = random.Random(5)
    texts = [" ".join(f"{rng.getrandbits(64):x}" for _ in range(4000)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(60, texts[0] + " more"), (None, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    sizes, written = {}, iter(range(1000))

    def shuffled():
        found = files.getAllFiles()
        for i in range(found.size()):
            if (file := found.apply(i)).getName().startswith("shuffle_"):
                sizes[file.getName()] = file.length()
        return set(sizes)

    def kept_files(df):
        path = str(tmp_path / f"table{next(written)}")
        df.write.parquet(path)
        shuffled()
        return spark.read.schema(df.schema).parquet(path)

    monkeypatch.setattr(near_dedup, "materialize", kept_files)
    monkeypatch.setattr(near_dedup, "discard", lambda *tables: None)
    before, threshold = shuffled(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = kept_files(near_dedup.keep_one(docs, width=2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(60))
    assert {r.text for r in kept.collect()} == set(texts)
    # Sets of the three near copies and the one they share, their texts, and small rows; not the 58 other texts.
    assert sum(sizes[name] for name in shuffled() - before) < sum(map(len, texts)) / 2


def test_marks_of_any_size_give_the_same_rows(spark, monkeypatch):
    rows = family(200, [0, 1, 1, 2, 5, 9], 6) + [(None, "a b c"), (None, "a b c"), (None, None), (7, "another text of seven")]
    docs = spark.createDataFrame(rows, "`a.key` long, bits string")

    def kept():
        return sorted(map(tuple, near_dedup.keep_one(docs, "a.key", "bits", width=2).collect()), key=repr)

    expected = kept()
    monkeypatch.setattr(near_dedup, "MARK_BITS", 64)
    assert kept() == expected
    assert 1 < len(expected) < len(rows)
    found = near_dedup.marked(docs.withColumnRenamed("a.key", "k"), "k", near_dedup.marks(docs.select(F.col("`a.key`").alias("k")).filter("k IS NULL OR k < 9"), "k"))
    assert found.filter("NOT hoptrail_marked AND (k IS NULL OR k < 9)").isEmpty()
