"""Boosted trees and document statistics against plain versions, and held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hoptrail.llm import boosting, quality

SCHEMA = "doc_id long, text string, score string, label string, key int, predicted string"


def walked(forest, row):
    """One row down one tree after the other."""
    total = forest.base
    for i in forest.roots:
        while forest.below[i] != i:
            i = forest.below[i] + (row[forest.column[i]] > forest.cut[i])
        total += forest.value[i]
    return 1 / (1 + math.exp(-total))


def test_arrays_walk_like_trees():
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(500, 4)), 1)
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(float)
    forest = boosting.fit(x[:400], y[:400], trees=30, height=3)
    assert len(forest.roots) == 30
    p = forest.predict(x)
    assert p == pytest.approx([walked(forest, row) for row in x])
    assert ((p[400:] >= 0.5) == y[400:]).mean() > 0.9


def test_best_split_equals_that_of_trying_all():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 6, (60, 3)).astype(float), rng.integers(0, 2, 60).astype(float)
    forest = boosting.fit(x, y, trees=1, height=1, rate=1.0, least=1.0)
    share = y.mean()
    g, h = share - y, np.full(60, share * (1 - share))
    tried = []
    for column in range(3):
        for cut in sorted(set(x[:, column]))[:-1]:
            left = x[:, column] <= cut
            if min(h[left].sum(), h[~left].sum()) >= 1:
                gain = sum(g[side].sum() ** 2 / (h[side].sum() + 1) for side in (left, ~left))
                tried.append((gain, column, cut))
    gain, column, cut = max(tried, key=lambda t: t[0])
    assert forest.column[0] == column
    assert cut < forest.cut[0] < cut + 1
    left = x[:, column] <= cut
    steps = [-g[side].sum() / (h[side].sum() + 1) for side in (left, ~left)]
    assert forest.value[1:] == pytest.approx(steps)


def test_forest_without_anything_to_learn():
    for y, expected in (([], 0.5), ([1, 1], 0.999), ([0], 0.001)):
        forest = boosting.fit(np.zeros((len(y), 2)), np.array(y, float))
        assert forest.predict(np.zeros((3, 2))) == pytest.approx([expected] * 3)
    same = boosting.fit(np.zeros((10, 2)), np.array([0, 1] * 5, float))
    assert same.predict(np.zeros((1, 2))) == pytest.approx([0.5])
    assert same.predict(np.zeros((0, 2))).shape == (0,)


def plain(text):
    """The statistics, one by one."""
    words = text.split()
    if not words:
        return dict.fromkeys(quality.STATISTICS, 0.0)
    n, chars = len(words), len(text)
    low, lines = Counter(w.lower() for w in words), [x for x in text.split("\n") if x.strip()]
    lengths, pairs = [len(w) for w in words], list(zip([w.lower() for w in words], [w.lower() for w in words][1:]))
    share = lambda found: sum(found) / n
    out = {
        "log_words": math.log1p(n), "log_chars": math.log1p(chars), "log_lines": math.log1p(len(lines)),
        "word_length": share(lengths), "word_spread": (share(x * x for x in lengths) - share(lengths) ** 2) ** 0.5,
        "short_words": share(x <= 2 for x in lengths), "long_words": share(x > 15 for x in lengths),
        "distinct_words": len(low) / n, "distinct_rate": math.log(len(low)) / math.log(n) if n > 1 else 1,
        "commonest_word": max(low.values()) / n, "distinct_pairs": len(set(pairs)) / (n - 1) if n > 1 else 1,
        "marked_words": share(not (w[0].isalnum() and w[-1].isalnum()) for w in words),
        "capital_words": share(w.istitle() for w in words), "upper_words": share(w.isupper() for w in words),
        "words_a_line": n / len(lines), "distinct_lines": len(set(lines)) / len(lines),
        "stopped_lines": sum(x.strip()[-1] in ".!?" for x in lines) / len(lines),
        "short_lines": sum(len(x) < 30 for x in lines) / len(lines),
        "beyond_ascii": sum(ord(c) > 127 for c in text) / chars,
        "control": sum(c < " " and c not in "\t\r\n" or c == "\x7f" for c in text) / chars,
    }
    return out | {k: sum(c in v.decode() for c in text) / chars for k, v in quality._CLASSES.items()}


def test_statistics_equal_plain_ones():
    rng = random.Random(4)
    texts = ["", " \n ", "a", "One two.\nONE two!", "\x0b\x7fé #1 ☃\U0001f600 x", "word " * 3000]
    texts += ["".join(rng.choice("ab CÄé.\n!|5\t☃") for _ in range(rng.randint(1, 400))) for _ in range(60)]
    for text in texts:
        assert dict(zip(quality.STATISTICS, quality.statistics(text))) == pytest.approx(plain(text), abs=1e-6)
    assert quality.statistics(None) == quality.statistics("")


def test_words_of_long_texts_come_in_blocks():
    text = " ".join(f"w{i}" for i in range(5000)) + "  " + "x" * 300
    assert sum(quality.word_lists(text, 64), []) == text.split()
    assert max(map(len, quality.word_lists(text, 64))) < 40


def test_held_out_quality_and_odd_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    learnt = docs.filter(~quality.held_out(F.col("doc_id")))
    forest = quality.fit(learnt, labels)
    judged = quality.judge(docs, forest).join(labels, "doc_id").filter(quality.held_out(F.col("doc_id"))).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in judged)
    good, bad = ([r.score for r in judged if r.quality == k] for k in (1, 0))
    assert sum(a > b for a in good for b in bad) > 0.97 * len(good) * len(bad)
    assert sum(r.predicted for r in judged if r.quality == 1) == len(good)

    same = quality.fit(learnt.repartition(7), labels.repartition(3))
    for name in ("column", "cut", "below", "value"):
        assert (getattr(same, name) == getattr(forest, name)).all()

    odd = [(1, None), (None, ""), (3, "\n"), (4, "word " * 100_000), (5, "Same."), (5, "Same."), (6, "x" * 400_000), (7, "\x00☃")]
    rows = spark.createDataFrame([(*r, "s", "l", 1, "p") for r in odd], SCHEMA)
    got = quality.judge(rows, forest)
    assert sorted(got.columns) == sorted(rows.columns)
    found = got.collect()
    assert len(found) == len(odd)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert len({r.score for r in found if r.doc_id == 5}) == 1
    assert quality.judge(rows.filter("false"), forest).collect() == []
    plan = got.filter("predicted = 1")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, quality int")
    for found in (labels, labels.filter("false"), spark.createDataFrame([(9, 1)], labels.schema)):
        assert [r.score for r in quality.score(docs, quality.fit(docs, found)).collect()] == [0.5, 0.5]
    both = spark.createDataFrame([(1, 1), (1, 0), (1, 0), (1, 1)], labels.schema)
    assert quality.score(docs, quality.fit(docs, both)).first().score == pytest.approx(0.5)
