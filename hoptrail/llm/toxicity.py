"""Severity of toxic texts by cumulative-link ordinal regression.

With features x and grades 0..G, P(grade <= g) = logistic(threshold_g - w.x): the grades share
the weights w and differ in their ordered thresholds. Features are the presence of words and of
their first letters (three to six), hashed; those that toxic texts have much more often are
kept, so that a text without any, however short, is harmless. The result is the expected grade.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail.llm.common import materialize

WORD = re.compile(r"[^\W\d_]+")
#: Features kept, and how many labelled texts must have one.
FEATURES, LEAST_TEXTS = 4096, 5
#: How many times more often toxic texts must have a feature.
RATIO = 4
#: Words whose features a worker remembers before it starts anew.
REMEMBERED = 500_000
#: Weight above 0 from which a word counts as toxic.
TERM = 1.0
RESULTS = ("severity", "p_toxic", "n_terms")


def features(word: str) -> list[int]:
    """Hashes of a lower-case word and of its beginnings."""
    parts = [f"={word}", *(f"^{word[:n]}" for n in range(3, min(len(word), 6) + 1))]
    return [xxhash.xxh3_64_intdigest(p) - (1 << 63) for p in parts]


def words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


@dataclass
class Model:
    """Weight of each feature; ordered thresholds, one less than there are grades."""

    weights: dict[int, float]
    thresholds: np.ndarray
    grades: np.ndarray

    def at_least(self, score: float) -> np.ndarray:
        """P(grade > grades[g]) for each threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -30, 30)))


def graded(labelled: DataFrame, text: str = "text", toxic: str = "toxic", steps: tuple[int, ...] = (2, 4), **options) -> DataFrame:
    """`labelled` with a `grade`, where labels only say toxic (1) or not (0).

    A first fit of the label tells toxic words. A text that isn't toxic has grade 0, a toxic one 1
    and 1 more for each of `steps` that the number of its different toxic words reaches. The
    result is written, so that the texts are judged once however often it is read.
    """
    first = fit(labelled, text, toxic, **options)
    found = score(labelled, first, text)
    reached = sum(((F.col("n_terms") >= s).cast("int") for s in steps), F.lit(1))
    label = F.col(f"`{toxic}`")
    grade = F.when(label == 1, reached).when(label == 0, F.lit(0))
    return materialize(found.withColumn("grade", grade).drop(*RESULTS))


def _sampled(labelled: DataFrame, sample: int) -> DataFrame:
    """At most about `sample` rows, picked by a hash of the text."""
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return labelled.filter(place < min(1.0, sample / max(1, labelled.count())))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", sample: int = 20_000
) -> DataFrame:
    """Labels with their documents, at most about `sample` of them, picked by a hash of the key.

    The sampled labels are broadcast, as their number is bounded, and what is joined is written.
    Columns of the documents that the labels have too are those of the labels.
    """
    place = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    picked = labels.filter(place < min(1.0, sample / max(1, labels.count())))
    clashing = [F.col(f"`{c}`") for c in docs.columns if c != key and c in labels.columns]
    return materialize(docs.drop(*clashing).join(F.broadcast(picked), key))


def fit(labelled: DataFrame, text: str = "text", grade: str = "grade", sample: int = 20_000) -> Model:
    """Fit on a bounded sample of rows with a text and a grade (0 for harmless).

    Features are counted by Spark; the kept ones of the sampled texts, a few numbers each, are
    fitted where the query is made. Without two grades all texts get the only grade there is,
    or 0.
    """
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{grade}`").alias("grade"))
    rows = _sampled(rows.filter(F.col("text").isNotNull() & F.col("grade").isNotNull()), sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, list[int]] = {}
            for value, g in zip(batch.column("text").to_pylist(), batch.column("grade").to_pylist(), strict=True):
                for f in {f for w in words(value) for f in features(w)}:
                    seen.setdefault(f, [0, 0])[g > 0] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.int64()), *(pa.array([c[i] for c in seen.values()], pa.int64()) for i in (0, 1))],
                ["feature", "clean", "toxic"],
            )

    sizes = {r["t"]: r["count"] for r in rows.groupBy((F.col("grade") > 0).alias("t")).count().collect()}
    clean, toxic = sizes.get(False, 0), sizes.get(True, 0)
    if not clean or not toxic:
        only = rows.agg(F.min("grade")).first()[0]
        return Model({}, np.empty(0), np.array([only or 0]))
    counted = rows.mapInArrow(count, "feature long, clean long, toxic long").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    ratio = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    strength = ratio * F.sqrt(F.col("clean") + F.col("toxic"))
    chosen = (
        counted.filter((F.col("clean") + F.col("toxic") >= LEAST_TEXTS) & (ratio > np.log(RATIO)))
        .orderBy(strength.desc(), "feature")
        .limit(FEATURES)
        .select("feature")
        .collect()
    )
    index = {r["feature"]: i for i, r in enumerate(chosen)}
    shared = labelled.sparkSession.sparkContext.broadcast(index)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                sorted({shared.value[f] for w in words(t) for f in features(w) if f in shared.value})
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), batch.column("grade").cast(pa.int32())], ["x", "grade"]
            )

    data = rows.mapInArrow(sparse, "x array<int>, grade int").toArrow()
    x, y = data.column("x").to_pylist(), data.column("grade").to_numpy()
    weights, thresholds, grades = _cumulative_link(x, y, len(index))
    return Model({f: float(weights[i]) for f, i in index.items() if abs(weights[i]) > 1e-6}, thresholds, grades)


def _cumulative_link(x: list[list[int]], y: np.ndarray, size: int, rounds: int = 400, decay: float = 2e-3):
    """Weights, thresholds and grades by full-batch Adam."""
    grades, level = np.unique(y, return_inverse=True)
    row = np.repeat(np.arange(len(x)), [len(r) for r in x])
    column = np.array([i for r in x for i in r], np.int64)
    weight = 1 / len(y)
    k = len(grades) - 1
    parameters = np.concatenate((np.zeros(size), [-0.5], np.zeros(k - 1)))
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, rounds + 1):
        w, steps = parameters[:size], parameters[size:]
        # Thresholds grow by exp(step), which keeps them in order.
        thresholds = steps[0] + np.concatenate(([0], np.cumsum(np.exp(steps[1:]))))
        score = np.bincount(row, w[column], len(x))
        upper = np.where(level < k, sigmoid(thresholds[np.minimum(level, k - 1)] - score), 1.0)
        lower = np.where(level > 0, sigmoid(thresholds[np.maximum(level - 1, 0)] - score), 0.0)
        share = np.maximum(upper - lower, 1e-9)
        d_upper, d_lower = upper * (1 - upper) / share * weight, lower * (1 - lower) / share * weight
        g_score = d_upper - d_lower
        g_threshold = np.bincount(np.maximum(level - 1, 0), d_lower, k) - np.bincount(np.minimum(level, k - 1), d_upper * (level < k), k)
        g_w = np.bincount(column, g_score[row], size) + decay * w / max(1, size) ** 0.5
        later = np.cumsum(g_threshold[::-1])[::-1]
        g_steps = np.concatenate(([later[0]], later[1:] * np.exp(steps[1:])))
        gradient = np.concatenate((g_w, g_steps))
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        parameters = parameters - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    steps = parameters[size:]
    return parameters[:size], steps[0] + np.concatenate(([0], np.cumsum(np.exp(steps[1:])))), grades


_WORKERS: dict[str, tuple[Model, dict[str, float]]] = {}


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`df` with severity (expected grade), p_toxic (chance of any grade above 0) and n_terms
    (different words of a weight of `TERM` or more).

    Null and empty texts have no features and get what the thresholds alone give. Each word of a
    text counts once, wherever it stands; whole texts are read. Equal rows get equal results;
    columns of the three names are replaced.
    """
    shared, key = df.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    @F.arrow_udf("severity double, p_toxic double, n_terms int")
    def judge(texts: pa.Array) -> pa.Array:
        if key not in _WORKERS:
            _WORKERS.clear()
            _WORKERS[key] = shared.value, {}
        model, known = _WORKERS[key]
        severity, p_toxic, n_terms = [], [], []
        for text in texts.to_pylist():
            if len(known) > REMEMBERED:
                known.clear()
            # Features of a text count once, so a weight is summed over distinct features.
            found: set[int] = set()
            terms = 0
            for word in words(text):
                if (mine := known.get(word)) is None:
                    mine = known[word] = tuple(f for f in features(word) if f in model.weights)
                if mine:
                    found.update(mine)
                    terms += sum(map(model.weights.__getitem__, mine)) >= TERM
            n_terms.append(terms)
            above = model.at_least(sum(model.weights[f] for f in sorted(found)))
            severity.append(float(model.grades[0] + (np.diff(model.grades) * above).sum()))
            p_toxic.append(float(above[0]) if len(above) else float(model.grades[0] > 0))
        columns = pa.array(severity, pa.float64()), pa.array(p_toxic, pa.float64()), pa.array(n_terms, pa.int32())
        return pa.StructArray.from_arrays(columns, list(RESULTS))

    found = df.withColumn("hoptrail_toxicity", judge(F.col(f"`{text}`")))
    return found.withColumns({c: F.col("hoptrail_toxicity")[c] for c in RESULTS}).drop("hoptrail_toxicity")
