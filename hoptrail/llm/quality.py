"""Quality of documents: histogram gradient-boosted trees over statistics of their texts.

The statistics are counts and shares of bytes, words and lines, for any language. The trees are
fitted on a bounded sample of labelled documents; every whole text is scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail.llm import boosting

#: From this score on a document is predicted to be of label 1.
LEAST_SCORE = 0.3
#: Every how many documents (by crc32 of the key) are kept from learning.
FOLDS = 5
#: Labelled documents that the trees are fitted on, at most about.
SAMPLE = 20_000
#: Characters whose words are listed at a time.
BLOCK = 1 << 20

_SPACE = re.compile(r"\s")
_CLASSES = {
    "digits": b"0123456789",
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "stops": b".?",
    "shouts": b"!",
    "commas": b",;:",
    "quotes": b"\"'()",
    "dashes": b"-_",
    "pipes": b"|",
    "marks": b"#$%&*+/<=>@[\\]^`{}~",
    "spaces": b" \t\r",
    "breaks": b"\n",
}
_CLASS_OF = np.zeros((256, len(_CLASSES) + 2))
for _i, _members in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_members), _i] = 1
_CLASS_OF[0xC2:, -2] = 1  # first bytes of characters beyond ASCII
_CLASS_OF[[*range(9), 11, 12, *range(14, 32), 127], -1] = 1

STATISTICS = (
    "log_words", "log_chars", "log_lines", "word_length", "word_spread", "short_words", "long_words",
    "distinct_words", "distinct_rate", "commonest_word", "distinct_pairs", "marked_words", "capital_words", "upper_words",
    "words_a_line", "distinct_lines", "stopped_lines", "short_lines",
    *_CLASSES, "beyond_ascii", "control",
)


def word_lists(text: str, block: int = BLOCK) -> Iterator[list[str]]:
    """The words of a text, of about `block` characters at a time."""
    start = 0
    while start < len(text):
        cut = _SPACE.search(text, start + block)
        end = cut.start() if cut else len(text)
        yield text[start:end].split()
        start = end


def statistics(text: str | None) -> list[float]:
    """The values of STATISTICS; all 0 for a null text and one without words."""
    text = text or ""
    marks, lengths, flags = [], [], np.zeros(3)
    for words in word_lists(text):
        if not words:
            continue
        marks.append(np.fromiter(map(hash, map(str.lower, words)), np.int64, len(words)))
        lengths.append(np.fromiter(map(len, words), np.int64, len(words)))
        flags += [
            sum(not (w[0].isalnum() and w[-1].isalnum()) for w in words),
            sum(map(str.istitle, words)),
            sum(map(str.isupper, words)),
        ]
    if not marks:
        return [0.0] * len(STATISTICS)
    mark, length = np.concatenate(marks), np.concatenate(lengths)
    n = len(mark)
    _, times = np.unique(mark, return_counts=True)
    pairs = mark[:-1] * np.int64(0x9E3779B97F4A7C15 - (1 << 64)) + mark[1:]
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    chars = len(text)
    classes = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256) @ _CLASS_OF
    return [
        np.log1p(n), np.log1p(chars), np.log1p(len(lines)),
        length.mean(), length.std(), (length <= 2).mean(), (length > 15).mean(),
        len(times) / n, np.log(len(times)) / np.log(n) if n > 1 else 1.0, times.max() / n,
        len(np.unique(pairs)) / (n - 1) if n > 1 else 1.0,
        *(flags / n),
        n / len(lines), len(set(lines)) / len(lines),
        sum(line.rstrip()[-1] in ".!?" for line in lines) / len(lines), sum(len(line) < 30 for line in lines) / len(lines),
        *(classes / chars),
    ]


def matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(len(texts), len(STATISTICS))


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: 5 divides crc32 of its key as text. No null key is."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
    **options,
) -> boosting.Forest:
    """Fit on the documents of at most about `sample` labels, picked by a hash of their key.

    Only labels 0 and 1 count, and rows with a key; a document with several labels is learnt
    from with each. The sampled labels are broadcast, as `sample` bounds them, and the statistics of
    their texts, a few numbers each, are fitted where the query is made. Without two different
    labels every text gets the share of label 1 there is, or 0.5.
    """
    said = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"))
    said = said.filter(F.col("label").isin(0, 1) & F.col("key").isNotNull())
    place = F.pmod(F.xxhash64("key"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    picked = said.filter(place < min(1.0, sample / max(1, said.count())))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).join(F.broadcast(picked), "key")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").cast(pa.int32()), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"]
            )

    found = rows.mapInArrow(measure, "label int, x array<double>").toArrow()
    x = np.array(found["x"].to_pylist(), float).reshape(found.num_rows, len(STATISTICS))
    y = np.array(found["label"].to_pylist(), float)
    # Rows come in any order; sorted ones give the same sums, and so the same trees, each time.
    order = np.lexsort((*x.T, y))
    return boosting.fit(x[order], y[order], **options)


def score(docs: DataFrame, forest: boosting.Forest, text: str = "text", out: str = "score") -> DataFrame:
    """`docs` with `out`, the probability (0 to 1) that a text is of label 1.

    Whole texts are read, however long; null and empty ones get the score of a text without words.
    Rows and other columns stay; a column of the name `out` is replaced. The forest is
    broadcast: its size depends on its parameters alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    @F.arrow_udf("double")
    def predict(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.predict(matrix(texts.to_pylist())), pa.float64())

    # Not to be repeated below a filter on the score, which would measure every text twice.
    return docs.withColumn(out, predict.asNondeterministic()(F.col(f"`{text}`")))


def judge(docs: DataFrame, forest: boosting.Forest, text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """`docs` with `score`, and `predicted`: 1 where it is at least `least`, else 0."""
    return score(docs, forest, text).withColumn("predicted", (F.col("score") >= least).cast("int"))
