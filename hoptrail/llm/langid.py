"""Language of a text by word-first backoff.

A word that the model knows scores its log frequency in each language. A word that it doesn't
know scores by its longest known character n-grams: from each place the longest n-gram of the
word (with `^` and `$` at its ends) that some language has, else a shorter one, down to a
single character. A language in which a known word or n-gram never occurs pays for half an
occurrence.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail.llm.common import release

UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
LONGEST = 4
#: Scores of words that a worker remembers before it starts anew.
REMEMBERED = 300_000


@dataclass
class Table:
    """Rows of log frequencies by language, found by word or n-gram."""

    rows: dict[str, int]
    logs: np.ndarray


@dataclass
class Model:
    """Languages, and log frequencies of words and of n-grams (a table per length)."""

    languages: list[str]
    words: Table
    grams: list[Table]
    identifier: Identifier | None = field(default=None, repr=False, compare=False)

    def score(self, word: str) -> np.ndarray:
        """Log probability of a lower-case word by language, up to a constant."""
        if (row := self.words.rows.get(word)) is not None:
            return self.words.logs[row]
        held, total = f"^{word}$", np.zeros(len(self.languages))
        for i in range(len(held)):
            for n in range(min(LONGEST, len(held) - i), 0, -1):
                if (row := self.grams[n].rows.get(held[i : i + n])) is not None:
                    total += self.grams[n].logs[row]
                    break
        # Overlapping n-grams tell the same thing several times.
        return total / LONGEST


def word_list(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _grams(words: Counter) -> list[Counter]:
    out = [Counter() for _ in range(LONGEST + 1)]
    for word, times in words.items():
        held = f"^{word}$"
        for n in range(1, LONGEST + 1):
            for i in range(len(held) - n + 1):
                out[n][held[i : i + n]] += times
    return out


def _logs(counts: dict[str, Counter], languages: list[str], least: int) -> Table:
    keys = Counter()
    for lang in languages:
        keys.update(counts[lang])
    kept = [key for key, times in keys.items() if times >= least]
    found = np.array([[counts[lang][key] for lang in languages] for key in kept], float)
    totals = np.array([max(1, sum(counts[lang].values())) for lang in languages], float)
    logs = np.log((found.reshape(len(kept), len(languages)) + 0.5) / totals)
    return Table({key: i for i, key in enumerate(kept)}, logs)


def fit(
    labelled: DataFrame, text: str = "text", lang: str = "lang", sample: int = 1000
) -> Model:
    """Fit on a bounded sample: at most about `sample` different texts of each language (all, if fewer).

    Which rows is decided by a hash of the text, so it depends on neither order nor partitions;
    copies of a text are in or out together and count once. Rows without a text or a language
    are not learnt from. Words are counted on the executors; what comes back are the words of
    the sample. Without any row the model knows no language, and all texts are `und`.
    """
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    # Copies would only make the share of the texts smaller.
    texts = rows.select("lang", F.xxhash64("text").alias("mark")).distinct()
    sizes = {r["lang"]: r["count"] for r in texts.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        nothing = Table({}, np.empty((0, 0)))
        return Model([], nothing, [nothing] * (LONGEST + 1))
    share = F.lit(0.0)
    for name in languages:
        share = F.when(F.col("lang") == name, F.lit(min(1.0, sample / sizes[name]))).otherwise(share)
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    picked = rows.filter(place < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for batch in batches:
            for name, value in zip(*(batch.column(c).to_pylist() for c in ("lang", "text")), strict=True):
                found.setdefault(name, Counter()).update(word_list(value))
        for name, words in found.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [name] * len(words), "word": list(words), "n": list(words.values())},
                schema=pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]),
            )

    counted = (
        picked.distinct()
        .mapInArrow(count, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    words = {name: Counter() for name in languages}
    for name, word, n in zip(*(counted.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
        words[name][word] = n
    grams = {name: _grams(words[name]) for name in languages}
    return Model(
        languages,
        _logs(words, languages, 2),
        [_logs({name: grams[name][n] for name in languages}, languages, 1 if n == 1 else 2) for n in range(LONGEST + 1)],
    )


class Identifier:
    """Scores texts with a model, remembering words."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.logs = np.empty((1 << 12, len(self.model.languages)))

    def _rows(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))

    def _learn(self, words: set[str]) -> None:
        for word in words:
            if len(self.known) == len(self.logs):
                self.logs = np.concatenate((self.logs, np.empty_like(self.logs)))
            self.logs[len(self.known)] = self.model.score(word)
            self.known[word] = len(self.known)

    def predict(self, text: str | None) -> tuple[str, float]:
        words = word_list(text)
        if not words or not self.model.languages or not any(map(str.isalpha, text or "")):
            return UNKNOWN, 0.0
        rows = self._rows(words)
        missed = np.flatnonzero(rows < 0)
        if len(missed):
            new = {words[i] for i in missed}
            if len(self.known) + len(new) > REMEMBERED:
                self._forget()
                new = set(words)
            self._learn(new)
            rows = self._rows(words)
        # Per word, so that the score of a long text isn't always 1.
        mean = self.logs[rows].mean(0)
        best = int(mean.argmax())
        return self.model.languages[best], float(1 / np.exp(mean - mean[best]).sum())


def predictor(df: DataFrame, model: Model):
    """A column function: text to struct(lang, score).

    The model is broadcast; its size is bounded by that of the sample it was fitted on. What a
    worker remembers goes with its copy of the model, when a later task doesn't use that any more.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        known = shared.value
        known.identifier = known.identifier or Identifier(known)
        found = [known.identifier.predict(t.as_py()) for t in texts]
        release()
        return pa.StructArray.from_arrays(
            [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
            ["lang", "score"],
        )

    return predict


def predict(df: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """`df` with `out`, a struct of language and score (0 to 1, the share of the best language
    in the mean word's probability).

    Null texts and texts without a letter get (`und`, 0). Whole texts are read, however long.
    Rows stay, equal ones alike; a column of the name `out` is replaced.
    """
    return df.withColumn(out, predictor(df, model)(F.col(f"`{text}`")))


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: crc32 of its key as text, modulo 3, is 1."""
    return F.crc32(key.cast("string")) % 3 == 1
