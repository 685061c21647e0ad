"""Repeated passages by sliding spans of sentences.

A text is cut into sentences. From each sentence on, and back from each, the shortest run that
is long enough is a span; its words are hashed, and equal spans meet by hash. Of each repeated
span the first one (least key, then place) stays; sentences that any other one covers are
removed. Each run of sentences that is long enough is the union of the spans in it, so this
removes the same sentences as hashing every such run would.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.llm.common import discard, materialize

#: A span has this many sentences and words; a sentence of `WORDS_ALONE` words is a passage by
#: itself, as texts without stops are a single sentence. Shorter runs repeat by chance or are
#: boilerplate of a line or two. Of 7913 documents of sf0.1 without 51 words in a row that another
#: has, and 1206 with words of an earlier one (near copies with changed words are among both):
#:
#:     runs hashed                          first left alone   second changed
#:     2 sentences                               0.653             0.959
#:     3 sentences                               0.880             0.945
#:     4 sentences                               0.911             0.906
#:     2 or more, 8 words (or 20 alone)          0.715             0.963
#:     2 or more, 12 words                       0.917             0.950
#:     2 or more, 16 words                       0.933             0.947
#:     2 or more, 20 words                       0.937             0.946
#:     2 or more, 20 words (or 50 alone)         0.937             0.952
SENTENCES, WORDS, WORDS_ALONE = 2, 20, 50
_STOPS = ".!?…。！？"
#: Stops that follow each other are read once, from the first one on, so that a long run of them
#: that ends no sentence takes no longer than other text.
_SENTENCE = re.compile(
    rf"(?<![{_STOPS}])[{_STOPS}]{{2,}}+(?=\s|$)"
    rf"|[^\s].*?(?:(?<![{_STOPS}])[{_STOPS}]++(?=\s|$)|[。！？]+[」』”’）]*|(?=\n)|$)",
    re.M,
)
#: Characters of scripts without spaces between words; two count as a word.
_UNSPACED = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]"
)


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Places (start, end) of the sentences: up to `.`, `!` or `?` before white space, `。`, `！` or `？`, or a line's end."""
    return [m.span() for m in _SENTENCE.finditer(text or "")]


def spans(text: str | None) -> list[tuple[int, int, int]]:
    """(hash, first sentence, end) of the spans of a text."""
    words = [text[a:b].lower().split() for a, b in sentences(text)]
    unspaced = _UNSPACED.search(text or "") is not None
    sizes = [len(w) + (len(_UNSPACED.findall("".join(w))) // 2 if unspaced else 0) for w in words]
    total = np.concatenate(([0], np.cumsum(sizes))).tolist()
    n, found = len(words), set()
    enough = lambda a, b: (b - a >= SENTENCES and total[b] - total[a] >= WORDS) or total[b] - total[a] >= WORDS_ALONE
    b = 0
    for a in range(n):
        b = max(b, a + 1)
        while b < n and not enough(a, b):
            b += 1
        if enough(a, b):
            found.add((a, b))
    a = n - 1
    for b in range(n, 0, -1):
        a = min(a, b - 1)
        while a > 0 and not enough(a, b):
            a -= 1
        if enough(a, b):
            found.add((a, b))
    joined = [" ".join(w) for w in words]
    return [(xxhash.xxh3_64_intdigest(" ".join(joined[a:b])) - (1 << 63), a, b) for a, b in found]


def _without(text: str, covered: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without the covered sentences and the white space before them; sentences, removed."""
    places = sentences(text)
    gone = np.zeros(len(places) + 1, np.int64)
    for a, b in covered:
        gone[a] += 1
        gone[b] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    out, at = [], 0
    for (start, end), drop in zip(places, gone, strict=True):
        if not drop:
            out.append(text[at:end])
        at = end
    out.append(text[at:])
    kept = "".join(out)
    return (kept.lstrip() if len(gone) and gone[0] else kept), len(places), int(gone.sum())


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`df` with repeated passages removed from `text`, and n_sentences and n_removed added.

    Null texts stay null with no sentences; texts too short for a span are left as they are, and
    texts of any length are read whole. Rows of one key and text are the same document and
    don't repeat each other; null keys come first. Other columns pass through; n_sentences and
    n_removed are replaced if there. Words are compared lower-cased, white space as such isn't.
    """
    kept = [c for c in df.columns if c not in ("n_sentences", "n_removed")]
    docs = df.select(F.col(f"`{key}`").alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("mark"), F.col(f"`{text}`").alias("text"))
    kind = docs.schema["doc"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans(t) for t in batch.column("text").to_pylist()]
            row = pa.array(np.repeat(np.arange(len(found)), [len(s) for s in found]))
            flat = [s for ss in found for s in ss]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(row) for c in ("doc", "mark")),
                    *(pa.array([s[i] for s in flat], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32()))),
                ],
                ["doc", "mark", "span", "first", "last"],
            )

    # Written once, as the texts take longer to read than their spans.
    found = materialize(docs.mapInArrow(scan, f"doc {kind}, mark long, span long, first int, last int"))
    repeated = materialize(
        found.groupBy("span")
        .agg(F.min(F.struct("doc", "mark", "first")).alias("origin"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1")
        .drop("times")
    )
    later = found.join(repeated, "span").filter(~F.struct("doc", "mark", "first").eqNullSafe(F.col("origin")))
    covered = materialize(
        later.groupBy("doc", "mark").agg(F.collect_set(F.struct("first", "last")).alias("covered"))
    )
    discard(found, repeated)

    @F.arrow_udf("text string, n_sentences long, n_removed long")
    def cut(texts: pa.Array, covered: pa.Array) -> pa.Array:
        rows = [
            (None, 0, 0) if t is None else _without(t, [(x["first"], x["last"]) for x in c or []])
            for t, c in zip(texts.to_pylist(), covered.to_pylist(), strict=True)
        ]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
        return pa.StructArray.from_arrays(columns, ["text", "n_sentences", "n_removed"])

    # The row's own columns in one, so that no name can clash.
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"))
    value = F.col("row")[text]
    same = F.col("row")[key].eqNullSafe(F.col("doc")) & (F.xxhash64(value) == F.col("mark"))
    joined = rows.join(covered, same, "left").select("row", cut(value, F.col("covered")).alias("cut"))
    return joined.select(
        *(F.col("cut.text").alias(c) if c == text else F.col("row")[c].alias(c) for c in kept),
        F.col("cut.n_sentences").alias("n_sentences"),
        F.col("cut.n_removed").alias("n_removed"),
    )
