"""Benchmark passages in documents, by a positional inverted index of the documents.

The index is built from the documents alone, read once, and stores a posting for every word of
theirs. It is cut into shards of some megabytes of text, each indexed by the task that reads it;
a shard has one list per term, the ascending places of the term, kept as the gaps between them.
Documents of a shard follow each other with one place left out, so no window reaches across.

A benchmark is sent to the lists in blocks of bounded size. In each shard a window's lists,
each moved back by its word's offset, are met from the rarest term on: the rarest gives the places
where the window may start, and each further list keeps those that it has too. What is left after
the last list are the exact matches; nothing but the lists decides. Proximity matches come from
the lists of an item's rarest words, of those that occur at all, by searching around each place of
the rarest.

Words are taken from texts as `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from hoptrail.llm.common import digest, discard, materialize, release

#: Text of a shard, in bytes; one text is never cut, so a longer one is a shard by itself.
SHARD_BYTES = 8 << 20
#: Benchmark words sent to the workers at once; with more the index is read once more for each block.
WORDS_AT_ONCE = 1_000_000
#: Possible starts that are held against the lists at once, inside a task.
STARTS_AT_ONCE = 1 << 20
#: A term that no text has, under which a shard lists the first place of each document.
DOCUMENTS = ""
_KEPT = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 0 for b in range(256)
)
_MATCHES = "shard long, number int, uid long, start int, end int, span int"


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts after each other, and how many each text has."""
    texts = pc.fill_null(texts.cast(pa.binary()), b"")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    letters = np.frombuffer((data or pa.py_buffer(b""))[bounds[0] : bounds[-1]], np.uint8)
    bounds = bounds - bounds[0]
    letters = np.frombuffer(_KEPT, np.uint8)[letters]
    kept = letters != 0
    begins = kept.copy()
    begins[1:] &= ~kept[:-1]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[first] = kept[first]
    at = np.flatnonzero(begins)
    ends = np.append((np.cumsum(kept, dtype=np.int32) - 1)[at], kept.sum()).astype(np.int32)
    found = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(letters[kept]))
    return found, np.diff(np.searchsorted(at, bounds))


@F.arrow_udf(ArrayType(StringType()))
def words(texts: pa.Array) -> pa.Array:
    found, sizes = _words(texts)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), found)


def _lists(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Ascending places as gaps: of each list the first place, then the steps to the next."""
    ends = np.cumsum(sizes)
    gaps = np.diff(flat, prepend=0)
    starts = (ends - sizes)[sizes > 0]
    gaps[starts] = flat[starts]
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(gaps, pa.int32()))


def _shard(held: list[pa.RecordBatch], shard: int) -> Iterator[pa.RecordBatch]:
    """The rows of a shard: one per document, one with the documents' places, one per term."""
    table = pa.Table.from_batches(held).combine_chunks()
    found, sizes = _words(pa.concat_arrays(table.column("text").chunks))
    n = len(sizes)
    bases = np.cumsum(sizes) - sizes + np.arange(n)
    coded = found.dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False)
    places = np.arange(len(ids)) + np.repeat(np.arange(n), sizes)
    counts = np.bincount(ids, minlength=len(coded.dictionary))
    terms = pa.concat_arrays([pa.array([DOCUMENTS]), coded.dictionary.cast(pa.string())])
    flat = np.concatenate((bases, places[np.argsort(ids, kind="stable")]))
    counts = np.append(n, counts)
    kinds = {c: table.schema.field(c).type for c in ("doc", "mark")}
    names = ["shard", "term", "n", "gaps", "number", "doc", "mark", "n_words"]

    def rows(size: int, **columns: pa.Array) -> pa.RecordBatch:
        types = [pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int32()), pa.int32(), *kinds.values(), pa.int32()]
        columns["shard"] = pa.array(np.full(size, shard))
        return pa.RecordBatch.from_arrays(
            [columns[c] if c in columns else pa.nulls(size, t) for c, t in zip(names, types, strict=True)], names
        )

    yield rows(
        n,
        number=pa.array(np.arange(n), pa.int32()),
        n_words=pa.array(sizes, pa.int32()),
        **{c: pa.concat_arrays(table.column(c).chunks) for c in kinds},
    )
    yield rows(len(terms), term=terms, n=pa.array(counts, pa.int32()), gaps=_lists(flat, counts))


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size, shard = [], 0, TaskContext.get().partitionId() << 32
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column("text").nbytes
        if size >= SHARD_BYTES:
            yield from _shard(held, shard)
            held, size, shard = [], 0, shard + 1
    if held:
        yield from _shard(held, shard)
    del held
    release()


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """(uid, item_id, words): one row per different item and text that has words."""
    items = benchmark.select(
        F.col(f"`{item_id}`").cast("string").alias("item_id"), F.col(f"`{text}`").alias("text")
    ).filter(F.col("text").isNotNull())
    items = items.groupBy(F.xxhash64("item_id", "text").alias("uid")).agg(
        F.first("item_id").alias("item_id"), F.first("text").alias("text")
    )
    return items.select("uid", "item_id", words("text").alias("words")).filter(F.size("words") > 0)


class _Block:
    """Items as numbers of terms: their words after each other, and their near words."""

    def __init__(self, items: pa.Table):
        words = items.column("words").combine_chunks()
        coded = words.flatten().dictionary_encode()
        self.terms = coded.dictionary
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        self.uids = items.column("uid").to_numpy()
        numbers = {t: i for i, t in enumerate(self.terms.to_pylist())}
        self.near = [[numbers[t] for t in ts] for ts in items.column("near").to_pylist()]

    def windows(self, window: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(width, first words, items) of all windows of each width."""
        widths = np.minimum(self.sizes, window)
        begins = np.cumsum(self.sizes) - self.sizes
        for width in np.unique(widths).tolist():
            items = np.flatnonzero(widths == width)
            rows, first = _spread(begins[items], self.sizes[items] - width + 1)
            yield width, first, items[rows]


def _spread(first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows numbered and, for each, `counts` numbers that follow each other from `first` on."""
    rows = np.repeat(np.arange(len(counts)), counts)
    return rows, np.arange(len(rows)) + np.repeat(first - np.cumsum(counts) + counts, counts)


def _pieces(counts: np.ndarray, most: int) -> Iterator[slice]:
    """The rows in slices whose counts sum up to at most `most`, or that are a single row."""
    ends, a = np.cumsum(counts), 0
    while a < len(counts):
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + most, "right")))
        yield slice(a, b)
        a = b


class _Lists:
    """One shard's lists of a block's terms; `keys` are (term, place) as ascending numbers."""

    def __init__(self, postings: pa.Table, terms: pa.Array):
        gaps = postings.column("gaps").combine_chunks()
        sizes = pc.list_value_length(gaps).to_numpy(zero_copy_only=False).astype(np.int64)
        steps = gaps.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sums = np.cumsum(steps)
        starts = np.cumsum(sizes) - sizes
        flat = sums - np.repeat((sums - steps)[starts], sizes)
        own = pc.index_in(postings.column("term").combine_chunks(), value_set=terms)
        own = pc.fill_null(own, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(own, kind="stable")
        _, at = _spread(starts[order], sizes[order])
        flat, documents = flat[at], int(sizes[own < 0].sum())
        self.bases, self.places = flat[:documents], flat[documents:]
        self.n = np.zeros(len(terms), np.int64)
        self.n[own[own >= 0]] = sizes[own >= 0]
        self.first = np.cumsum(self.n) - self.n
        self.span = int(flat.max(initial=0)) + 2
        self.keys = np.repeat(np.arange(len(terms)), self.n) * self.span + self.places

    def numbers(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bases, places, "right") - 1

    def phrases(self, block: _Block, window: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(items, alignments, starts, ends) of the matches of all windows."""
        for width, firsts, items in block.windows(window):
            held = np.cumsum(np.append(0, self.n[block.ids] > 0))
            alive = held[firsts + width] - held[firsts] == width
            firsts, items = firsts[alive], items[alive]
            for a in range(0, len(firsts), STARTS_AT_ONCE // 16):
                first, item = (x[a : a + STARTS_AT_ONCE // 16] for x in (firsts, items))
                ids = block.ids[first[:, None] + np.arange(width)]
                rare = np.argsort(self.n[ids], axis=1, kind="stable")
                ids = np.take_along_axis(ids, rare, 1)
                for piece in _pieces(self.n[ids[:, 0]], STARTS_AT_ONCE):
                    row, start = self._met(ids[piece], rare[piece])
                    yield item[piece][row], start - first[piece][row], start, start + width

    def _met(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the lists of a window's terms, rarest first, meet when moved back by their offsets."""
        row, at = _spread(self.first[ids[:, 0]], self.n[ids[:, 0]])
        start = self.places[at] - offsets[row, 0]
        row, start = row[start >= 0], start[start >= 0]
        for k in range(1, ids.shape[1]):
            place = start + offsets[row, k]
            wanted = ids[row, k] * self.span + place
            found = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            keep = (self.keys[found] == wanted) & (place < self.span)
            row, start = row[keep], start[keep]
        return row, start

    def near(self, block: _Block, slop: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(items, documents, spans) of places of all near words of an item within `slop` words."""
        sizes = np.array([len(x) for x in block.near], np.int64)
        for size in np.unique(sizes[sizes > 0]).tolist():
            items = np.flatnonzero(sizes == size)
            ids = np.array([block.near[i] for i in items.tolist()], np.int64)
            alive = self.n[ids].min(1) > 0
            items, ids = items[alive], ids[alive]
            row, at = _spread(self.first[ids[:, 0]], self.n[ids[:, 0]])
            for a in range(0, len(row), STARTS_AT_ONCE // 128):
                part = slice(a, a + STARTS_AT_ONCE // 128)
                yield self._around(items, ids, row[part], self.places[at[part]], slop)

    def _around(self, items, ids, row, place, slop) -> tuple[np.ndarray, ...]:
        number = self.numbers(place)
        after = np.append(self.bases, self.span)
        low = high = place
        for k in range(1, ids.shape[1]):
            term = ids[row, k] * self.span
            left = np.searchsorted(self.keys, term + np.maximum(high - slop + 1, self.bases[number]))
            right = np.searchsorted(self.keys, term + np.minimum(low + slop, after[number + 1]))
            again, at = _spread(left, np.maximum(right - left, 0))
            row, number, low, high = row[again], number[again], low[again], high[again]
            low, high = np.minimum(low, self.places[at]), np.maximum(high, self.places[at])
        fits = high - low < slop
        return items[row[fits]], number[fits], (high - low + 1)[fits]


def _runs(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Matches of one item in one alignment that touch each other as one run: items, starts, ends."""
    item, shift, start, end = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((start, shift, item))
    item, shift, start, end = item[order], shift[order], start[order], end[order]
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (shift[1:] != shift[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    return item[first], start[first], end[np.append(first[1:], len(item)) - 1] if len(first) else end[:0]


def _search(postings: pa.Table, block: _Block, window: int, slop: int | None) -> pa.Table:
    """The matches of a block of items in one shard."""
    lists = _Lists(postings, block.terms)
    none = np.zeros(0, np.int64)
    item, start, end = _runs([(none,) * 4, *lists.phrases(block, window)])
    number = lists.numbers(start)
    base = lists.bases[number]
    close = [(none,) * 3, *(lists.near(block, slop) if slop is not None else ())]
    near, within, span = (np.concatenate(x) for x in zip(*close, strict=True))
    order = np.lexsort((span, within, near))
    near, within, span = near[order], within[order], span[order]
    least = np.ones(len(near), bool)
    least[1:] = (near[1:] != near[:-1]) | (within[1:] != within[:-1])
    near, within, span = near[least], within[least], span[least]
    places = lambda x, n: pa.concat_arrays([pa.array(x, pa.int32()), pa.nulls(n, pa.int32())])
    return pa.table(
        {
            "shard": pa.array(np.full(len(item) + len(near), postings.column("shard")[0].as_py())),
            "number": pa.array(np.append(number, within), pa.int32()),
            "uid": pa.array(block.uids[np.append(item, near)]),
            "start": places(start - base, len(near)),
            "end": places(end - base, len(near)),
            "span": pa.concat_arrays([pa.nulls(len(item), pa.int32()), pa.array(span, pa.int32())]),
        }
    )


class Matches:
    """What `Index.search` found, by document of a shard."""

    def __init__(self, documents: DataFrame, found: DataFrame, items: DataFrame):
        self.documents = documents
        self.found = found.join(items.select("uid", "item_id"), "uid")

    def _of(self, found: DataFrame, *columns: str) -> DataFrame:
        named = found.join(self.documents, ["shard", "number"])
        return named.select("doc", "mark", "item_id", *columns)

    def phrases(self) -> DataFrame:
        """(doc, mark, item_id, start, end): runs of document words, end exclusive, that an item has.

        Each run is at least a window long, and every matching window lies in one run of its item.
        """
        return self._of(self.found.filter("span IS NULL"), "start", "end")

    def near(self) -> DataFrame:
        """(doc, mark, item_id, span): documents that have all of an item's near words within the
        slop, in any order; `span` is the least number of words that holds them.
        """
        return self._of(self.found.filter("span IS NOT NULL"), "span")


class Index:
    """The positional inverted index of documents, which any benchmark can be searched in.

    `table` is written to the shared folder. A row with a `term` is a list of a `shard`: `n`
    places, as the `gaps` between them; a row without is the document `number` of the shard:
    its key `doc`, a hash `mark` of its text, and `n_words`. Nothing reads the texts again.
    """

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text"):
        docs = docs.select(
            F.col(f"`{key}`").alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("mark"), F.col(f"`{text}`").alias("text")
        )
        kind = docs.schema["doc"].dataType.simpleString()
        self.table = materialize(
            docs.mapInArrow(
                _post,
                f"shard long, term string, n int, gaps array<int>, number int, doc {kind}, mark long, n_words int",
            )
        )
        self.documents = self.table.filter("term IS NULL").select("shard", "number", "doc", "mark", "n_words")

    def search(
        self,
        benchmark: DataFrame,
        item_id: str = "item_id",
        item_text: str = "text",
        window: int = 10,
        near: int = 3,
        slop: int | None = None,
    ) -> Matches:
        """The phrase matches of a benchmark and, with `slop`, its proximity matches."""
        spark = self.table.sparkSession
        items = _items(benchmark, item_id, item_text)
        items = materialize(items if slop is not None else items.withColumn("near", F.array().cast("array<string>")))
        if slop is not None:
            items = materialize(self._with_near(items, near))
        total = items.agg(F.sum(F.size("words"))).first()[0] or 0
        parts, found = -(-total // WORDS_AT_ONCE), []
        for part in range(parts):
            mine = items.filter(F.pmod("uid", F.lit(parts)) == part)
            block = _Block(mine.select("uid", "words", "near").toArrow())
            if len(block.uids):
                found.append(self._search_block(mine, block, window, slop))
        none = spark.createDataFrame([], _MATCHES)
        return Matches(self.documents, reduce(DataFrame.unionAll, found) if found else none, items)

    def _search_block(self, items: DataFrame, block: _Block, window: int, slop: int | None) -> DataFrame:
        # Both bounded by the words of a block; freed before the next is sent.
        terms = items.select(F.explode("words").alias("term")).distinct()
        terms = terms.unionAll(terms.sparkSession.createDataFrame([(DOCUMENTS,)], "term string"))
        shared = items.sparkSession.sparkContext.broadcast(block)
        postings = self.table.filter("term IS NOT NULL").select("shard", "term", "gaps")
        found = materialize(
            postings.join(F.broadcast(terms), "term", "left_semi")
            .groupBy("shard")
            .applyInArrow(lambda rows: _search(rows, shared.value, window, slop), _MATCHES)
        )
        shared.destroy()
        return found

    def _with_near(self, items: DataFrame, near: int) -> DataFrame:
        """Items with their `near` rarest different words that some document has, rarest first.

        An item of several different words needs two of them.
        """
        placed = items.select("uid", F.posexplode("words").alias("place", "term"))
        placed = placed.groupBy("uid", "term").agg(F.min("place").alias("place"))
        terms = placed.select("term").distinct()
        lists = self.table.filter("term IS NOT NULL").select("term", "n")
        frequency = lists.join(terms, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n"))
        rated = placed.join(frequency, "term", "left").groupBy("uid").agg(
            F.slice(
                F.array_sort(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("n", "place", "term")))), 1, near
            )["term"].alias("rarest"),
            F.least(F.count(F.lit(1)), F.lit(min(2, near))).alias("needed"),
        )
        enough = F.when(F.size("rarest") >= F.col("needed"), F.col("rarest"))
        rated = rated.select("uid", F.coalesce(enough, F.array().cast("array<string>")).alias("near"))
        return items.join(rated, "uid")


def covered(runs: Column) -> Column:
    """How many places an array of (start, end) covers."""

    def add(state: Column, run: Column) -> Column:
        fresh = F.greatest(run["end"] - F.greatest(run["start"], state["at"]), F.lit(0))
        return F.struct(F.greatest(state["at"], run["end"]).alias("at"), (state["n"] + fresh).alias("n"))

    begin = F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"))
    return F.aggregate(F.array_sort(runs), begin, add, lambda state: state["n"]).cast("long")


def report(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", slop: int | None = None, **names
) -> DataFrame:
    """Per document: key, n_words, n_hit, n_items, items_sha256, contaminated, matches.

    With `slop` also the proximity matches, by item: n_near, near_sha256 (of the items' ids, as
    items_sha256) and near, an array of item_id and span. They don't make a document contaminated.

    Null and empty texts have no words and no hits; null items and items without a word match
    nothing; an item without an id is hit but not named. Equal rows stay, each with the same
    result; items given twice count once. An empty benchmark leaves every document clean.
    """
    index = Index(docs, key, text)
    matches = index.search(benchmark, slop=slop, **names)
    documents = materialize(index.documents)
    discard(index.table)
    by = ["shard", "number"]
    run = F.when(F.col("span").isNull(), F.struct("start", "end"))
    phrase = F.when(F.col("span").isNull(), F.struct("item_id", "start", "end"))
    spans = matches.found.groupBy(*by, "item_id").agg(
        F.collect_set(run).alias("runs"), F.collect_set(phrase).alias("phrases"), F.min("span").alias("span")
    )
    found = spans.groupBy(*by).agg(
        covered(F.array_distinct(F.flatten(F.collect_list("runs")))).alias("n_hit"),
        F.array_sort(F.collect_set(F.when(F.size("runs") > 0, F.col("item_id")))).alias("items"),
        F.flatten(F.collect_list("phrases")).alias("matches"),
        F.array_sort(F.collect_list(F.when(F.col("span").isNotNull(), F.struct("item_id", "span")))).alias("near"),
    )
    items = F.coalesce("items", F.array().cast("array<string>"))
    hits = F.coalesce("n_hit", F.lit(0)).cast("long")
    near = F.coalesce("near", F.array().cast("array<struct<item_id:string,span:int>>"))
    named = F.filter(near["item_id"], lambda x: x.isNotNull())
    out = documents.join(found, by, "left").select(
        F.col("doc").alias(key),
        F.col("n_words").cast("long").alias("n_words"),
        hits.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        digest(items).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
        F.coalesce("matches", F.array().cast("array<struct<item_id:string,start:int,end:int>>")).alias("matches"),
        F.size(named).cast("long").alias("n_near"),
        digest(named).alias("near_sha256"),
        near.alias("near"),
    )
    return out if slop is not None else out.drop("n_near", "near_sha256", "near")


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The rows of `docs` in which no benchmark passage occurs."""
    index = Index(docs, key, text)
    found = materialize(index.search(benchmark, **names).phrases().select("doc", "mark").distinct())
    discard(index.table)
    same = F.col(f"`{key}`").eqNullSafe(found["doc"]) & (F.xxhash64(F.col(f"`{text}`")) == found["mark"])
    return docs.join(found, same, "left_anti")
