"""Near copies by bottom-k sketches of one hash function.

A document is the set of hashes of its word shingles; documents of one set are one node. A
node's sketch is the `k` least hashes. Inverted lists hold, for each value, the nodes whose
sketch retained it; nodes that share a list are compared. Two sets of the wanted similarity
share most of their sketches, so with the values of each sketch in one global order, rarest
first, it is enough to list the first few: frequent values are hardly ever listed.

Near copies share many lists. Lists with the same most central member (their hub) are put
together. The sketches of such a family are compared in blocks, each pair of blocks in one task, by
the similarity that the sketch of the union estimates. The full sets of members that have a partner
by then are first compared with the hub's alone: a link between two members that are linked
to the hub joins nothing new, so only the others meet each other and the linked ones, in
blocks again. No pair is written but the links that join members of a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoptrail.llm.common import discard, materialize, release
from hoptrail.llm.components import components

K = 64
#: Standard deviations that a sketch of similar sets may fall short of its expectation.
SIGMAS = 5
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _weights(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """For each text, the sorted distinct hashes (int64) of its `width`-word shingles.

    A-Z are lower-cased; words are what white space of ASCII separates. A text of fewer words
    has its whole sequence as one shingle; one without words has the empty set.
    """
    data = np.frombuffer(b"".join(t or b"" for t in texts), np.uint8)
    sizes = np.array([len(t or b"") for t in texts], np.int64)
    ends = np.cumsum(sizes)
    if not len(data):
        return [np.empty(0, np.int64)] * len(texts)
    letter = ~_SPACE[data]
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    first = (ends - sizes)[sizes > 0]
    begins[first] = letter[first]
    # Of each word: where it starts among all letters, and its multilinear hash.
    starts = np.cumsum(letter)[begins] - 1
    kept = _LOWER[data[letter]]
    if not len(kept):
        return [np.empty(0, np.int64)] * len(texts)
    lengths = np.diff(starts, append=len(kept))
    place = np.arange(len(kept)) - np.repeat(starts, lengths)
    words = mix(np.add.reduceat((kept + np.uint64(1)) * _weights(int(lengths.max()))[place], starts))
    counted = np.concatenate(([0], np.cumsum(begins)))[ends]
    edges = np.concatenate(([0], counted))
    by_place = _weights(width + 1)
    out = []
    joined = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for j in range(width):
        joined += words[j : j + len(joined)] * by_place[j]
    joined = mix(joined + by_place[width] * np.uint64(width))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        n = int(b - a)
        if n >= width:
            mine = joined[a : b - width + 1]
        elif n:
            mine = mix((words[a:b] * by_place[:n]).sum(keepdims=True) + by_place[width] * np.uint64(n))
        else:
            mine = np.empty(0, np.uint64)
        out.append(np.unique(mine.view(np.int64)))
    return out


def _node(values: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(values.tobytes(), len(values)) - (1 << 63)


#: Bytes of text that are hashed at once; each takes some 60 bytes of memory meanwhile.
SCANNED = 1 << 20


def _scan(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Node and set of each text, in order; whole texts, so a longer one than `SCANNED` is hashed alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // SCANNED
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        for values in shingle_sets(texts.slice(a, b - a).cast(pa.binary()).to_pylist(), width):
            yield (_node(values) if len(values) else 0), values


def least_shared(n: Column, num: int, den: int) -> Column:
    """Sketch values that a set of `n` shares with any similar one, but for chances of `SIGMAS`."""
    exact = F.ceil(n * num / den)
    union = F.greatest(n * den / num, F.lit(K))
    j = num / den
    spread = F.sqrt(K * j * (1 - j) * (1 - K / union))
    sampled = F.floor(K * j - SIGMAS * spread)
    return F.when(n * den <= K * num, exact).otherwise(F.least(exact, sampled)).cast("int")


def _least_shared(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """`least_shared` of many sizes."""
    j, exact = num / den, -(-n * num // den)
    spread = np.sqrt(K * j * (1 - j) * (1 - K / np.maximum(n * den / num, K)))
    return np.where(n * den <= K * num, exact, np.minimum(exact, np.floor(K * j - SIGMAS * spread)))


def common(rows: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """How many values each row shares with each other, by products of incidence matrices."""
    if len(rows) * len(others) <= 16:
        return np.array([[len(np.intersect1d(x, y, True)) for y in others] for x in rows], np.int64)
    flat = np.concatenate(rows + others)
    who = np.repeat(np.arange(len(rows) + len(others)), [len(x) for x in rows + others])
    _, column = np.unique(flat, return_inverse=True)
    left = who < len(rows)
    # Only values on both sides count.
    both = (np.bincount(column[left], minlength=column.max() + 1) > 0) & (
        np.bincount(column[~left], minlength=column.max() + 1) > 0
    )
    column = np.where(both, np.cumsum(both) - 1, -1)[column]
    out = np.zeros((len(rows), len(others)))
    for first in range(0, int(both.sum()), 4096):
        here = (column >= first) & (column < first + 4096)
        width = min(4096, int(both.sum()) - first)
        a, b = np.zeros((len(rows), width), np.float32), np.zeros((len(others), width), np.float32)
        a[who[here & left], column[here & left] - first] = 1
        b[who[here & ~left] - len(rows), column[here & ~left] - first] = 1
        out += a @ b.T
    return out.astype(np.int64)


def _may_be_similar(n, sketches, m, others, num: int, den: int) -> np.ndarray:
    """Pairs whose sketches allow the similarity.

    Up to the lesser of two sketches' last values both sets are known whole, which is a sketch
    of the union; the share of common values in it estimates the similarity.
    """
    shared = common(sketches, others)
    least = np.minimum(_least_shared(n, num, den)[:, None], _least_shared(m, num, den)[None])
    top = np.iinfo(np.int64).max
    last_a = np.array([x[-1] if size > K else top for x, size in zip(sketches, n, strict=True)])
    last_b = np.array([x[-1] if size > K else top for x, size in zip(others, m, strict=True)])
    known_a = np.array([np.searchsorted(x, np.minimum(last, last_b), "right") for x, last in zip(sketches, last_a, strict=True)])
    known_b = np.array([np.searchsorted(x, np.minimum(last, last_a), "right") for x, last in zip(others, last_b, strict=True)]).T
    union = np.maximum(known_a + known_b - shared, 1)
    j = num / den
    fit = (n[:, None] * den >= m[None] * num) & (m[None] * den >= n[:, None] * num)
    return fit & (shared >= least) & (shared >= union * j - SIGMAS * np.sqrt(union * j * (1 - j)))


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of sorted batches, one by one."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.column_stack([batch.column(k).to_numpy() for k in keys])
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(1)) + 1
        if last is not None and (values[0] != last).any():
            yield pa.Table.from_batches(rest)
            rest = []
        edges = [0, *cuts.tolist(), batch.num_rows]
        for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if i:
                yield pa.Table.from_batches(rest)
                rest = []
            rest.append(batch.slice(a, b - a))
        last = values[-1]
    if rest:
        yield pa.Table.from_batches(rest)


def _arrays(table: pa.Table, name: str) -> list[np.ndarray]:
    column = table.column(name).combine_chunks()
    flat, ends = column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())
    return np.split(flat, ends[:-1])


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the two blocks of a group; of one block, the same rows twice."""
    block, low, high = (table.column(c).to_numpy() for c in ("block", "low", "high"))
    rows = np.flatnonzero(block == low)
    return (rows, np.flatnonzero(block == high)) if low[0] != high[0] else (rows, rows)


def _forest(a: np.ndarray, b: np.ndarray, linked: np.ndarray) -> tuple[list[int], list[int]]:
    """Of the linked pairs, as many as join what they join."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    out: tuple[list[int], list[int]] = ([], [])
    for i, j in zip(*(x.tolist() for x in np.nonzero(linked)), strict=True):
        x, y = int(a[i]), int(b[j])
        if root(x) != root(y):
            up[root(x)] = root(y)
            out[0].append(x)
            out[1].append(y)
    return out


#: Members of a block and values that they hold, at most; two blocks meet in one task.
BLOCK, BLOCK_VALUES = 512, 250_000


def _in_blocks(members: DataFrame, size: Column) -> DataFrame:
    """`members` (hub, node, ...) of `size` values once for each pair of blocks (low, high) of its family."""
    count, held = F.count(F.lit(1)), F.sum(size)
    parts = materialize(
        members.groupBy("hub")
        .agg(F.ceil(F.greatest(count / BLOCK, held / BLOCK_VALUES)).cast("int").alias("parts"), count.alias("held"))
        .filter("held > 1")
        .drop("held")
    )
    dealt = members.join(parts, "hub").withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    met = dealt.withColumn("other", other).drop("parts")
    return met.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other")


def _parts(members: DataFrame, values: str, name: str) -> DataFrame:
    count, held = F.count(F.lit(1)), F.sum(F.size(values))
    return members.groupBy("hub").agg(F.ceil(F.greatest(count / BLOCK, held / BLOCK_VALUES)).cast("int").alias(name))


def _meet_two(left: DataFrame, right: DataFrame, values: str, compare, schema: str) -> DataFrame:
    """Each block of `left` with each of `right` in the same family, by `side` 0 and 1."""
    parts = materialize(_parts(left, values, "lefts").join(_parts(right, values, "rights"), "hub"))
    own = F.xxhash64("node")
    one = left.join(parts, "hub").withColumns(
        {"low": F.pmod(own, F.col("lefts")).cast("int"), "high": F.explode(F.sequence(F.lit(0), F.col("rights") - 1)), "side": F.lit(0)}
    )
    two = right.join(parts, "hub").withColumns(
        {"low": F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)), "high": F.pmod(own, F.col("rights")).cast("int"), "side": F.lit(1)}
    )
    keys = ["hub", "low", "high"]
    met = one.unionByName(two).drop("lefts", "rights")
    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, schema)


def _meet(dealt: DataFrame, compare, schema: str) -> DataFrame:
    keys = ["hub", "low", "high"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, schema)


#: Bits of a filter of keys, 64 a row: its size is bounded whatever the keys are.
MARK_BITS = 1 << 26


def _place(key: str) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(MARK_BITS - 1)).alias("hoptrail_place")


def marks(keys: DataFrame, key: str) -> DataFrame:
    """The bits that a hash of each key sets, as rows of 64, written."""
    place = F.col("hoptrail_place")
    return materialize(
        keys.select(_place(key))
        .groupBy(F.shiftright(place, 6).alias("hoptrail_word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(hoptrail_place & 63 as int)))").alias("hoptrail_bits"))
    )


def marked(df: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """`df` with `hoptrail_marked`: whether its key may be one of those of `marks`; false only if it is none."""
    rows = df.select("*", _place(key))
    rows = rows.join(F.broadcast(found), F.shiftright("hoptrail_place", 6) == F.col("hoptrail_word"), "left")
    bit = F.expr("coalesce(shiftright(hoptrail_bits, cast(hoptrail_place & 63 as int)) & 1 = 1, false)")
    return rows.withColumn("hoptrail_marked", bit).drop("hoptrail_place", "hoptrail_word", "hoptrail_bits")


class NearCopies:
    """Groups of similar documents of a frame.

    Linked are documents with `den * intersection >= num * union` of their shingle sets.
    Sets are told apart by 64-bit hashes. Null and empty texts have the empty set and are
    linked with nothing. Equal rows and rows of one set share a group whatever their keys; a null
    key never names a group that has another. All links are found but for chances of a sketch
    falling `SIGMAS` standard deviations short.
    """

    def __init__(
        self, docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, num: int = 80, den: int = 100
    ):
        self.num, self.den = num, den
        docs = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("text"))
        kind = docs.schema["doc"].dataType.simpleString()

        def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = list(_scan(batch.column("text"), width))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc"),
                        pa.array([node for node, _ in rows], pa.int64()),
                        pa.array([len(values) for _, values in rows], pa.int64()),
                        pa.array([values[:K] for _, values in rows], pa.list_(pa.int64())),
                    ],
                    ["doc", "node", "n", "sketch"],
                )
            release()

        scanned = materialize(docs.mapInArrow(sketch, f"doc {kind}, node long, n long, sketch array<long>"))
        self.rows = materialize(scanned.select("doc", "node", "n"))
        # Sketches are shuffled once; what follows needs one of each node.
        nodes = materialize(
            scanned.filter("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
        )
        discard(scanned)
        self.labels = self._labels(docs, nodes, width)

    def _lists(self, nodes: DataFrame) -> DataFrame:
        """(value, node, n, shared): the inverted lists, with each node's number of shared values, written."""
        held = nodes.select("node", "n", F.explode("sketch").alias("value"))
        # Written, like every side of a join that may be skewed: Spark can then split both sides.
        frequent = materialize(held.groupBy("value").agg(F.count(F.lit(1)).alias("times")).filter("times > 1"))
        # Dealt by node as plain rows, which take less than half of what partly collected lists do.
        by_node = held.join(frequent, "value").repartition("node").groupBy("node").agg(
            F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("times", "value"))).alias("found")
        )
        size = F.least("n", F.lit(K)).cast("int")
        shared = F.size("found")
        # The first values of the sketch are those that no other sketch has.
        room = size - least_shared(F.col("n"), self.num, self.den) + 1 - (size - shared)
        listed = F.slice("found", F.lit(1), F.greatest(room, F.lit(0)))
        value = F.explode(F.transform(listed, lambda x: x["value"])).alias("value")
        lists = materialize(by_node.select("node", "n", shared.alias("shared"), value))
        discard(frequent)
        return lists

    def _sets(self, docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
        """(node, values): the full sets of the nodes, from one row of each; other texts aren't shuffled."""
        one = self.rows.groupBy("node").agg(F.min("doc").alias("doc"))
        asked = materialize(
            one.join(nodes, "node", "left_semi").groupBy("doc").agg(F.collect_list("node").alias("nodes"))
        )

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [
                    row
                    for row, nodes in zip(_scan(batch.column("text"), width), batch.column("nodes").to_pylist(), strict=True)
                    if row[0] in nodes
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n for n, _ in rows], pa.int64()), pa.array([v for _, v in rows], pa.list_(pa.int64()))],
                    ["node", "values"],
                )
            release()

        # The texts asked for are shuffled at any size, as they grow with the documents.
        near = marked(docs, "doc", marks(asked, "doc")).filter("hoptrail_marked")
        found = near.join(asked.hint("merge"), near["doc"].eqNullSafe(asked["doc"])).select("text", "nodes")
        return found.mapInArrow(whole, "node long, values array<long>").dropDuplicates(["node"])

    def _members(self, nodes: DataFrame) -> DataFrame:
        """(hub, node, n), written: of each family the members that another is near enough to in size."""
        lists = self._lists(nodes)
        hubs = materialize(
            lists.groupBy("value")
            .agg(F.max(F.struct("shared", "node")).alias("hub"), F.count(F.lit(1)).alias("held"))
            .filter("held > 1")
            .select("value", F.col("hub.node").alias("hub"))
        )
        # The nearest in size are the neighbours by size.
        by_size, n = Window.partitionBy("hub").orderBy("n"), F.col("n")
        fits = (F.lag("n").over(by_size) * self.den >= n * self.num) | (n * self.den >= F.lead("n").over(by_size) * self.num)
        members = lists.join(hubs, "value").select("hub", "node", "n").distinct().withColumn("fits", fits)
        found = materialize(members.filter("fits").drop("fits"))
        discard(lists, hubs)
        return found

    def _labels(self, docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
        num, den = self.num, self.den
        members = self._members(nodes)
        # Dealt out before the sketches join, and only sketches of members do.
        dealt = _in_blocks(members, F.least("n", F.lit(K)))
        sketches = marked(nodes.drop("n"), "node", marks(members, "node")).filter("hoptrail_marked").drop("hoptrail_marked")

        def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in _groups(batches, ["hub", "low", "high"]):
                a, b = _sides(table)
                if not len(a) or not len(b):
                    continue
                n, held, node = table.column("n").to_numpy(), _arrays(table, "sketch"), table.column("node").to_numpy()
                ok = _may_be_similar(n[a], [held[i] for i in a], n[b], [held[i] for i in b], num, den)
                ok &= node[a][:, None] != node[b][None]
                found = np.union1d(node[a][ok.any(1)], node[b][ok.any(0)])
                hub = np.full(len(found), table.column("hub")[0].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(hub), pa.array(found)], ["hub", "node"])
            release()

        open_ = materialize(_meet(dealt.join(sketches, "node"), may, "hub long, node long").distinct())
        discard(members, nodes)
        family = materialize(open_.join(self._sets(docs, open_.select("node").distinct(), width), "node"))
        discard(open_)

        def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in _groups(batches, ["hub", "low", "high"]):
                if "side" in table.column_names:
                    side = table.column("side").to_numpy()
                    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                else:
                    a, b = _sides(table)
                if not len(a) or not len(b):
                    continue
                held, node = _arrays(table, "values"), table.column("node").to_numpy()
                both = common([held[i] for i in a], [held[i] for i in b])
                n = np.array([len(x) for x in held])
                similar = both * den >= (n[a][:, None] + n[b][None] - both) * num
                x, y = _forest(node[a], node[b], similar)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])
            release()

        edges = "a long, b long"
        at_hub, others = family.filter("hub = node"), family.filter("hub <> node")
        star = materialize(_meet_two(at_hub, others, "values", link, edges).distinct())
        linked = star.select(F.col("a").alias("hub"), F.col("b").alias("node"))
        rest = materialize(others.join(linked, ["hub", "node"], "left_anti"))
        joined = others.join(linked, ["hub", "node"], "left_semi").join(rest.select("hub").distinct(), "hub", "left_semi")
        among = _meet(_in_blocks(rest, F.size("values")), link, edges)
        across = _meet_two(rest, joined, "values", link, edges)
        self.links = materialize(star.unionByName(among).unionByName(across).distinct())
        discard(family, rest)
        return components(self.links)

    def groups(self) -> DataFrame:
        """(doc, n_shingles, component_id, kept) for every row; the id is the group's least key."""
        least = self.rows.filter("n > 0").groupBy("node").agg(F.min("doc").alias("least"))
        named = materialize(
            least.join(self.labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        )
        names = materialize(named.groupBy("component").agg(F.min("least").alias("component_id")))
        of_node = materialize(named.join(names, "component").select("node", "component_id"))
        discard(named, names)
        # Empty sets have no node; what stands for it spreads them over the join.
        own = self.rows.select(
            "doc", "n", F.when(F.col("n") > 0, F.col("node")).otherwise(F.xxhash64("doc")).alias("node")
        )
        found = own.join(of_node, "node", "left")
        name = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc"))
        return found.select(
            "doc", F.col("n").alias("n_shingles"), name.alias("component_id"), F.col("doc").eqNullSafe(name).alias("kept")
        )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` without near copies: of each group the row of the least key.

    Groups of rows without a key keep one row of each of their texts, and rows of one key and
    text count as one. Documents without words stay.
    """
    found = NearCopies(docs, key, text, **options)
    dropped = materialize(found.groups().groupBy("doc").agg(F.max("kept").alias("kept")).filter("NOT kept").select("doc"))
    # Texts whose key is surely kept aren't shuffled.
    near = marked(docs.withColumn("hoptrail_key", F.col(f"`{key}`")), "hoptrail_key", marks(dropped, "doc"))
    asked = near.filter("hoptrail_marked").join(dropped, F.col("hoptrail_key").eqNullSafe(dropped["doc"]), "left_anti")
    out = near.filter("NOT hoptrail_marked").unionByName(asked).drop("hoptrail_key", "hoptrail_marked")
    # Only repeated keys need the rows' texts to be compared.
    repeated = not found.rows.groupBy("doc").count().filter("count > 1").isEmpty()
    discard(found.rows, found.links, found.labels)
    return out.dropDuplicates([key, text]) if repeated else out
