"""Prefix trie of conversations, built around a skeleton of splitter paths.

A conversation's path is the digests of its turns, joined; a node of the trie is a prefix. Paths
are dealt out by range, copies of a path further by id, so that a shard holds a contiguous piece
of the sorted paths. A node that has members in several shards lies on the path of a splitter
between them: the trie of the splitters' paths, the skeleton, is broadcast, and each shard
finishes all other nodes while it walks its sorted paths with a stack. Of skeleton nodes it gives
partial aggregates, which are added up and completed along the skeleton. Texts are digested
where they are read; no text is shuffled, and a shard keeps but one path at a time.

The skeleton has at most `SKELETON` nodes: splitters are left out, evenly, while it has more
(shards then get larger, not wrong). Ids that end at a skeleton node are joined in pieces by the
shards, and the pieces are hashed in order as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail.llm.common import materialize

#: Hex digits of a turn's digest in a path: 128 bits.
DIGITS = 32
#: Conversations that a shard holds, about, and the most nodes that the broadcast skeleton has.
SHARD, SKELETON = 20_000, 1 << 20
#: Rows of a batch, and bytes of a piece of joined ids.
BATCH, PIECE = 10_000, 1 << 16
NO_ENDS = hashlib.sha256(b"").hexdigest()


def conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and `turns`, an array of (digest, code points) in order.

    Turns are ordered by `turn` (null first), then by role and by the digest of the text; null
    roles and texts are empty. Rows without a conv_id belong to none. A turn counts some 40 bytes in
    its conversation's row.
    """
    text, role = (F.coalesce(F.col(c), F.lit("")) for c in ("text", "role"))
    mark = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    one = F.struct(
        F.col("turn").alias("turn"),
        role.alias("role"),
        F.substring(mark, 1, DIGITS).alias("mark"),
        F.char_length(text).cast("long").alias("points"),
    )
    return (
        turns.filter(F.col("conv_id").isNotNull())
        .groupBy(F.col("conv_id").cast("long").alias("conv_id"))
        .agg(F.array_sort(F.collect_list(one)).alias("turns"))
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["mark"], t["points"])).alias("turns"))
    )


def rebuilt(convs: DataFrame, family: int = 100, heads: int = 6) -> DataFrame:
    """Conversations that begin as the first of their family of `family` ids does.

    The first h turns are those of conversation `c - c % family` (all, if it has fewer; none, if
    there is no such conversation), and c's own follow from the h-th on; h = crc32(c) % `heads`.
    """
    c = F.col("conv_id")
    first = convs.filter(c % family == 0).select(
        F.col("conv_id").alias("family"), F.slice("turns", 1, heads - 1).alias("head")
    )
    h = (F.crc32(c.cast("string").cast("binary")) % heads).cast("int")
    return (
        convs.select("conv_id", "turns", (c - c % family).alias("family"), h.alias("h"))
        .join(first, "family", "left")
        .select(
            "conv_id",
            F.concat(
                F.coalesce(F.expr("slice(head, 1, h)"), F.expr("slice(turns, 1, 0)")),
                F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))"),
            ).alias("turns"),
        )
    )


def _path(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: t["mark"]), "")


def common(a: str, b: str) -> int:
    """How many turns two paths begin with alike."""
    low, high = 0, min(len(a), len(b)) // DIGITS
    if a[: high * DIGITS] == b[: high * DIGITS]:
        return high
    while low + 1 < high:
        middle = (low + high) // 2
        if a[low * DIGITS : middle * DIGITS] == b[low * DIGITS : middle * DIGITS]:
            low = middle
        else:
            high = middle
    return low


@dataclass
class Skeleton:
    """The trie of the splitters' paths, which are sorted.

    A node is named by the number of the first splitter on whose path it lies, and its depth.
    `shared[i]` says how many turns splitter i begins with like the one before it.
    """

    paths: list[str]
    shared: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.shared = [common(a, b) for a, b in zip(["", *self.paths], self.paths, strict=False)]
        #: Per splitter: (first depth, number of the splitter that names the nodes from there on), ascending.
        self.owners: list[list[tuple[int, int]]] = []
        for i, depth in enumerate(self.shared):
            kept = list(takewhile(lambda x, d=depth: x[0] <= d, self.owners[-1])) if i else []
            self.owners.append([*kept, (depth + 1 if i else 0, i)])

    def name(self, splitter: int, depth: int) -> tuple[int, int]:
        for first, owner in reversed(self.owners[splitter]):
            if first <= depth:
                return owner, depth
        raise IndexError(depth)

    def nodes(self) -> Iterator[tuple[int, int]]:
        """All nodes, parents first."""
        for i, path in enumerate(self.paths):
            yield from ((i, d) for d in range(self.shared[i] + 1 if i else 0, len(path) // DIGITS + 1))

    def parent(self, node: tuple[int, int]) -> tuple[int, int] | None:
        splitter, depth = node
        return self.name(splitter, depth - 1) if depth else None

    def on(self, path: str, shard: int) -> tuple[int, int]:
        """How deep a path of `shard` runs along the skeleton, and along which splitter.

        Only the splitters at a shard's two ends can tell: paths that begin alike are neighbours.
        """
        ends = [i for i in (shard - 1, shard) if 0 <= i < len(self.paths)]
        return max(((common(path, self.paths[i]), i) for i in ends), default=(0, 0))


def thinned(paths: list[str], most: int = SKELETON) -> list[int]:
    """Numbers of the splitters that stay: every one, every second, ... until the skeleton fits."""
    step = 1
    while sum(len(paths[i]) // DIGITS + 1 for i in range(0, len(paths), step)) > most and step < len(paths):
        step *= 2
    kept = list(range(0, len(paths), step))
    return kept if sum(len(paths[i]) // DIGITS + 1 for i in kept) <= most else []


@dataclass
class Node:
    """An open node: what is known of it from the members seen."""

    depth: int
    points: int
    least: int
    members: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: object = None
    piece: list[str] = field(default_factory=list)
    #: Whether the node or all that a skeleton needs to know of it is final when it is closed.
    name: tuple[int, int] | None = None


FINISHED = "conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: `owner` and `level` name a skeleton node: the row's own for partial rows, its parent for a finished
#: child of one. `above` is the least id of a parent off the skeleton.
WALKED = f"{FINISHED}, partial boolean, owner int, level int, above long, points long, shard int, seq long, ids string"


class Walk:
    """Walks the sorted paths of shards and yields rows of WALKED."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton, self.rows = skeleton, []
        self.shard, self.last, self.stack, self.seq = None, "", [], 0
        #: Finished nodes whose open parent isn't in the skeleton, by the parent's depth.
        self.waiting: dict[int, list[dict]] = {}

    def _row(self, node: Node, **more: object) -> dict:
        ends = node.ends.hexdigest() if node.ends else NO_ENDS
        row = {
            "conv_id": node.least, "depth": node.depth, "n_convs": node.members, "n_children": node.children,
            "n_leaves": node.leaves, "saved_tokens": node.saved, "ends_sha256": ends, "partial": False,
            "owner": None, "level": None, "above": None, "points": node.points, "shard": self.shard, "seq": None, "ids": None,
        }
        return row | more

    def _ids(self, node: Node) -> None:
        """A piece of the ids that end at a skeleton node, so far."""
        self.seq += 1
        empty = Node(node.depth, node.points, node.least)
        self.rows.append(
            self._row(empty, partial=True, owner=node.name[0], level=node.name[1], seq=self.seq, ids=",".join(node.piece))
        )
        node.piece = []

    def _close(self, depth: int) -> None:
        """Close the open nodes deeper than `depth`."""
        while self.stack and self.stack[-1].depth > depth:
            node = self.stack.pop()
            above = self.stack[-1] if self.stack else None
            if above:
                above.members += node.members
                above.least = min(above.least, node.least)
            if node.name:
                if node.piece:
                    self._ids(node)
                self.rows.append(self._row(node, partial=True, owner=node.name[0], level=node.name[1]))
                continue
            if not node.children:
                node.leaves = 1
            node.saved += (node.members - 1) * node.points
            for row in self.waiting.pop(node.depth, ()):
                self.rows.append(row | {"above": node.least})
            if above.name:
                self.rows.append(self._row(node, owner=above.name[0], level=above.name[1]))
            else:
                # The parent's least id isn't known yet.
                self.waiting.setdefault(above.depth, []).append(self._row(node))
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved

    def finish(self) -> None:
        self._close(-1)

    def add(self, shard: int, conv: int, path: str, points: list[int]) -> None:
        if shard != self.shard:
            self.finish()
            self.shard, self.last = shard, ""
        alike = common(path, self.last) if self.stack else -1
        self._close(alike)
        if len(path) // DIGITS > alike:
            along, splitter = self.skeleton.on(path, shard)
            for depth in range(alike + 1, len(path) // DIGITS + 1):
                node = Node(depth, points[depth - 1] if depth else 0, conv)
                # The root is in the skeleton even if there is no splitter.
                if depth <= along:
                    node.name = self.skeleton.name(splitter, depth) if self.skeleton.paths else (0, 0)
                self.stack.append(node)
        top = self.stack[-1]
        top.members += 1
        top.least = min(top.least, conv)
        if top.name:
            top.piece.append(str(conv))
            if len(top.piece) * 12 > PIECE:
                self._ids(top)
        elif top.ends is None:
            top.ends = hashlib.sha256(str(conv).encode())
        else:
            top.ends.update(f",{conv}".encode())
        self.last = path

    def taken(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        """The rows so far, if there are `least` of them."""
        if self.rows and len(self.rows) >= least:
            rows, self.rows = self.rows, []
            for i in range(0, len(rows), BATCH):
                yield pa.RecordBatch.from_pylist(rows[i : i + BATCH], _arrow(WALKED))


class Trie:
    """The trie of `paths` (conv_id, turns)."""

    def __init__(self, convs: DataFrame, shard: int = SHARD, skeleton: int = SKELETON):
        self.spark = convs.sparkSession
        flat = materialize(convs.select("conv_id", _path(F.col("turns")).alias("path"), F.col("turns.points").alias("points")))
        order = ["path", "conv_id"]
        dealt_into = max(1, -(-flat.count() // shard))
        dealt = materialize(flat.repartitionByRange(dealt_into, *order).withColumn("range", F.spark_partition_id()))
        # The first path of every range but the first is a splitter.
        least = dealt.groupBy("range").agg(F.min(F.struct(*order)).alias("at"))
        ranges = least.orderBy("range").select("range", "at.path").collect()
        kept = thinned([r["path"] for r in ranges[1:]], skeleton)
        self.skeleton = Skeleton([ranges[i + 1]["path"] for i in kept])
        # Ranges between splitters that were left out are one shard.
        starts, numbers, n = {ranges[i + 1]["range"] for i in kept}, [], 0
        for r in ranges:
            n += r["range"] in starts
            numbers.append((r["range"], n))
        self.parts = n + 1
        numbered = self.spark.createDataFrame(numbers, "range int, shard int")
        self.paths = dealt.join(F.broadcast(numbered), "range").drop("range")

    def _walked(self) -> DataFrame:
        shared = self.spark.sparkContext.broadcast(self.skeleton)

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state = Walk(shared.value)
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "conv_id", "path", "points")), strict=True):
                    state.add(*row)
                    yield from state.taken(BATCH)
            state.finish()
            yield from state.taken()

        return (
            self.paths.repartition(self.parts, "shard")
            .sortWithinPartitions("shard", "path", "conv_id")
            .mapInArrow(walk, WALKED)
        )

    def nodes(self) -> DataFrame:
        """All nodes: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves,
        saved_tokens, ends_sha256. Without conversations there is none, not even the root."""
        walked = materialize(self._walked())
        name = ["owner", "level"]
        partial = walked.filter("partial")
        summed = partial.groupBy(*name).agg(
            *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
            F.min("conv_id").alias("conv_id"),
            F.max("points").alias("points"),
        )
        digests = (
            partial.filter(F.col("ids").isNotNull())
            .select(*name, "shard", "seq", "ids")
            .repartition(*name)
            .sortWithinPartitions(*name, "shard", "seq")
            .mapInArrow(_hash_pieces, "owner int, level int, ends_sha256 string")
        )
        skeleton = materialize(self._completed(summed).join(digests, name, "left"))
        own = [c.split()[0] for c in FINISHED.split(", ")]
        top = skeleton.select(
            *(F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias(c) if c == "ends_sha256" else F.col(c) for c in own),
            "parent_conv_id",
        )
        parents = skeleton.select(*name, F.col("conv_id").alias("parent"))
        rest = (
            walked.filter("NOT partial")
            .join(F.broadcast(parents), name, "left")  # no more rows than the skeleton has nodes
            .select(*own, F.coalesce("above", "parent").alias("parent_conv_id"))
        )
        columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        return top.unionByName(rest).select(*columns)

    def _completed(self, summed: DataFrame) -> DataFrame:
        """What skeleton nodes add to each other: a pass over the skeleton, children first."""
        shared = self.spark.sparkContext.broadcast(self.skeleton)
        schema = _arrow(COMPLETED)

        def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = {(r["owner"], r["level"]): r for batch in batches for r in batch.to_pylist()}
            trie = shared.value
            names = list(trie.nodes()) if trie.paths else sorted(rows)
            for node in reversed(names):
                row, up = rows[node], trie.parent(node) if trie.paths else None
                row["depth"] = node[1]
                row["n_leaves"] = row["n_leaves"] if row["n_children"] else 1
                row["saved_tokens"] += (row["n_convs"] - 1) * row["points"]
                row["parent_conv_id"] = rows[up]["conv_id"] if up else None
                if up:
                    above = rows[up]
                    above["n_children"] += 1
                    above["n_leaves"] += row["n_leaves"]
                    above["saved_tokens"] += row["saved_tokens"]
            found = [rows[node] for node in names if node in rows]
            for i in range(0, len(found), BATCH):
                yield pa.RecordBatch.from_pylist([{c: r[c] for c in schema.names} for r in found[i : i + BATCH]], schema)

        return summed.coalesce(1).mapInArrow(complete, COMPLETED)


COMPLETED = "owner int, level int, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, parent_conv_id long"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _hash_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash the pieces of each node, joined by commas; they come sorted by node and place."""
    schema = _arrow("owner int, level int, ends_sha256 string")
    name, state = None, None
    for batch in batches:
        for owner, level, ids in zip(*(batch.column(c).to_pylist() for c in ("owner", "level", "ids")), strict=True):
            if (owner, level) == name:
                state.update(f",{ids}".encode())
                continue
            if name:
                yield pa.RecordBatch.from_pylist([{"owner": name[0], "level": name[1], "ends_sha256": state.hexdigest()}], schema)
            name, state = (owner, level), hashlib.sha256(ids.encode())
    if name:
        yield pa.RecordBatch.from_pylist([{"owner": name[0], "level": name[1], "ends_sha256": state.hexdigest()}], schema)
