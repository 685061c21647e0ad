"""Merkle manifest of a dataset, with proofs by octopus multiproofs.

Every row is a leaf. The leaves of a group, in the order of their key, form a tree in which up to
`FAN` consecutive nodes have one parent; the roots of the groups, in the order of the group,
form the top tree in the same way.

Leaves are dealt out by range, so a *run* is a contiguous piece of one group's leaves with
whatever boundaries the data has. Each run reports the nodes that are whole within it, as few
as cover it; nodes that straddle runs are made from those, several levels at a time. For the
proofs of all its leaves a run then needs but the nodes beside its own paths: the union of these
coordinates, without those that it can derive, is at most `2 * (FAN - 1)` a level. They are
fetched by one join; shared interior nodes are derived once, and every leaf's own proof is
expanded from them on the spot. No text is shuffled, and no task holds more than a run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoptrail.llm.common import lower_ascii, materialize

FAN = 8
#: Leaves that a range of the deal holds, about.
RUN = 50_000
#: Levels that one grouping builds: a group has at most FAN ** STEP nodes of its lowest level.
STEP = 4
#: Every how many documents (by crc32 of the key) are tampered with, to try out the proofs.
TAMPERED = 3


def joined_hash(digests: Iterable[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def level_sizes(n: int) -> list[int]:
    """Nodes per level of a tree of `n` leaves, from the leaves to the root."""
    sizes = [n]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // FAN))
    return sizes


def missing(places: Iterable[int], n: int) -> list[tuple[int, int]]:
    """The (level, place) of the fewest nodes that, with the leaves at `places`, give the root.

    A node is missing if it is beside the path of one of the leaves and on none's.
    """
    found, own = [], set(places)
    for level, size in enumerate(level_sizes(n)[:-1]):
        above = {p // FAN for p in own}
        for p in sorted(above):
            found += [(level, q) for q in range(p * FAN, min(size, p * FAN + FAN)) if q not in own]
        own = above
    return found


class Octopus:
    """A run of leaves `first`, `first + 1`, ... of a tree of `n`, with the nodes fetched for it."""

    def __init__(self, first: int, leaves: list[str], n: int, fetched: dict[tuple[int, int], str]):
        self.first = first
        #: By level: the place of the first known node, and the nodes from there on.
        self.levels: list[tuple[int, list[str]]] = []
        start, nodes = first, leaves
        for level, size in enumerate(level_sizes(n)):
            left, right = start, start + len(nodes)
            if size > 1:
                lowest, end = left // FAN * FAN, min(size, -(-right // FAN) * FAN)
                before = [fetched[level, p] for p in range(lowest, left)]
                after = [fetched[level, p] for p in range(right, end)]
                start, nodes = lowest, before + nodes + after
            self.levels.append((start, nodes))
            start, nodes = start // FAN, [joined_hash(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]

    @property
    def root(self) -> str:
        return self.levels[-1][1][0]

    def proof(self, place: int, height: int | None = None) -> list[tuple[list[str], list[str]]]:
        """The siblings to the left and right, level by level (of the lowest `height` levels)."""
        out = []
        for start, nodes in self.levels[:-1][:height]:
            at, here = place - start, (place - start) // FAN * FAN
            out.append((nodes[here:at], nodes[at + 1 : here + FAN]))
            place //= FAN
        return out


def fold(leaf: str, proof: Iterable[tuple[list[str], list[str]]]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in proof:
        leaf = joined_hash([*left, leaf, *right])
    return leaf


def whole_nodes(first: int, leaves: list[str], n: int) -> Iterator[tuple[int, int, str]]:
    """The fewest (level, place, digest) that cover a run with nodes whole within it."""
    start, nodes = first, leaves
    for level, size in enumerate(level_sizes(n)):
        end = start + len(nodes)
        low = -(-start // FAN)
        high = end // FAN if end < size else -(-size // FAN)
        if size == 1 or low >= high:
            yield from ((level, start + i, node) for i, node in enumerate(nodes))
            return
        inner, last = low * FAN - start, min(high * FAN, size) - start
        for i in (*range(inner), *range(last, len(nodes))):
            yield level, start + i, nodes[i]
        start, nodes = low, [joined_hash(nodes[i : min(i + FAN, last)]) for i in range(inner, last, FAN)]


def field(value: Column) -> Column:
    """`-` for null, else the count of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def tree_key(group: Column) -> Column:
    """A text that sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


@dataclass
class Forest:
    """Trees over `leaves` (tree, key, leaf, and columns that are carried along).

    `rows` has the leaves with their run, place in the tree and size of the tree; `nodes` the
    nodes from which each run's missing ones are fetched; `roots` one row per tree.
    """

    rows: DataFrame
    runs: DataFrame
    nodes: DataFrame
    roots: DataFrame


def plant(leaves: DataFrame, run: int = RUN) -> Forest:
    """Deal `leaves` out by (tree, key, leaf) and build the trees.

    Rows with the same key are ordered by their leaf; those with the same leaf too are
    alike and may change places.
    """
    # Equal rows must be divisible too, so that a row repeated very often is dealt out.
    salted = leaves.withColumn("salt", F.monotonically_increasing_id())
    parts = max(1, -(-leaves.count() // run))
    order = ["tree", "key", "leaf", "salt"]
    dealt = salted.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = materialize(dealt.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)).drop("salt"))

    # One row per run: a few for each range of the deal.
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = materialize(
        rows.groupBy("tree", "part")
        .agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("n"))
        .withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("size", F.sum("n").over(Window.partitionBy("tree")))
    )
    rows = rows.join(runs.select("tree", "part", "first_at", "first", "size"), ["tree", "part"])
    rows = rows.withColumn("place", F.col("first") + F.col("at") - F.col("first_at")).drop("at", "first_at")

    def cover(run: pa.Table) -> pa.Table:
        run = run.sort_by("place")
        tree, part = run["tree"][0].as_py(), run["part"][0].as_py()
        found = list(whole_nodes(run["first"][0].as_py(), run["leaf"].to_pylist(), run["size"][0].as_py()))
        return _node_table(tree, part, run["size"][0].as_py(), found)

    covered = materialize(rows.select("tree", "part", "first", "size", "place", "leaf").groupBy("tree", "part").applyInArrow(cover, NODES))
    made, height = [covered], len(level_sizes(runs.agg(F.max("size")).first()[0] or 1))
    # Nodes that straddle runs: every pass builds STEP levels from what is known of the lowest.
    for low in range(0, height - 1, STEP):
        known = made[0].unionByName(made[-1]) if len(made) > 1 else covered
        made.append(materialize(_straddling(known, low)))
    nodes = covered
    for more in made[1:]:
        nodes = nodes.unionByName(more)
    return Forest(rows, runs, nodes, nodes.groupBy("tree").agg(F.max_by("digest", "level").alias("root")))


NODES = "tree string, part long, size long, level int, place long, digest string"
_NODE_SCHEMA = pa.schema(
    [("tree", pa.string()), ("part", pa.int64()), ("size", pa.int64()), ("level", pa.int32()), ("place", pa.int64()), ("digest", pa.string())]
)


def _node_table(tree: str, part: int, size: int, found: list[tuple[int, int, str]]) -> pa.Table:
    n = len(found)
    return pa.table(
        [pa.array(x, t) for x, t in zip(([tree] * n, [part] * n, [size] * n, *([f[i] for f in found] for i in range(3))), _NODE_SCHEMA.types, strict=True)],
        schema=_NODE_SCHEMA,
    )


def _straddling(known: DataFrame, low: int) -> DataFrame:
    """Nodes of the STEP levels above `low` that are in no run whole.

    A group is what is known below one node of level `low + STEP`; nothing is lacking
    below a node that no run holds whole, so a parent with all its children known is made.
    """
    span = F.lit(FAN).cast("double")
    below = known.filter(F.col("level").between(low, low + STEP - 1) & (F.col("size") > 1))
    above = F.floor(F.col("place") / F.pow(span, F.lit(low + STEP) - F.col("level")))

    def build(group: pa.Table) -> pa.Table:
        tree, size = group["tree"][0].as_py(), group["size"][0].as_py()
        held: dict[int, dict[int, str]] = {}
        for level, place, digest in zip(*(group[c].to_pylist() for c in ("level", "place", "digest")), strict=True):
            held.setdefault(level, {})[place] = digest
        found, sizes = [], level_sizes(size)
        for level in range(low, min(low + STEP, len(sizes) - 1)):
            own = held.get(level, {})
            for parent in sorted({p // FAN for p in own}):
                children = [own[p] for p in range(parent * FAN, min(sizes[level], parent * FAN + FAN))]
                digest = joined_hash(children)
                held.setdefault(level + 1, {})[parent] = digest
                found.append((level + 1, parent, digest))
        return _node_table(tree, -1, size, found)

    return below.withColumn("above", above).groupBy("tree", "above").applyInArrow(build, NODES)


def fetched(forest: Forest) -> DataFrame:
    """The missing nodes of every run: tree, part, and an array of (level, place, digest)."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for tree, part, first, n, size in zip(*(batch.column(c).to_pylist() for c in ("tree", "part", "first", "n", "size")), strict=True):
                for level, place in edges(first, n, size):
                    for column, value in zip(out, (tree, part, level, place), strict=True):
                        column.append(value)
            types = (pa.string(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], ["tree", "part", "level", "place"])

    asked = forest.runs.select("tree", "part", "first", "n", "size").mapInArrow(ask, "tree string, part long, level int, place long")
    nodes = forest.nodes.select("tree", "level", "place", "digest")
    return asked.join(nodes, ["tree", "level", "place"]).groupBy("tree", "part").agg(
        F.collect_list(F.struct("level", "place", "digest")).alias("fetched")
    )


def edges(first: int, n: int, size: int) -> Iterator[tuple[int, int]]:
    """`missing` of a contiguous run, without listing its leaves."""
    left, right = first, first + n
    for level, total in enumerate(level_sizes(size)[:-1]):
        lowest, end = left // FAN * FAN, min(total, -(-right // FAN) * FAN)
        yield from ((level, p) for p in (*range(lowest, left), *range(right, end)))
        left, right = lowest // FAN, -(-end // FAN)


def _octopus(run: pa.Table, got: pa.Table) -> Octopus:
    known = {(x["level"], x["place"]): x["digest"] for x in (got["fetched"][0].as_py() if got.num_rows else ())}
    return Octopus(run["first"][0].as_py(), run["leaf"].to_pylist(), run["size"][0].as_py(), known)


def prove(forest: Forest) -> DataFrame:
    """Each leaf's proof as it stands: tree, key, leaf, root, and `proof`, an array by level of
    the siblings to the left and to the right."""

    def expand(run: pa.Table, got: pa.Table) -> pa.Table:
        run = run.sort_by("place")
        tree = _octopus(run, got)
        proofs = [[{"left": a, "right": b} for a, b in tree.proof(p)] for p in run["place"].to_pylist()]
        return pa.table(
            [run["tree"], run["key"], run["leaf"], pa.array([tree.root] * len(proofs)), pa.array(proofs, PROOF_TYPE)],
            names=["tree", "key", "leaf", "root", "proof"],
        )

    kind = dict(forest.rows.dtypes)["key"]
    rows = forest.rows.select("tree", "part", "first", "size", "place", "key", "leaf")
    return (
        rows.groupBy("tree", "part")
        .cogroup(fetched(forest).groupBy("tree", "part"))
        .applyInArrow(expand, f"tree string, key {kind}, leaf string, root string, proof {PROOF}")
    )


PROOF = "array<struct<left: array<string>, right: array<string>>>"
PROOF_TYPE = pa.list_(pa.struct([("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))]))


def leaves_of(docs: DataFrame, columns: list[str], group: str, key: str) -> DataFrame:
    """One leaf a row: tree, key, leaf, and `changed`, the leaf after tampering (null if there is none).

    Tampering lower-cases A-Z of `text` where 3 divides the crc32 of the key; a null key is never
    tampered with. Columns other than `columns` don't count.
    """
    values = [F.col(f"`{c}`") for c in columns]
    low = [lower_ascii(v) if c == "text" else v for c, v in zip(columns, values, strict=True)]
    hit = F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % TAMPERED == 0
    return docs.select(
        tree_key(F.col(f"`{group}`")).alias("tree"),
        F.col(f"`{key}`").alias("key"),
        leaf(values).alias("leaf"),
        F.when(hit, leaf(low)).alias("changed"),
    )


def audit(
    docs: DataFrame,
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    key: str = "doc_id",
    run: int = RUN,
) -> DataFrame:
    """The manifest of `docs`, and what a verifier with tampered rows finds.

    Per row: `key`, leaf, subroot (of its group), root, `proof_sha256` (hash of all siblings
    joined, level by level up to the root), `tampered`, `folded_root` (from the tampered or else
    the original leaf and the original siblings) and `verified` (it equals the root). Rows without
    a group form a group of their own, the first; rows without a key come first in theirs; rows
    with the same key are ordered by their leaf. Repeated rows are leaves of their own. Of an
    empty table there is no row.
    """
    below = plant(materialize(leaves_of(docs, list(columns), group, key)), run)
    # The groups' roots are the leaves of the top tree.
    above = plant(
        below.roots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("root").alias("leaf")), run
    )
    top = prove(above).select(F.col("key").alias("tree"), F.col("root").alias("top"), F.col("proof").alias("top_proof"))
    # A run that lacks nothing has no row in `fetched`.
    heads = below.runs.select("tree", "part").join(fetched(below), ["tree", "part"], "left").join(top, "tree")

    def expand(run: pa.Table, head: pa.Table) -> pa.Table:
        run = run.sort_by("place")
        known = {(x["level"], x["place"]): x["digest"] for x in head["fetched"][0].as_py() or ()}
        tree = Octopus(run["first"][0].as_py(), run["leaf"].to_pylist(), run["size"][0].as_py(), known)
        beyond = [(x["left"], x["right"]) for x in head["top_proof"][0].as_py()]
        root, n = head["top"][0].as_py(), run.num_rows
        proofs, folded = [], []
        parent, shared, text = None, [], ""
        for place, own, changed in zip(*(run[c].to_pylist() for c in ("place", "leaf", "changed")), strict=True):
            path = tree.proof(place, 1)
            if place // FAN != parent:
                # What lies above the lowest level is the same for all leaves of a parent.
                parent, shared = place // FAN, tree.proof(place)[1:] + beyond
                text = "".join(digest for sides in shared for side in sides for digest in side)
            proofs.append(joined_hash([*(digest for sides in path for side in sides for digest in side), text]))
            folded.append(fold(changed or own, path + shared))
        return pa.table(
            [
                run["key"], run["leaf"], pa.array([tree.root] * n, pa.string()), pa.array([root] * n, pa.string()),
                pa.array(proofs, pa.string()), pa.array([c is not None for c in run["changed"].to_pylist()], pa.bool_()),
                pa.array(folded, pa.string()), pa.array([f == root for f in folded], pa.bool_()),
            ],
            names=[key, "leaf", "subroot", "root", "proof_sha256", "tampered", "folded_root", "verified"],
        )

    kind = dict(below.rows.dtypes)["key"]
    rows = below.rows.select("tree", "part", "first", "size", "place", "key", "leaf", "changed")
    return (
        rows.groupBy("tree", "part")
        .cogroup(heads.groupBy("tree", "part"))
        .applyInArrow(
            expand,
            f"`{key}` {kind}, leaf string, subroot string, root string, proof_sha256 string, "
            "tampered boolean, folded_root string, verified boolean",
        )
    )
