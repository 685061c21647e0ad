"""Nearest neighbours by adaptive scans of rotated dimensions within probed lists.

Vectors are dealt to the lists of their nearest centroids; a query probes the lists whose
centroids are nearest to it. All vectors are rotated by one random orthogonal matrix, after
which any `d` of the `D` coordinates estimate a distance. A query first measures the rows of its
nearest list; its k-th distance goes with it to the other lists. A list is scanned in blocks of
coordinates: after each block a candidate is abandoned if its partial distance, scaled to all
coordinates, exceeds the query's current k-th distance by more than chance allows. What is left
is measured in double precision on the original vectors and lowers the k-th distance.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoptrail.llm.common import discard, materialize

#: Coordinates of a block, and how many standard deviations a candidate may seem too far. The
#: share of a squared distance that `d` of `D` coordinates hold is beta distributed, so a nearer
#: row is abandoned after a block with a chance of some 0.3 %.
BLOCK = 16
DEVIATIONS = 3.0
#: Queries looked at together, coordinates of the pairs looked at together, and rows that a query
#: without a k-th distance looks at first.
TOGETHER, PAIRED, FIRST = 128, 1 << 22, 64
#: Bytes of rows and number of queries of a list that meet in one task; larger lists are split.
BYTES, QUERIES = 32 << 20, 2_000
#: Sampled vectors a centroid is fitted on, and sampled queries that the probes are chosen by.
PER_LIST, TRIALS = 40, 256


@dataclass
class Lists:
    """Scale, rotation and centroids (rotated), fitted on a bounded sample."""

    scale: float
    rotation: np.ndarray
    centroids: np.ndarray

    def rotate(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors * self.scale) @ self.rotation

    def distances(self, rotated: np.ndarray) -> np.ndarray:
        """Squared distance of each vector to each centroid."""
        square = (rotated**2).sum(1)[:, None] + (self.centroids**2).sum(1)[None]
        return square - 2 * rotated @ self.centroids.T


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vector): one row per id, without null, zero and non-finite vectors.

    Of rows with one id the least vector counts. Rows without an id take no part.
    """
    x = F.col("vector")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.select(F.col(f"`{key}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0))
    rows = rows.filter(~bad & F.exists(x, lambda c: c != 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _sample(rows: DataFrame, size: int, share: float, most: int) -> np.ndarray:
    """At most `most` different vectors, picked by a hash of their ids."""
    place = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    picked = rows.filter(place < share).orderBy(F.xxhash64("vec_id")).limit(most)
    return np.unique(_vectors(picked.select("vector").toArrow().column("vector").combine_chunks(), size), axis=0)


def fit(x: np.ndarray, lists: int, scale: float = 1.0, seed: int = 7) -> Lists:
    """Rotation by QR of a normal matrix; centroids by Lloyd's rounds over the sampled vectors."""
    rng = np.random.default_rng(seed)
    rotation, triangle = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))
    rotation *= np.sign(np.diag(triangle))
    found = Lists(scale, rotation, np.empty(0))
    x = found.rotate(x)
    found.centroids = x[rng.permutation(len(x))[: min(lists, len(x))]]
    for _ in range(10):
        near = found.distances(x).argmin(1)
        sums = np.zeros_like(found.centroids)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=len(sums))
        found.centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], found.centroids)
    return found


def probes_for(found: Lists, x: np.ndarray, k: int, recall: float) -> int:
    """How many lists hold the share `recall` of the k nearest of sampled queries among the sample.

    In the whole table neighbours are nearer than in a sample and so in nearer lists.
    """
    x = found.rotate(x)
    trials = np.random.default_rng(11).permutation(len(x))[:TRIALS]
    order = found.distances(x[trials]).argsort(1, kind="stable")
    turn = np.empty_like(order)
    np.put_along_axis(turn, order, np.arange(order.shape[1])[None].repeat(len(order), 0), 1)
    cells, squares = found.distances(x).argmin(1), (x**2).sum(1)
    needed = []
    for at, turns in zip(trials, turn, strict=True):
        far = squares - 2 * x @ x[at]
        far[at] = math.inf
        nearest = np.argpartition(far, min(k, len(x) - 1))[: min(k, len(x) - 1)]
        needed.append(turns[cells[nearest]])
    turns = np.sort(np.concatenate(needed)) if needed else np.empty(0, np.int64)
    return int(turns[math.ceil(recall * len(turns)) - 1]) + 1 if len(turns) else 1


class Found(NamedTuple):
    """Places of queries and rows, their distances, and how many pairs were measured whole."""

    query: np.ndarray
    row: np.ndarray
    distance: np.ndarray
    measured: int


def scan(rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, limits: np.ndarray, k: int, exact) -> Found:
    """Each rotated query's k nearest of a list's rotated rows, if nearer than its limit or as near.

    `exact` gives the distances between the rows and queries at given places in the original
    vectors, on the scale of `rows`; ties go to the smaller id. A row with a query's own id isn't
    its candidate.
    """
    size, n = rows.shape[1], len(rows)
    chunk = int(np.clip(PAIRED // (TOGETHER * size), FIRST, 1024))
    out, measured = [], 0
    for low in range(0, len(queries), TOGETHER):
        q, mine, limit = queries[low : low + TOGETHER], own[low : low + TOGETHER], limits[low : low + TOGETHER] ** 2
        best = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        first = 0
        while first < n:
            last = min(n, first + (chunk if np.isfinite(limit).all() else FIRST))
            b = min(BLOCK, size)
            gap = q[:, None, :b] - rows[None, first:last, :b]
            partial = np.einsum("ijk,ijk->ij", gap, gap)
            stay = (partial <= limit[:, None] * _slack(b, size)) & (mine[:, None] != ids[None, first:last])
            i, j = np.nonzero(stay)
            partial, j = partial[stay], j + first
            while b < size and len(i):
                a, b = b, min(b + BLOCK, size)
                gap = q[i, a:b] - rows[j, a:b]
                partial = partial + np.einsum("ij,ij->i", gap, gap)
                stay = partial <= limit[i] * _slack(b, size)
                i, j, partial = i[stay], j[stay], partial[stay]
            first = last
            if not len(i):
                continue
            measured += len(i)
            i, j, far = (np.concatenate(p) for p in zip(best, (i, j, exact(j, low + i)), strict=True))
            order = np.lexsort((ids[j], far, i))
            i, j, far = i[order], j[order], far[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            kth = rank == k - 1
            limit[i[kth]] = np.minimum(limit[i[kth]], far[kth] ** 2)
            best = i[rank < k], j[rank < k], far[rank < k]
        out.append((low + best[0], *best[1:]))
    return Found(*(np.concatenate(p) for p in zip(*out, strict=True)), measured)


def _slack(done: int, size: int) -> float:
    """The largest part of a squared distance that `done` of `size` coordinates hold but for chance."""
    if done == size:
        return 1 + 1e-9
    return done / size * (1 + DEVIATIONS * math.sqrt(2 * (size - done) / (done * (size + 2))))


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance row by row, also where squares leave the range of doubles."""
    gap = np.abs(a - b)
    with np.errstate(over="ignore"):
        far = np.sqrt((gap**2).sum(1))
    odd = (far > 1e150) | (far < 1e-150)
    if odd.any():
        top = np.maximum(gap[odd].max(1), np.finfo(float).tiny)
        far[odd] = top * np.sqrt(((gap[odd] / top[:, None]) ** 2).sum(1))
    return far


def search(
    df: DataFrame,
    queries: DataFrame,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    lists: int | None = None,
    probes: int | None = None,
    recall: float = 0.98,
    sample: int = 20_000,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's `k` nearest rows found, nearest first.

    `queries` has the same columns as `df`. The score is the Euclidean distance; ties go to the
    smaller id; a row with the query's own id is no candidate. A query gets fewer than `k` rows
    only if there are fewer candidates: it probes its nearest `probes` lists and then as many
    more as hold `k` others. Null, zero and non-finite vectors and those of another length
    than most take no part; empty tables give an empty result.

    Without `lists` there are about as many as the square root of the rows, at most one per
    `PER_LIST` sampled vectors, and half as many as long as the probing queries, one copy a
    list, would outnumber the rows. Without `probes` their number is that which finds the share
    `recall` of the nearest within the sample of at most about `sample` vectors. Lists of over
    `BYTES` or `QUERIES` queries are split over tasks.
    """
    spark = df.sparkSession
    key_type = df.schema[key].dataType.simpleString()
    rows, asked = materialize(usable(df, key, vector)), materialize(usable(queries, key, vector))
    schema = f"query_id {key_type}, rank int, vec_id {key_type}, score double"
    top = F.max(F.greatest(F.array_max("vector"), -F.array_min("vector")))
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("count"), top.alias("top"))
    common = sizes.orderBy(F.desc("count"), "size").first()
    if common is None:
        return spark.createDataFrame([], schema)
    size, total = common["size"], common["count"]
    # Squares of numbers beyond these would leave the range of doubles.
    scale = 1.0 if 1e-100 < common["top"] < 1e100 else 2.0 ** float(np.clip(-math.frexp(common["top"])[1], -1000, 1000))
    rows, asked = (x.filter(F.size("vector") == size) for x in (rows, asked))
    sampled = _sample(rows, size, min(1.0, sample / total), 2 * sample)
    n_asked = asked.count()
    wide = lists or max(1, min(round(math.sqrt(total)), len(sampled) // PER_LIST))
    while True:
        fitted = fit(sampled, wide, scale)
        near = probes or probes_for(fitted, sampled, k, recall)
        if lists or wide == 1 or near * n_asked <= total:
            break
        wide //= 2
    lists, probes = len(fitted.centroids), near
    shared = spark.sparkContext.broadcast(fitted)

    def deal(batches):
        for batch in batches:
            x = _vectors(batch.column("vector"), size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("vector"),
                    pa.array(shared.value.distances(shared.value.rotate(x)).argmin(1).astype(np.int32)),
                ],
                ["vec_id", "vector", "cell"],
            )

    kind = f"vec_id {key_type}, vector {df.schema[vector].dataType.simpleString()}"
    dealt = materialize(rows.mapInArrow(deal, f"{kind}, cell int"))
    discard(rows)
    # At most `lists` rows.
    held = {r["cell"]: r["count"] for r in dealt.groupBy("cell").count().collect()}
    counts = np.array([held.get(c, 0) for c in range(lists)], np.int64)

    row_parts = {c: -(-n * size * 8 // BYTES) for c, n in held.items()}

    def round_of(asked: DataFrame, seeding: bool) -> DataFrame:
        """(query_id, vec_id, score): what queries (vec_id, vector, limit) find in their nearest lists
        that hold `k` rows beside their own, or in the others that they probe."""

        def probe(batches):
            for batch in batches:
                x = shared.value.rotate(_vectors(batch.column("vector"), size))
                order = shared.value.distances(x).argsort(1, kind="stable")
                seeds = np.cumsum(counts[order], 1) - counts[order] <= k
                others = np.arange(order.shape[1])[None] < probes
                query, at = np.nonzero((seeds if seeding else others & ~seeds) & (counts[order] > 0))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(query)) for c in ("vec_id", "vector", "limit")), pa.array(order[query, at].astype(np.int32))],
                    ["vec_id", "vector", "limit", "cell"],
                )

        # Not written: a query's copies are dealt out anew rather than kept.
        probing = asked.mapInArrow(probe, f"{kind}, limit double, cell int")
        wanted = {r["cell"]: r["count"] for r in probing.groupBy("cell").count().collect()}
        query_parts = {c: -(-n // QUERIES) for c, n in wanted.items()}

        def blocks(frame: DataFrame, own: dict[int, int], other: dict[int, int], mine: str, theirs: str) -> DataFrame:
            """Deal a frame's rows over its list's parts, and copy them to each of the others' parts."""
            parts = lambda of: F.coalesce(F.create_map(*(F.lit(x) for p in of.items() for x in p))[F.col("cell")], F.lit(1)) if of else F.lit(1)
            part = F.pmod(F.xxhash64("vec_id"), parts(own)).cast("int")
            return frame.select("*", part.alias(mine), F.explode(F.sequence(F.lit(0), parts(other) - 1)).alias(theirs))

        keys = ["cell", "row_part", "query_part"]
        visited = dealt.filter(F.col("cell").isin(list(wanted))) if len(wanted) < len(held) else dealt
        left = blocks(visited, row_parts, query_parts, "row_part", "query_part")
        right = blocks(probing, query_parts, row_parts, "query_part", "row_part")
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, f"query_id {key_type}, vec_id {key_type}, score double")

    def meet(rows: pa.Table, asked: pa.Table) -> pa.Table:
        types = asked.schema.field("vec_id").type, rows.schema.field("vec_id").type, pa.float64()
        names = ["query_id", "vec_id", "score"]
        if not rows.num_rows or not asked.num_rows:
            return pa.table([pa.array([], t) for t in types], names)
        x, q = (_vectors(t.column("vector").combine_chunks(), size) for t in (rows, asked))
        ids, own = (t.column("vec_id").to_numpy() for t in (rows, asked))
        limits, factor = asked.column("limit").to_numpy(), shared.value.scale
        found = scan(
            shared.value.rotate(x), ids, shared.value.rotate(q), own, limits * factor, k,
            lambda at, of: _distance(x[at], q[of]) * factor,
        )
        score = _distance(x[found.row], q[found.query])
        return pa.table([pa.array(own[found.query], types[0]), pa.array(ids[found.row], types[1]), pa.array(score)], names)

    nearest = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    best = lambda found: found.withColumn("rank", nearest).filter(F.col("rank") <= k)
    seeds = materialize(best(round_of(asked.withColumn("limit", F.lit(float("inf"))), True)))
    limits = seeds.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("limit"))
    limited = asked.join(limits, "vec_id", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    found = round_of(limited.select("vec_id", "vector", "limit"), False).unionByName(seeds.drop("rank"))
    return best(found).select("query_id", "rank", "vec_id", "score")
