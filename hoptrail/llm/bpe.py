"""Byte-level BPE encoding and decoding by length-bucketed matrices.

A text is split by the tokenizer's pattern. Pieces that were not met before are put
into padded matrices, one per length bucket, and every row merges its leftmost
pair of least rank each round: one hashed lookup gives the ranks of the two pairs
that a merge creates, and a boolean mask compacts the matrix by one column. Rows
without a pair left leave the matrix.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

NONE = np.int32(2**31 - 1)
#: Cells of a matrix; a bucket with more pieces is worked off in several matrices.
CELLS = 1 << 18
#: From this length on, a piece is merged alone by `merge_long`.
LONG = 1024
#: Pieces that a worker remembers before it starts anew.
REMEMBERED = 800_000
#: Characters of text that are split at once (a longer text is split alone).
SLICE = 1 << 20


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (`base64 rank` per line), by rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks have gaps")
    return [ranks[rank] for rank in range(len(ranks))]


class PairTable:
    """Open-addressed hash table from a pair of ids to the id of the joined bytes."""

    def __init__(self, tokens: list[bytes]):
        rank = {token: i for i, token in enumerate(tokens)}
        pairs = [
            (left, right, joined)
            for token, joined in rank.items()
            for cut in range(1, len(token))
            if (left := rank.get(token[:cut])) is not None
            and (right := rank.get(token[cut:])) is not None
        ]
        table = np.array(pairs, np.int64).reshape(-1, 3)
        keys = (table[:, 0] << 32) | table[:, 1]
        bits = max(4, int(4 * len(keys) + 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ids = np.full(1 << bits, NONE, np.int32)
        slots, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slots[left]] == -1]
            # Of the keys that want one free slot, the first takes it.
            first = free[np.unique(slots[free], return_index=True)[1]]
            self.keys[slots[first]], self.ids[slots[first]] = keys[first], table[first, 2]
            left = np.setdiff1d(left, first, assume_unique=True)
            taken = left[self.keys[slots[left]] != -1]
            slots[taken] = (slots[taken] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the joined pairs, NONE where a pair doesn't merge or a side is padding."""
        keys = ((left.astype(np.int64) << 32) | right.astype(np.int64)).ravel()
        keys[(left < 0).ravel() | (right < 0).ravel()] = -2
        slots = self._slot(keys)
        held = self.keys[slots]
        out = np.where(held == keys, self.ids[slots], NONE)
        rest = np.flatnonzero((held != keys) & (held != -1) & (keys != -2))
        while len(rest):
            slots[rest] = (slots[rest] + 1) & self.mask
            held = self.keys[slots[rest]]
            out[rest] = np.where(held == keys[rest], self.ids[slots[rest]], NONE)
            rest = rest[(held != keys[rest]) & (held != -1)]
        return out.reshape(left.shape)


def _spans(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items of the given lengths laid end to end: the item of each cell, its place in it."""
    item = np.repeat(np.arange(len(lengths)), lengths)
    return item, np.arange(len(item)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def merge_matrix(pairs: PairTable, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge the rows of a matrix of ids padded by -1: all ids left, and how many of each row."""
    out = np.full(rows.shape, -1, np.int32)
    who = np.arange(len(rows))
    ranks = np.full(rows.shape, NONE, np.int32)  # the last column stays without a pair
    ranks[:, :-1] = pairs.find(rows[:, :-1], rows[:, 1:])
    while len(who):
        place = ranks.argmin(1)
        each = np.arange(len(who))
        least = ranks[each, place]
        if (done := least == NONE).any():
            out[who[done], : rows.shape[1]] = rows[done]
            go = ~done
            rows, ranks, who, place, least = rows[go], ranks[go], who[go], place[go], least[go]
            each = each[: len(who)]
            if not len(who):
                break
        rows[each, place] = least
        keep = np.ones(rows.shape, bool)
        keep[each, place + 1] = False
        rows = rows[keep].reshape(len(who), -1)
        keep[each, place + 1], keep[each, place] = True, False
        ranks = ranks[keep].reshape(len(who), -1)
        # The merged id stands at `place`; its pairs are at place - 1 and place.
        before, after = np.flatnonzero(place > 0), np.flatnonzero(place + 1 < rows.shape[1])
        r = np.concatenate((before, after))
        at = np.concatenate((place[before] - 1, place[after]))
        ranks[r, at] = pairs.find(rows[r, at], rows[r, at + 1])
    held = out >= 0
    return out[held], held.sum(1)


def merge_long(pairs: PairTable, ids: np.ndarray) -> np.ndarray:
    """The same merges of one very long piece, many of one rank in a round.

    Leftmost merges of the least rank follow each other as long as none creates a pair of
    lower rank; a round does just those. (No merge creates a pair of equal rank: its bytes
    would be longer.)
    """
    ranks = pairs.find(ids[:-1], ids[1:])
    while len(ranks) and (least := ranks.min()) != NONE:
        at = np.flatnonzero(ranks == least)
        # In a run of neighbouring places every second one is left after the one before it.
        start = np.concatenate(([True], np.diff(at) > 1))
        run = np.flatnonzero(start)[np.cumsum(start) - 1]
        at = at[(np.arange(len(at)) - run) % 2 == 0]
        before = np.where(at > 0, ids[at - 1], -1)
        before[1:][np.diff(at) == 2] = least
        after = np.where(at + 2 < len(ids), ids[np.minimum(at + 2, len(ids) - 1)], -1)
        merged = np.full(len(at), least, np.int32)
        lower = np.minimum(pairs.find(before, merged), pairs.find(merged, after)) < least
        if lower.any():
            at = at[: int(lower.argmax()) + 1]
        ids[at] = least
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        ids, ranks = ids[keep], ranks[keep[1:]]
        at = at - np.arange(len(at))
        for changed in (at[at > 0] - 1, at[at < len(ranks)]):
            ranks[changed] = pairs.find(ids[changed], ids[changed + 1])
    return ids


#: Characters on which Python's and Unicode's classes agree, up to U+024F.
PLAIN = re.compile("[\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]*")
#: For the pattern of the usual rank files, the same split of plain text by the faster module.
USUAL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
USUAL_PLAIN = r"""'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"""


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of a pattern, `\\s` being Unicode white space."""
    split = regex.compile(pattern).findall
    if pattern != USUAL:
        return split
    plain, fast = PLAIN.fullmatch, re.compile(USUAL_PLAIN).findall
    return lambda text: fast(text) if plain(text) else split(text)


class Codec:
    """Encoder and decoder of one vocabulary, with a bounded memory of pieces."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.split = splitter(pattern)
        self.pairs = PairTable(tokens)
        single = {token[0]: i for i, token in enumerate(tokens) if len(token) == 1}
        if len(single) != 256:
            raise ValueError("the vocabulary lacks single bytes")
        self.byte_ids = np.array([single[b] for b in range(256)], np.int32)
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.int32)
        self.used = 0
        self.first = np.empty(1 << 12, np.int64)
        self.count = np.empty(1 << 12, np.int64)

    def _merged(self, pieces: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By buckets of like length: which pieces, their ids end to end, how many of each."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        buckets = np.ceil(np.log2(np.maximum(sizes, 1))).astype(int)
        for bucket in np.unique(buckets[sizes < LONG]):
            mine = np.flatnonzero((buckets == bucket) & (sizes < LONG))
            step = max(1, CELLS >> int(bucket))
            for chunk in (mine[i : i + step] for i in range(0, len(mine), step)):
                data = np.frombuffer(b"".join([pieces[i] for i in chunk]), np.uint8)
                rows = np.full((len(chunk), int(sizes[chunk].max())), -1, np.int32)
                rows[_spans(sizes[chunk])] = self.byte_ids[data]
                yield chunk, *merge_matrix(self.pairs, rows)
        for i in np.flatnonzero(sizes >= LONG):
            ids = merge_long(self.pairs, self.byte_ids[np.frombuffer(pieces[i], np.uint8)])
            yield np.array([i]), ids, np.array([len(ids)])

    def _learn(self, pieces: set[str]) -> None:
        new = list(pieces)
        n = len(self.known)
        if n + len(new) > len(self.first):
            room = 2 * (n + len(new))
            self.first, self.count = (np.resize(a, room) for a in (self.first, self.count))
        for which, ids, counts in self._merged([p.encode() for p in new]):
            if self.used + len(ids) > len(self.flat):
                self.flat = np.resize(self.flat, 2 * (self.used + len(ids)))
            self.flat[self.used : self.used + len(ids)] = ids
            self.first[n + which] = self.used + np.cumsum(counts) - counts
            self.count[n + which] = counts
            self.used += len(ids)
        self.known.update(zip(new, range(n, n + len(new)), strict=True))

    def _slots(self, pieces) -> np.ndarray:
        return np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and the number of ids of each text."""
        flat, counts, i = [np.empty(0, np.int32)], np.zeros(len(texts), np.int64), 0
        while i < len(texts):
            stop, room = i, SLICE
            while stop < len(texts) and (stop == i or len(texts[stop] or "") <= room):
                room -= len(texts[stop] or "")
                stop += 1
            split = [self.split(t or "") for t in texts[i:stop]]
            pieces = [p for ps in split for p in ps]
            slots = self._slots(pieces)
            missed = np.flatnonzero(slots < 0)
            if len(missed):
                new = {pieces[j] for j in missed}
                if len(self.known) + len(new) > REMEMBERED or self.used > 8 * REMEMBERED:
                    self._forget()
                    new, missed = set(pieces), slice(None)
                self._learn(new)
                slots[missed] = self._slots(np.array(pieces, object)[missed])
            sizes = self.count[slots]
            item, place = _spans(sizes)
            flat.append(self.flat[self.first[slots][item] + place])
            ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum([len(s) for s in split])]
            counts[i:stop] = np.diff(ends, prepend=0)
            i = stop
        return np.concatenate(flat), counts

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids."""
        out = []
        for i in range(0, len(ids), SLICE):
            part = ids[i : i + SLICE]
            item, place = _spans(self.sizes[part])
            out.append(self.blob[self.starts[part][item] + place].tobytes())
        return b"".join(out)


#: Codecs of this worker by vocabulary, kept from one task to the next.
_CODECS: dict[str, Codec] = {}


def _codec(key: str, tokens, pattern: str) -> Codec:
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(tokens.value, pattern)
    return _CODECS[key]


class Tokenizer:
    """Column functions for one vocabulary file.

    The file is read where the query is made and sent to the workers once; its size is
    that of a vocabulary, whatever the data. `pattern` splits texts; `\\s` in it is
    Unicode white space.

    Null texts count as empty: no ids, no bytes. Empty texts have no ids. Texts of any
    length are encoded whole; a piece of over 1024 bytes is merged alone. Repeated rows
    stay. A null among ids, or one outside the vocabulary, makes `decode` fail.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        tokens = read_ranks(path)
        shared = spark.sparkContext.broadcast(tokens)
        key = hashlib.sha256(b"\0".join(tokens) + pattern.encode()).hexdigest()

        @F.arrow_udf(ArrayType(IntegerType()))
        def encode(texts: pa.Array) -> pa.Array:
            ids, counts = _codec(key, shared, pattern).encode(texts.to_pylist())
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))

        @F.arrow_udf(BinaryType())
        def decode(ids: pa.Array) -> pa.Array:
            codec = _codec(key, shared, pattern)
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(np.array([len(x) if x.is_valid else 0 for x in ids], np.int64))
            starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            return pa.array(
                [codec.decode(flat[a:b]) for a, b in zip(starts, ends, strict=True)], pa.binary()
            )

        #: Column of texts to column of ids (array<int>).
        self.encode = encode
        #: Column of ids to column of their bytes (binary); null ids give no bytes.
        self.decode = decode


def encode(df: DataFrame, tokenizer: Tokenizer, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with a column of ids, which replaces one of that name. No shuffle; rows stay."""
    return df.withColumn(ids, tokenizer.encode(F.col(f"`{text}`")))


def decode(df: DataFrame, tokenizer: Tokenizer, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """`df` with a column of the bytes that the ids stand for."""
    return df.withColumn(out, tokenizer.decode(F.col(f"`{ids}`")))


def round_trip(df: DataFrame, tokenizer: Tokenizer, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, number of ids, digests of the ids and of the bytes they decode to."""
    coded = decode(
        encode(df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")), tokenizer),
        tokenizer,
    )
    return coded.select(
        F.col("key").alias(key),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
