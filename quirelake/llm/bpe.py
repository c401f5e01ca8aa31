"""Byte-level BPE over public ranks: encoding with a segment tree per piece, and decoding.

For each piece the leaves of a segment tree are its byte positions; a leaf holds the rank of the pair that starts there
and the position, so the root is the leftmost pair of the least rank. A merge writes three leaves (the merged position,
the one it swallowed, and the live neighbour before it) and climbs from each: logarithmic work per merge, whatever the
piece's length. Short pieces of one size run together as rows of numpy arrays, long ones one by one.

Null text counts as empty: no ids, empty bytes. Rows are handled one by one, so repeated rows give equal rows; an empty
table gives an empty result; only the columns named are read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from quirelake.llm.common import slices, small_batches
from quirelake.llm.pretoken import PieceCache

NONE = np.iinfo(np.int64).max
#: Pieces of more bytes than this are encoded one by one.
LONG = 256
#: Leaves of the trees that are built at once.
LEAVES = 1 << 19


class Ranks:
    """The ranks of a file, and of each pair of ids whose bytes together have a rank."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.token[rank] = token
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in self.rank.items():
            for i in range(1, len(token)):
                left, right = self.rank.get(token[:i]), self.rank.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)
        #: Ranks of pairs of bytes, at 256 * left + right.
        self.bytes = self.of(np.repeat(self.byte, 256), np.tile(self.byte, 256))

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pairs' ranks, NONE where the pair has none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)


def _climb(tree: np.ndarray, base: np.ndarray, node: np.ndarray, levels: int) -> None:
    for _ in range(levels):
        node = node >> 1
        left = base + 2 * node
        tree[base + node] = np.minimum(tree[left], tree[left + 1])


def merge_rows(ranks: Ranks, words: list[bytes], leaves: int) -> list[np.ndarray]:
    """Ids of words of 2 to `leaves` bytes (a power of two), all trees at once."""
    n, levels = len(words), leaves.bit_length() - 1
    size = np.fromiter((len(w) for w in words), dtype=np.int64, count=n)
    raw = np.frombuffer(b"".join(w.ljust(leaves, b"\0") for w in words), dtype=np.uint8).reshape(n, leaves)
    ids = ranks.byte[raw]
    place = np.arange(leaves, dtype=np.int64)
    alive = place < size[:, None]
    tree = np.full((n, 2 * leaves), NONE, dtype=np.int64)
    rank = ranks.bytes[raw[:, :-1].astype(np.int64) << 8 | raw[:, 1:]]
    usable = alive[:, 1:] & (rank != NONE)
    tree[:, leaves : 2 * leaves - 1] = np.where(usable, rank * leaves + place[:-1], NONE)
    for level in range(levels - 1, -1, -1):
        lo = 1 << level
        tree[:, lo : 2 * lo] = np.minimum(tree[:, 2 * lo : 4 * lo : 2], tree[:, 2 * lo + 1 : 4 * lo : 2])
    following = np.where(place + 1 < size[:, None], place + 1, leaves)
    before = np.broadcast_to(place - 1, (n, leaves)).copy()
    tree, ids, following, before, alive = (x.reshape(-1) for x in (tree, ids, following, before, alive))
    row = np.arange(n, dtype=np.int64)
    while True:
        root = tree[row * (2 * leaves) + 1]
        row, root = row[root != NONE], root[root != NONE]
        if not len(row):
            break
        base, cell = row * (2 * leaves), row * leaves
        rank, at = root >> levels, root & (leaves - 1)
        gone = following[cell + at]
        then = following[cell + gone]
        ids[cell + at] = rank
        alive[cell + gone] = False
        following[cell + at] = then
        more = then < leaves
        before[(cell + then)[more]] = at[more]
        ahead = np.full(len(row), NONE, dtype=np.int64)
        found = ranks.of(rank[more], ids[(cell + then)[more]])
        ahead[more] = np.where(found != NONE, found * leaves + at[more], NONE)
        tree[base + leaves + gone] = NONE
        tree[base + leaves + at] = ahead
        left = before[cell + at]
        some = left >= 0
        b, c, p = base[some], cell[some], left[some]
        found = ranks.of(ids[c + p], rank[some])
        tree[b + leaves + p] = np.where(found != NONE, found * leaves + p, NONE)
        # All three leaves climb together, level by level.
        _climb(tree, np.concatenate([base, base, b]), leaves + np.concatenate([gone, at, p]), levels)
    ids, alive = ids.reshape(n, leaves), alive.reshape(n, leaves)
    return [ids[i][alive[i]] for i in range(n)]


def merge_one(ranks: Ranks, word: bytes) -> list[int]:
    """The same for one word of any length, over plain lists."""
    n, pairs = len(word), ranks.pairs
    ids = ranks.byte[np.frombuffer(word, dtype=np.uint8)].tolist()
    leaves = 1 << max(n - 1, 1).bit_length()
    shift = leaves.bit_length() - 1
    tree = [NONE] * (2 * leaves)

    def key(left: int, right: int) -> int:
        rank = pairs.get(ids[left] << 32 | ids[right])
        return NONE if rank is None else rank << shift | left

    def put(at: int, value: int) -> None:
        node = leaves + at
        tree[node] = value
        node >>= 1
        while node:
            value = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == value:
                return
            tree[node] = value
            node >>= 1

    for i in range(n - 1):
        tree[leaves + i] = key(i, i + 1)
    for node in range(leaves - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    following, before = [*range(1, n + 1)], [*range(-1, n - 1)]
    while tree[1] != NONE:
        rank, at = tree[1] >> shift, tree[1] & (leaves - 1)
        gone = following[at]
        then = following[gone]
        ids[at] = rank
        ids[gone] = -1
        following[at] = then
        if then < n:
            before[then] = at
        put(gone, NONE)
        put(at, key(at, then) if then < n else NONE)
        if before[at] >= 0:
            put(before[at], key(before[at], at))
    return [i for i in ids if i >= 0]


def encode_pieces(ranks: Ranks, pieces: list[str]) -> list[bytes]:
    """Each piece's ids as bytes. A piece that has a rank itself is one id."""
    words = [p.encode() for p in pieces]
    out: list[bytes | None] = [None] * len(words)
    groups: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        rank = ranks.rank.get(word)
        if rank is not None:
            out[i] = rank.to_bytes(4, "little")
        elif len(word) > LONG:
            out[i] = np.array(merge_one(ranks, word), dtype="<u4").tobytes()
        else:
            groups.setdefault(1 << (len(word) - 1).bit_length(), []).append(i)
    for leaves, members in groups.items():
        step = max(1, LEAVES // leaves)
        for k in range(0, len(members), step):
            part = members[k : k + step]
            for i, ids in zip(part, merge_rows(ranks, [words[i] for i in part], leaves), strict=True):
                out[i] = ids.astype("<u4").tobytes()
    return out


@lru_cache(maxsize=2)
def _ranks(path: str) -> Ranks:
    return Ranks(path)


@lru_cache(maxsize=2)
def _cache(path: str) -> PieceCache:
    ranks = _ranks(path)
    return PieceCache(lambda pieces: encode_pieces(ranks, pieces))


def _lists(parts: list[bytes], dtype: str) -> pa.Array:
    flat = np.frombuffer(b"".join(parts), dtype=dtype)
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32), pa.int32()))


def encode(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and `ids` of every whole text; `path` is a rank file that the executors have."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(path)
        for batch in slices(batches):
            parts = list(cache.ids(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(parts, "<u4")], ["doc_id", "ids"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The rows with `decoded`, the bytes their ids stand for."""
    small_batches(rows.sparkSession)
    at = rows.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _ranks(path).token
        for batch in slices(batches):
            decoded = [b"".join(map(token.__getitem__, x)) if x else b"" for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], [*batch.schema.names, "decoded"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("decoded", BinaryType())]))
