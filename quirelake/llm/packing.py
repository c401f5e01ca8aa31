"""Packing token sequences into bins of equal size by minimum bin slack, planned over lengths.

A bin is filled from the largest length left, and then with the combination of lengths left that fills the rest best,
found by subset-sum dynamic programming over a bitset of reachable sums. The chosen pieces are removed together; since
the fullest combination stays the fullest while it is feasible, one solution serves as many bins as there are pieces
for it. Only how many pieces have each length matters, so the plan is made from a table with a row per length (at most
the bin's capacity). Each pattern leaves fewer pieces of some length than it takes of it, so the number of patterns is at
most the sum of capacity / length over the lengths (about 7,900 for 1,024), whatever the corpus holds. Pieces then take
their places by their number among the pieces of their length, counted in buckets of bounded size.

Null text counts as empty and still has the end id. Documents are told apart by where their row lies, so repeated ids
and rows are packed one by one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirelake.llm.common import LOCATOR, located, slices, small_batches, stored
from quirelake.llm.pretoken import WordCache, unlike

CAPACITY = 1024
END_ID = 2
#: Pieces of one length that are numbered in one task.
BUCKET = 50_000
#: Distinct pieces in each generation of a worker's cache, which all together stay under 150 MB.
REMEMBERED = 200_000


def byte_characters() -> dict[int, str]:
    """The character by which a byte-level vocabulary writes each byte: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def _encoder(path: str, added_tokens: bool) -> Callable[[list[str]], Iterator[bytes]]:
    """Texts -> ids as the library's `encode(text, add_special_tokens=False)` gives them.

    The tokenizer's own model is asked for one piece at a time: pieces are what its pre-tokenizer would hand it. Texts
    that hold an added token, or a code point that the library classes differently, go through the library whole.
    Without `added_tokens`, strings of special tokens are ordinary text.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not added_tokens
    marks = [t.content for t in tokenizer.get_added_tokens_decoder().values() if added_tokens or not t.special]
    odd = unlike(tokenizer.pre_tokenizer.pre_tokenize_str)
    tokenize = tokenizer.model.tokenize
    written = byte_characters()
    blank = written[ord(" ")]

    def encode(word: str) -> bytes:
        if word.isascii() and word.isprintable():
            spelled = word.replace(" ", blank)
        else:  # latin-1 gives every byte of the UTF-8 form the character of its number
            spelled = word.encode().decode("latin-1").translate(written)
        return array("I", [t.id for t in tokenize(spelled)]).tobytes()

    cache = WordCache(encode, REMEMBERED)

    def whole(text: str) -> bool:
        if any(m in text for m in marks):
            return True
        return not text.isascii() and bool(odd[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)].any())

    def ids(texts: list[str]) -> Iterator[bytes]:
        alone = [whole(t) for t in texts]
        others = cache.ids([t for t, x in zip(texts, alone, strict=True) if not x])
        for text, x in zip(texts, alone, strict=True):
            if x:
                yield array("I", tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()
            else:
                yield next(others)

    return ids


PIECES = "file bigint, row bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text", doc_id: str = "doc_id",
    added_tokens: bool = True,
) -> DataFrame:
    """Every document's ids and the end id, cut into pieces of `capacity`; the first piece takes what is over."""
    small_batches(docs.sparkSession)
    rows = located(docs).select(
        F.col(f"{LOCATOR}.file").alias("file"), F.col(f"{LOCATOR}.row").alias("row"),
        F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded = _encoder(path, added_tokens)
        for batch in slices(batches):
            found: list[list] = [[] for _ in range(5)]
            for i, ids in enumerate(encoded(batch.column(3).to_pylist())):
                ids += end
                total = len(ids) // 4
                start, piece = 0, 0
                stop = total % capacity or min(capacity, total)
                while start < total:
                    for values, v in zip(found, (i, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])), strict=True):
                        values.append(v)
                    start, stop, piece = stop, stop + capacity, piece + 1
            at = pa.array(found[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(at) for k in range(3)), pa.array(found[1], pa.int32()), *(pa.array(x, pa.int64()) for x in found[2:])],
                ["file", "row", "doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(run, PIECES)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths with the largest sum up to `room`; larger lengths are tried first."""
    limit, reach = (1 << (room + 1)) - 1, 1
    steps = []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << (take * length) & limit
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, earlier in reversed(steps):
        if not earlier >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= take * length
    return chosen


def minimum_slack(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pattern, bins filled by it) until no piece is left."""
    counts = {k: v for k, v in counts.items() if v}
    plan = []
    while counts:
        seed = max(counts)
        counts[seed] -= 1
        pattern = fullest({k: v for k, v in counts.items() if v}, capacity - seed)
        counts[seed] += 1
        pattern[seed] = pattern.get(seed, 0) + 1
        bins = min(counts[k] // m for k, m in pattern.items())
        plan.append((pattern, bins))
        for k, m in pattern.items():
            counts[k] -= m * bins
            if not counts[k]:
                del counts[k]
    return plan


PLAN = "length bigint, first bigint, past bigint, each bigint, sequence bigint, place bigint"


def _plan_rows(counts: dict[int, int], capacity: int) -> Iterator[tuple]:
    used: dict[int, int] = {}
    sequence = 0
    for pattern, bins in minimum_slack(counts, capacity):
        place = 0
        for length in sorted(pattern, reverse=True):
            each, first = pattern[length], used.get(length, 0)
            yield length, first, first + each * bins, each, sequence, place
            used[length] = first + each * bins
            place += each * length
        sequence += bins


def pack(pieces: DataFrame, key: list[str], capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset. `key` orders pieces of equal length; `pieces` must be stored."""
    histogram = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))

    def plan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[int, int] = {}
        for part in parts:
            for length, n in zip(part["length"].tolist(), part["n"].tolist(), strict=True):
                counts[length] = counts.get(length, 0) + n
        columns = [c.split(" ")[0] for c in PLAN.split(", ")]
        yield pd.DataFrame(list(_plan_rows(counts, capacity)), columns=columns).astype("int64")

    # A row per length: at most `capacity` rows in the one task.
    places = stored(histogram.repartition(1).mapInPandas(plan, PLAN), "pack-plan")
    buckets = histogram.select("length", F.ceil(F.col("n") / BUCKET).cast("bigint").alias("__buckets"))
    dealt = pieces.join(F.broadcast(buckets), "length").withColumn("__bucket", F.pmod(F.xxhash64(*key), F.col("__buckets")))
    numbered = dealt.withColumn(
        "__number", F.row_number().over(Window.partitionBy("length", "__bucket").orderBy(*key)) - 1
    )
    sizes = dealt.groupBy("length", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    skips = sizes.select("length", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__skip"))
    ranked = numbered.join(skips, ["length", "__bucket"]).withColumn("__rank", F.col("__number") + F.col("__skip"))
    # Bounded: the number of patterns is, and no more lengths are in one than add up to a bin.
    where = F.broadcast(places.withColumnRenamed("length", "__length"))
    joined = ranked.join(
        where,
        (F.col("length") == F.col("__length")) & (F.col("__rank") >= F.col("first")) & (F.col("__rank") < F.col("past")),
    )
    return joined.select(
        *[F.col(c) for c in pieces.columns],
        F.expr("sequence + (__rank - `first`) div each").alias("sequence_id"),
        F.expr("place + pmod(__rank - `first`, each) * length").alias("offset"),
    )


def pack_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text", doc_id: str = "doc_id",
    added_tokens: bool = True,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    pieces = stored(token_pieces(docs, path, capacity, end_id, text, doc_id, added_tokens), "pieces")
    return pack(pieces, ["file", "row", "piece"], capacity).drop("file", "row")
