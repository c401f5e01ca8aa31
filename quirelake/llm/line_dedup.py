"""Line dedup by pairwise alignment: common blocks of lines go from the later of two overlapping documents.

Overlapping documents are found through shared line hashes: every line that two documents have is a key, and so are three
consecutive lines and all lines of a shorter document. Every holder of a key is paired with the key's earliest holder, so a
key gives one pair less than it has holders and never all pairs. A pair is aligned by patience diff (lines that stand once
on both sides, in their longest common order, and the parts between them again); aligned lines are deleted from the later
document. A line's earliest holder always keeps it.

Only lines that some other document has can align. So no texts are compared: a document is its shared lines with their
places and its blank lines, and a run of other lines is one sign that equals nothing, which leaves every alignment as it
is. A later document comes to its task once, followed by its partners one by one. Keys are 64-bit hashes, which at worst
bring a pair together for nothing; lines are equal when two such hashes with different seeds are, 128 bits in all.

Lines are parted by "\\n" and equal when identical; blank ones are no keys, and a block of blank lines alone stays.
Earlier means a smaller id (null first), then a smaller row locator, so repeated ids and rows have a defined order.
Null texts count as empty. Long texts are split in whole; an alignment needs both documents' shared lines in memory. An
empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.functions.text import bind
from quirelake.llm.common import LOCATOR, Workspace, located, only_keys, scanned, small_batches, stored, with_values

BLOCK = 3
#: Signs for what can't align on either side; no hash of a line is used for them.
BLANK, LEFT, RIGHT = (0, 0), -1, -2


def _anchors(a: list[int], b: list[int], a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Lines that stand once in either part, in their longest common order."""
    once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
    where = {a[i]: i for i in range(a0, a1) if once_a[a[i]] == 1}
    found = [(where[b[j]], j) for j in range(b0, b1) if b[j] in where and once_b[b[j]] == 1]
    tops: list[int] = []
    last: list[int] = []
    back = [-1] * len(found)
    for n, (i, _) in enumerate(found):
        pile = bisect_left(tops, i)
        back[n] = last[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(i)
            last.append(n)
        else:
            tops[pile], last[pile] = i, n
    n, out = last[-1] if last else -1, []
    while n >= 0:
        out.append(found[n])
        n = back[n]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (i, j), ascending, with a[i] == b[j]."""
    out, parts = [], [(0, len(a), 0, len(b))]
    while parts:
        a0, a1, b0, b1 = parts.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 < a1 and b0 < b1:
            anchors = _anchors(a, b, a0, a1, b0, b1)
            if anchors:
                out += anchors
                edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
                parts += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges[:-1], edges[1:], strict=True)]
    return sorted(out)


def common_lines(a: list, b: list, blank) -> list[int]:
    """Places in `b` of the aligned blocks that hold more than blank lines."""
    out: list[int] = []
    block: list[int] = []
    previous = (-2, -2)
    for i, j in [*patience(a, b), (-9, -9)]:
        if (i, j) != (previous[0] + 1, previous[1] + 1):
            if any(b[k] != blank for k in block):
                out += block
            block = []
        block.append(j)
        previous = (i, j)
    return out


def spelled(places: list[int], lines: list[tuple], blanks: list[int], n: int, side: int) -> tuple[list, list[int]]:
    """A document of `n` lines as a list for the diff, and the line number of each entry.

    Shared lines and blank ones are as they are, and each run of others is one sign, (side, number of the run).
    """
    found = sorted([*zip(places, lines, strict=True), *((i, BLANK) for i in blanks)])
    entries: list = []
    numbers: list[int] = []
    after = 0
    for place, line in [*found, (n, None)]:
        if place > after:
            entries.append((side, after))
            numbers.append(after)
        if line is not None:
            entries.append(line)
            numbers.append(place)
        after = place + 1
    return entries, numbers


def _keys(lines: Column, block: int) -> Column:
    """(kind, hash) of runs of `block` lines, and of all lines of a shorter document."""
    runs = F.transform(
        F.slice(lines, F.lit(1), F.greatest(F.size(lines) - (block - 1), F.lit(0))),
        lambda h, i: F.xxhash64(h, *[F.get(lines, i + k) for k in range(1, block)]),
    )
    whole = F.when((F.size(lines) > 0) & (F.size(lines) < block), F.array(F.xxhash64(lines)))

    def kind(number: int, hashes: Column) -> Column:
        return F.transform(F.array_distinct(hashes), lambda h: F.struct(F.lit(number).alias("kind"), h.alias("hash")))

    return F.concat(kind(2, runs), kind(3, F.coalesce(whole, F.array().cast("array<bigint>"))))


def _telling(keyed: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that more than one document holds, with their earliest holder."""
    order = F.struct("id", "node")
    held = keyed.groupBy(*keys).agg(F.min(order).alias("first"), F.max(order).alias("last"))
    return held.filter("first.node != last.node").select(*keys, F.col("first.node").alias("early"))


def _aligned(partners: DataFrame) -> DataFrame:
    """__locator, removed, of rows (late, n, blanks, at, h, g, own): a later document's own row and its partners' rows."""
    rows = partners.repartition("late").sortWithinPartitions("late", F.col("own").desc())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late, mine, numbers, gone = None, [], [], set()
        for batch in batches:
            done, removed = [], []
            for own, *document in zip(*(batch.column(i).to_pylist() for i in (6, 0, 1, 2, 3, 4, 5)), strict=True):
                name, n, blanks, at, h, g = document
                lines = list(zip(h, g, strict=True))
                if own:
                    if gone:
                        done.append(late)
                        removed.append(sorted(gone))
                    late, gone = name, set()
                    mine, numbers = spelled(at, lines, blanks, n, RIGHT)
                else:
                    theirs, _ = spelled(at, lines, blanks, n, LEFT)
                    gone.update(numbers[j] for j in common_lines(theirs, mine, BLANK))
            yield _removed(done, removed)
        if gone:
            yield _removed([late], [sorted(gone)])

    return rows.mapInArrow(run, f"{LOCATOR} struct<file:bigint,row:bigint>, removed array<int>")


def _removed(names: list, removed: list[list[int]]) -> pa.RecordBatch:
    place = pa.struct([("file", pa.int64()), ("row", pa.int64())])
    return pa.RecordBatch.from_arrays([pa.array(names, place), pa.array(removed, pa.list_(pa.int32()))], [LOCATOR, "removed"])


def removals(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """__locator, removed: ascending line numbers to delete, for the documents that lose a line."""
    small_batches(docs.sparkSession, 256)
    split = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    hashed = F.transform(split, lambda x, i: F.struct(
        i.alias("at"), F.when(F.btrim(x) != "", F.xxhash64(x)).alias("h"), F.xxhash64(F.lit(7), x).alias("g"),
    ))
    rows = located(docs).select(F.col(LOCATOR).alias("node"), F.col(doc_id).cast("bigint").alias("id"), hashed.alias("lines"))
    with Workspace(docs.sparkSession) as space:
        rows = space.put(rows, "lines")
        full = F.filter("lines", lambda x: x["h"].isNotNull())
        single = rows.select("node", "id", F.explode(full).alias("line")).select("node", "id", "line.*")
        runs = rows.select("node", "id", F.explode(_keys(F.transform(full, lambda x: x["h"]), block)).alias("key")).select("node", "id", "key.*")
        lines, blocks = space.put(_telling(single, ["h"]), "line-keys"), space.put(_telling(runs, ["kind", "hash"]), "run-keys")
        # Lines that other documents have too, wherever they stand.
        shared = space.put(only_keys(single, lines, "h").join(lines, "h").select("node", "early", "at", "h", "g"), "shared-lines")
        met = only_keys(runs, blocks, "hash").join(blocks, ["kind", "hash"]).select("early", F.col("node").alias("late"))
        pairs = shared.select("early", F.col("node").alias("late")).union(met).filter("early != late").distinct()
        pairs = space.put(pairs, "line-pairs")
        # Sorted by place: one row per document that has a shared line.
        told = space.put(shared.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("at", "h", "g"))).alias("held")), "held")
        blank = F.transform(F.filter("lines", lambda x: x["h"].isNull()), lambda x: x["at"])
        frames = rows.select("node", F.size("lines").alias("n"), blank.alias("blanks"))
        bodies = only_keys(frames, told, "node").join(told, "node").select(
            "node", "n", "blanks", *[F.col("held")[c].alias(c) for c in ("at", "h", "g")]
        )
        bodies = space.put(bodies, "line-bodies")
        document = ["n", "blanks", "at", "h", "g"]
        later = bodies.join(pairs.select(F.col("late").alias("node")).distinct(), "node", "left_semi")
        partners = pairs.join(bodies.withColumnRenamed("node", "early"), "early").select("late", *document, F.lit(False).alias("own"))
        both = later.select(F.col("node").alias("late"), *document, F.lit(True).alias("own")).unionByName(partners)
        return stored(_aligned(both), "removals")


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """doc_id, n_lines, n_removed and the text that is left, for every row."""
    docs = scanned(docs)
    lost = removals(docs, text, doc_id, block)
    rows = located(docs).select(LOCATOR, F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def left(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "removed")
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    # Only texts that lose a line move, once; `lost` grows with the corpus, so it is never broadcast, at whatever size.
    lines = F.split("text", "\n")
    return with_values(rows, lost.hint("merge"), LOCATOR).select(
        "doc_id", F.size(lines).cast("bigint").alias("n_lines"), F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(bind(lines, left)).alias("text"),
    )
