"""Filter interaction audit: what each filter removes in every order, from one pass over failure masks.

Each document gets a mask of the filters it fails. Four of them look at its own text; the fifth asks whether a document
with a smaller id has the same text. That one is prepared by a counting Bloom filter: every text adds to `HASHES` cells
of one block of the filter, map tasks add up their own cells, and the sums are added (counts above one are all the same).
A text with a cell that nobody else touched is unique, for certain. Only the others are shuffled with their whole text to
find the least id of each, and of these only the ones whose id is not the least fail the filter.

Masks are added up per part and labels; there are 32 of them, whatever the size of the table. All orders and steps are
evaluated on these sums. The filter has `CELLS_PER_ROW` cells for each row, up to `MOST_CELLS`; it is broadcast as bits
(a bit per cell, 64 MiB at most). Beyond that more texts are shuffled and the result stays the same.

Null texts are empty: they fail filters A and, from the second on, E. Nothing is divided, so an empty text passes B and C.
A null id is smaller than none and larger than none, so its row never fails E; rows that repeat the least id of a text
don't either. Labels are read by document id, and a document has a label if any row of it says so. Texts are taken in
whole, however long. A null language is the empty part. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.llm.common import is_set, stored

FILTERS = "ABCDE"
NOT_SPACE = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = r"[#$%&*|]"
HASHES = 3
#: Cells of the filter for each row, and the most it can have: 2^29 bits are 64 MiB.
CELLS_PER_ROW, MOST_CELLS = 16, 1 << 29
#: Cells of a block: what a bitmap of Spark's bitmap functions holds.
BLOCK = 32768


def text_mask(text: Column) -> Column:
    """Bits 0 to 3: which of the filters A to D the text fails."""
    words = F.array_remove(F.split(text, NOT_SPACE), "")
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))

    def bits(own: Column) -> Column:
        tests = [
            F.size(own) < 100,
            100 * F.size(F.array_distinct(own)) < 80 * F.size(own),
            100 * capitals.cast("bigint") > 10 * F.length(text).cast("bigint"),
            text.rlike(SYMBOLS),
        ]
        return sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0))

    # Bound as a lambda's variable, the words are split once.
    return F.get(F.transform(F.array(words), bits), F.lit(0))


def _cells(number: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of the filter that a text belongs to, and its cells there."""
    block = F.pmod(F.xxhash64(number, F.lit(0)), F.lit(blocks))
    return block, [F.pmod(F.xxhash64(number, F.lit(i + 1)), F.lit(BLOCK)).cast("int") for i in range(HASHES)]


def repeated_cells(rows: DataFrame, number: str, blocks: int) -> DataFrame:
    """block, bits: the cells that were touched more than once, as one bitmap per block."""
    block, cells = _cells(F.col(number), blocks)
    # A text touches a cell once, even if two of its hashes meet there.
    touched = rows.select(block.alias("block"), F.explode(F.array_distinct(F.array(*cells))).alias("cell"))
    counts = touched.groupBy("block", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return counts.groupBy("block").agg(F.call_function("bitmap_construct_agg", F.col("cell")).alias("bits"))


def maybe_repeated(rows: DataFrame, number: str, sketch: DataFrame, blocks: int) -> DataFrame:
    """The rows of which another one may have the same number; those that are left out are unique."""
    block, cells = _cells(F.col(number), blocks)
    bitmaps = F.broadcast(sketch.select(F.col("block").alias("__block"), F.col("bits").alias("__bits")))
    hits = F.forall(F.array(*cells), lambda cell: is_set(F.col("__bits"), cell))
    return rows.withColumn("__block", block).join(bitmaps, "__block").filter(hits).drop("__block", "__bits")


def masks(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang") -> DataFrame:
    """id, part, mask, n: bit i of the mask is set if a document fails filter i. Rows add up: one that fails the fifth
    filter counts once with that bit, and once without it and again, negatively, without it."""
    texts = docs.select(
        F.col(doc_id).cast("bigint").alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    rows = stored(texts.select("id", "part", digest, text_mask(F.col("text")).alias("mask")), "masks")
    blocks = max(1, min(MOST_CELLS, CELLS_PER_ROW * rows.count()) // BLOCK)
    sketch = stored(repeated_cells(rows, "digest", blocks), "sketch")
    possible = maybe_repeated(texts.select("id", "text", digest), "digest", sketch, blocks)
    # Each task sends a text once, however many copies it has.
    least = possible.groupBy("text").agg(F.min("id").alias("id"))
    first = stored(least.select(F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), "id"), "first")
    # By digest and id, the copies of one text lie in many tasks.
    later = maybe_repeated(rows.filter("id IS NOT NULL"), "digest", sketch, blocks).join(first, ["digest", "id"], "left_anti")
    changes = F.explode(F.array(
        F.struct(F.lit(-1).cast("bigint").alias("n"), F.col("mask")),
        F.struct(F.lit(1).cast("bigint").alias("n"), (F.col("mask") + (1 << FILTERS.index("E"))).alias("mask")),
    )).alias("change")
    changed = later.select("id", "part", changes).select("id", "part", "change.mask", "change.n")
    return rows.select("id", "part", "mask", F.lit(1).cast("bigint").alias("n")).unionByName(changed)


def mask_counts(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang"
) -> DataFrame:
    """part, mask, n, good, toxic: sums over documents, which can be added to those of other tables."""
    rows = masks(docs, text, doc_id, part).groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))
    rows = stored(rows.filter("n <> 0"), "mask-rows")
    said = labels.groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    # Null ids have no labels and take no part in the join.
    told = rows.join(said.filter("good OR toxic"), "id").groupBy("part", "mask").agg(
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    sums = rows.groupBy("part", "mask").agg(F.sum("n").alias("n"))
    counts = sums.join(told, ["part", "mask"], "left").select(
        "part", "mask", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    )
    return stored(counts, "mask-counts")


def audit(counts: DataFrame) -> DataFrame:
    """part, filter_order, step and what the step does, for all orders: a few sums over the mask counts.

    Over all orders, a filter is the first of the k that a document fails in 1 / k of them: that is its Shapley count.
    """
    orders = ",".join("".join(order) for order in permutations(FILTERS))
    rows = counts.withColumn("filter_order", F.explode(F.split(F.lit(orders), ",")))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    place = {f: F.instr("filter_order", f) for f in FILTERS}
    own = sum((F.when(place[f] == F.col("step"), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))
    before = sum((F.when(place[f] < F.col("step"), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))
    fails = F.col("mask").bitwiseAND(own) != 0
    reached = F.col("mask").bitwiseAND(before) == 0
    orders_first = F.lit(factorial(len(FILTERS))) / F.bit_count("mask")

    def total(condition: Column, what: str | Column = "n") -> Column:
        return F.coalesce(F.sum(F.when(condition, what if isinstance(what, Column) else F.col(what))), F.lit(0)).cast("bigint")

    return rows.groupBy("part", "filter_order", "step").agg(
        total(reached & ~fails).alias("kept"),
        total(reached & fails).alias("removed"),
        total(~reached & fails).alias("redundant"),
        total(F.col("mask") == own).alias("unique_fails"),
        total(reached & fails, "good").alias("good_lost"),
        total(reached & fails, "toxic").alias("toxic_lost"),
        total(fails, F.col("n") * orders_first.cast("bigint")).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang") -> DataFrame:
    """The audit of a documents table."""
    return audit(mask_counts(docs, labels, text, doc_id, part))
