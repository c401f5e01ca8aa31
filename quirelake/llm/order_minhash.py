"""Near-duplicate detection by Order MinHash, verified by banded alignment.

A text is its lower-cased words; its k-mers are the windows of five words, each labelled with the number of its
occurrence. A sketch takes the `picks` k-mers with the least hashes under its own hash function and keeps them in text
order, so two texts share it when they share these k-mers in that order. Texts that share a sketch are compared by
aligning their windows inside a diagonal band: with a and b windows and w of them aligned in order, the similarity is
w / (a + b - w), the Jaccard similarity of the windows in which order counts. The band is as wide as the threshold
allows, so the verdict is exact.

Texts with equal words are one representative before anything is compared. Within a sketch's bucket no two members are
paired off at once: one member, another in each bucket, is compared with all others, and the links' groups are joined.
Members of one bucket that are still in different groups may share no more than a passage. They go through an exact
prefix filter: their windows are put in one global order, rare ones first, and two texts can only be similar if one of the
first n - ceil(0.8 n) + 1 windows of each is common to both, and if what follows it in both is long enough. So members are
dealt again by these windows, and inside such a group pivots (one, then 32 times as many each round) are compared with
the members of other groups that pass. The frequent windows of a passage stand last and bring nobody together. Each pair
of a bucket is thus connected already, compared, or ruled out exactly, and the groups are those of all links.

Texts are read in whole, however long; comparing two takes time in proportion to their length times the band's width,
which is a ninth of both lengths, after common ends and a count of common windows have settled most pairs.

Null and blank texts have no window and are alone, each in its own group. A text of one to four words is a single
window. Repeated rows and equal texts share a group; an empty table gives an empty result. Of a group the row with the
largest id stays (a null id is smaller than any; of repeated ids the largest locator). Only the id and text columns are
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelake.llm.common import (
    LOCATOR, Workspace, drop_rows, located, only_keys, scanned, slices, small_batches, stored, without_keys,
)

WORDS = 5
SIMILARITY = 0.8
#: A pair at the threshold shares a sketch with probability of about 0.8^3; it is missed by all with 1e-7.
SKETCHES = 24
PICKS = 3
#: Cells that windows are counted in to put rare ones first: at most this many counts reach the driver and the tasks.
#: Any order gives the same result; one that is less exact compares more pairs.
CELLS = 1 << 20
#: A row's number: its locator, which no two rows share.
ROW = "struct<file:bigint,row:bigint>"
MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Hashes of the windows of `size` words; fewer words are one window."""
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    words = words.view(np.uint64)
    out = np.zeros(max(n - size + 1, 1), dtype=np.uint64)
    for i in range(min(size, n)):
        out = mix(out * MIX + words[i : i + len(out)] + np.uint64(i + 1))
    return out


def occurrences(hashes: np.ndarray) -> np.ndarray:
    """For each place, how often its hash stands before it."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    first = np.empty(len(hashes), dtype=bool)
    first[:1] = True
    np.not_equal(ranked[1:], ranked[:-1], out=first[1:])
    if first.all():
        return np.zeros(len(hashes), dtype=np.int64)
    place = np.arange(len(hashes))
    nth = place - np.maximum.accumulate(np.where(first, place, 0))
    out = np.empty(len(hashes), dtype=np.int64)
    out[order] = nth
    return out


def seeds(sketches: int = SKETCHES) -> np.ndarray:
    return mix((np.arange(sketches, dtype=np.uint64) + np.uint64(1)) * MIX)


def labelled(hashes: np.ndarray) -> np.ndarray:
    """The hashes with the number of their occurrence, so that none stands twice."""
    return mix(hashes + occurrences(hashes).astype(np.uint64) * MIX)


def prefix_length(n: int, similarity: float) -> int:
    """How many of n windows must be looked at so that no similar text shares none of them."""
    return n - math.ceil(similarity * n - 1e-9) + 1


def sketch(hashes: np.ndarray, salts: np.ndarray, picks: int = PICKS) -> np.ndarray:
    """One signed 64-bit key per salt."""
    own = labelled(hashes)
    n, take = len(own), min(picks, len(own))
    out = np.empty(len(salts), dtype=np.uint64)
    step = max(1, (1 << 20) // n)
    for k in range(0, len(salts), step):
        part = salts[k : k + step]
        ranked = (own[None, :] ^ part[:, None]) * (part[:, None] | np.uint64(1))
        ranked ^= ranked >> np.uint64(32)
        least = np.argpartition(ranked, take - 1, axis=1)[:, :take] if n > take else np.broadcast_to(np.arange(n), (len(part), n))
        chosen = own[np.sort(least, axis=1)]
        key = part.copy()
        for j in range(take):
            key = mix(key * MIX + chosen[:, j])
        out[k : k + step] = key
    return out.view(np.int64)


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether w / (len(a) + len(b) - w) >= similarity, w being the longest common subsequence.

    Furthest-reaching paths over the diagonals of a band: with d insertions and deletions, w = (len(a) + len(b) - d) / 2,
    so at most (len(a) + len(b)) * (1 - s) / (1 + s) of them are allowed.
    """
    total = len(a) + len(b)
    most = int(total * (1 - similarity) / (1 + similarity) + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    # Common ends belong to some longest common subsequence.
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - short :] != b[len(b) - short :])
    tail = short - 1 - int(differ[-1]) if len(differ) else short
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    n, m = len(a), len(b)
    if n + m <= most:
        return True
    # What neither side can match must be inserted or deleted. A count by parts of the hash tells most pairs apart.
    mask = (1 << max(10, (n + m).bit_length())) - 1
    left, right = np.bincount(a & mask, minlength=mask + 1), np.bincount(b & mask, minlength=mask + 1)
    if n + m - 2 * int(np.minimum(left, right).sum()) > most:
        return False
    shared = np.intersect1d(a, b)
    lost = n + m - int(np.isin(a, shared).sum()) - int(np.isin(b, shared).sum())
    if lost > most:
        return False
    band = most + 1
    reach = np.full(2 * band + 3, -1, dtype=np.int64)  # furthest x per diagonal x - y, at band + 1 + diagonal
    center = band + 1
    reach[center + 1] = 0
    for d in range(most + 1):
        k = np.arange(-d, d + 1, 2)
        k = k[(k >= -m) & (k <= n)]
        below, above = reach[center + k - 1], reach[center + k + 1]
        x = np.where((k == -d) | ((k != d) & (below < above)), above, below + 1)
        x = np.minimum(x, n)
        y = x - k
        going = np.flatnonzero((x < n) & (y < m) & (y >= 0))
        while len(going):
            same = a[x[going]] == b[y[going]]
            going = going[same]
            x[going] += 1
            y[going] += 1
            going = going[(x[going] < n) & (y[going] < m)]
        reach[center + k] = x
        if ((x >= n) & (y >= m)).any():
            return True
    return False


def _lists(column) -> Iterator[np.ndarray]:
    flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        yield flat[a:b]


def _sketches(texts: DataFrame, sketches: int, picks: int) -> DataFrame:
    """row, words array -> bucket, rep, n (how many windows): a row per sketch."""
    salts = seeds(sketches)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, at, sizes = [np.zeros(0, dtype=np.int64)], [], []
            for i, words in enumerate(_lists(batch.column(1))):
                found = windows(words)
                if len(found):
                    keys.append(sketch(found, salts, picks))
                    at.append(i)
                    sizes.append(len(found))
            index = pa.array(np.repeat(np.array(at, dtype=np.int64), sketches))
            n = pa.array(np.repeat(np.array(sizes, dtype=np.int32), sketches))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), batch.column(0).take(index), n], ["bucket", "rep", "n"])

    return texts.mapInArrow(run, f"bucket bigint, rep {ROW}, n int")


def _windows(texts: DataFrame) -> DataFrame:
    """id, words array -> id, windows array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [windows(words).view(np.int64) for words in _lists(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["id", "windows"])

    return texts.mapInArrow(run, f"id {ROW}, windows array<bigint>")


def _verified(pairs: DataFrame, similarity: float) -> DataFrame:
    """a, b, left windows, right windows -> the pairs that are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            same = [aligned(x, y, similarity) for x, y in zip(_lists(batch.column(2)), _lists(batch.column(3)), strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(same, pa.bool_()))

    return pairs.mapInArrow(run, f"a {ROW}, b {ROW}")


def alone(nodes: DataFrame) -> DataFrame:
    """id, label: every node by itself."""
    return nodes.select("id", F.col("id").alias("label"))


def components(edges: DataFrame, labels: DataFrame, space: Workspace) -> DataFrame:
    """id, label: the least label that each node reaches, given the labels before `edges` (a, b) came. Both are stored.

    Alternates hooking (every edge offers the smaller label to the larger label's node) and pointer jumping, so the
    rounds grow with the logarithm of a component's size.
    """
    while True:
        left = edges.join(labels.select(F.col("id").alias("a"), F.col("label").alias("la")), "a")
        both = left.join(labels.select(F.col("id").alias("b"), F.col("label").alias("lb")), "b").filter("la != lb")
        hooks = both.select(F.greatest("la", "lb").alias("id"), F.least("la", "lb").alias("to")).groupBy("id").agg(F.min("to").alias("to"))
        hooks = space.put(hooks, "hooks")
        if hooks.isEmpty():
            return labels
        # Jump along the hooks until every hook ends at a node that isn't hooked itself.
        while True:
            further = hooks.select(F.col("id").alias("to"), F.col("to").alias("next"))
            jumped = hooks.join(further, "to", "left").select("id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved"))
            jumped = space.put(jumped, "jumps")
            hooks = jumped.select("id", "to")
            if jumped.filter("moved").isEmpty():
                break
        renamed = labels.join(hooks.select(F.col("id").alias("label"), "to"), "label", "left")
        labels = space.put(renamed.select("id", F.coalesce("to", "label").alias("label")), "labels")


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY,
    sketches: int = SKETCHES, picks: int = PICKS,
) -> DataFrame:
    """__locator, doc_id, keep_id, kept, class_id, group_size per row; class_id is equal for rows of one group."""
    small_batches(docs.sparkSession, 256)
    split = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"), "")

    def hashed(own: Column) -> Column:
        # Rows with equal words share `same`; the one with the largest id stands for them.
        same = F.when(F.size(own) > 0, F.sha2(F.array_join(own, " ").cast("binary"), 256))
        return F.struct(F.transform(own, lambda w: F.xxhash64(w)).alias("words"), same.alias("same"))

    # Bound as a lambda's variable, the words are split once.
    told = F.get(F.transform(F.array(split), hashed), F.lit(0))
    texts = located(docs).select(LOCATOR, F.col(doc_id).cast("bigint").alias("id"), told.alias("told"))
    with Workspace(docs.sparkSession) as space:
        # Texts are read and split once; from here on they are the hashes of their words.
        texts = space.put(texts.select(LOCATOR, "id", "told.*"), "words")
        own = F.sha2(F.concat_ws("/", f"{LOCATOR}.file", f"{LOCATOR}.row"), 256)
        keyed = texts.select(LOCATOR, "id", F.coalesce("same", own).alias("same"))
        classes = keyed.groupBy("same").agg(F.max(F.struct("id", LOCATOR)).alias("top"), F.count(F.lit(1)).alias("n"))
        classes = space.put(classes.select("same", "top", "n", F.col("top")[LOCATOR].alias("rep")), "classes")
        twins = keyed.join(classes.filter("n > 1"), "same").filter(F.col(LOCATOR) != F.col("top")[LOCATOR]).select(LOCATOR)
        unique = without_keys(texts.select(LOCATOR, "words"), space.put(twins, "twins"), LOCATOR)
        flat = unique.filter(F.size("words") > 0).select(F.col(LOCATOR).alias("id"), "words")
        sketched = space.put(_sketches(flat, sketches, picks), "sketches")
        # Each bucket has a pivot of its own choice, so a text of a large group meets many different members of it.
        turn = F.xxhash64("bucket", "rep").alias("turn")
        shared = sketched.groupBy("bucket").agg(F.min(F.struct(turn, "rep", "n")).alias("__p"), F.count(F.lit(1)).alias("__c"))
        shared = shared.filter("__c > 1").select("bucket", F.col("__p.rep").alias("pivot"), F.col("__p.n").alias("pivot_n"))
        members = space.put(sketched.join(shared, "bucket"), "buckets")
        nodes = space.put(members.select(F.col("rep").alias("id")).distinct(), "candidates")
        bodies = space.put(_windows(only_keys(flat, nodes, "id")), "bodies")
        space.drop("sketches")
        labels = _labels(members, nodes, bodies, similarity, space)
        return stored(_memberships(keyed, classes, labels, space), "near-groups")


def _close(n: str, m: str, similarity: float) -> Column:
    """Whether texts of so many windows can be similar at all: no more windows align than the shorter one has."""
    return F.least(n, m) >= F.greatest(n, m) * F.lit(similarity) - F.lit(1e-9)


def _fits(similarity: float) -> Column:
    """Whether texts with their first common window at places i and j of the global order can be similar: of na and nb
    windows, no more than that one and those after it are common."""
    most = 1 + F.least(F.col("na") - 1 - F.col("ia"), F.col("nb") - 1 - F.col("ib"))
    return most >= (F.col("na") + F.col("nb")) * F.lit(similarity / (1 + similarity)) - F.lit(1e-9)


def _compare(pairs: DataFrame, bodies: DataFrame, similarity: float, space: Workspace) -> DataFrame:
    left = pairs.join(bodies.select(F.col("id").alias("a"), F.col("windows").alias("__l")), "a")
    both = left.join(bodies.select(F.col("id").alias("b"), F.col("windows").alias("__r")), "b")
    return space.put(_verified(both.select("a", "b", "__l", "__r"), similarity), "links")


def _window_counts(bodies: DataFrame, cells: int) -> np.ndarray:
    """How many of the texts hold a window of each cell: `cells` numbers, whatever the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, dtype=np.int64)
        for batch in slices(batches):
            for found in _lists(batch.column(0)):
                np.add.at(total, (labelled(found.view(np.uint64)) % np.uint64(cells)).astype(np.int64), 1)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], ["cell", "n"])

    added = bodies.select("windows").mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.ones(cells, dtype=np.int32)
    several = added.filter("n > 1").toArrow()
    counts[several["cell"].to_numpy()] = np.minimum(several["n"].to_numpy(), np.iinfo(np.int32).max)
    return counts


def _prefixes(bodies: DataFrame, similarity: float, cells: int = CELLS) -> DataFrame:
    """bucket (a window), rep, n, i: the windows of each text that a similar one must share one of, with their places in
    the global order. Windows that no other text can hold are left out."""
    counts = bodies.sparkSession.sparkContext.broadcast(_window_counts(bodies, cells))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counts.value
        for batch in slices(batches):
            at, windows_, places, sizes = [], [], [], []
            for row, found in enumerate(_lists(batch.column(1))):
                own = labelled(found.view(np.uint64))
                often = known[(own % np.uint64(cells)).astype(np.int64)]
                order = np.lexsort((own, often))[: prefix_length(len(own), similarity)]
                place = np.flatnonzero(often[order] > 1)
                at.append(np.full(len(place), row))
                windows_.append(own[order[place]].view(np.int64))
                places.append(place)
                sizes.append(np.full(len(place), len(own)))
            if not at:
                continue
            rows = pa.array(np.concatenate(at), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(windows_), pa.int64()), batch.column(0).take(rows),
                    pa.array(np.concatenate(sizes), pa.int32()), pa.array(np.concatenate(places), pa.int32()),
                ],
                ["bucket", "rep", "n", "i"],
            )

    return bodies.select("id", "windows").mapInArrow(run, f"bucket bigint, rep {ROW}, n int, i int")


def _several_groups(rows: DataFrame) -> DataFrame:
    """The buckets whose members have more than one label."""
    return rows.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("bucket")


def _labels(members: DataFrame, nodes: DataFrame, bodies: DataFrame, similarity: float, space: Workspace) -> DataFrame:
    """id, label of the candidates: equal for those that the links of all their buckets connect. No pair is compared twice."""
    first = members.filter((F.col("rep") != F.col("pivot")) & _close("n", "pivot_n", similarity))
    pairs = space.put(first.select(F.least("pivot", "rep").alias("a"), F.greatest("pivot", "rep").alias("b")).distinct(), "pairs-0")
    compared = pairs
    labels = components(_compare(pairs, bodies, similarity, space), space.put(alone(nodes), "labels"), space)
    # Pivots have met all members of their buckets. Others that are apart in one may still be similar.
    others = members.filter(F.col("rep") != F.col("pivot")).join(labels.withColumnRenamed("id", "rep"), "rep")
    crowded = others.join(_several_groups(others), "bucket", "left_semi").select(F.col("rep").alias("id")).distinct()
    crowded = space.put(crowded, "crowded")
    if crowded.isEmpty():
        return labels
    named = space.put(_prefixes(only_keys(bodies, crowded, "id"), similarity), "named")
    space.drop("buckets")
    done, more, turn = None, 1, 0
    while True:
        named = named.select("bucket", "rep", "n", "i").join(labels.withColumnRenamed("id", "rep"), "rep")
        named = space.put(named.join(_several_groups(named), "bucket", "left_semi"), "named")
        nth = F.row_number().over(Window.partitionBy("bucket").orderBy(F.xxhash64("bucket", "rep"), "rep"))
        waiting = named if done is None else named.join(done, ["bucket", "rep"], "left_anti")
        # One more than is needed tells whether others are left.
        turn += 1
        ranked = space.put(waiting.withColumn("__n", nth).filter(F.col("__n") <= more + 1), f"pivots-{turn}")
        chosen, last = ranked.filter(F.col("__n") <= more).drop("__n"), ranked.filter(F.col("__n") > more).isEmpty()
        against = named.select("bucket", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("i").alias("ib"), F.col("label").alias("lb"))
        met = chosen.select("bucket", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("i").alias("ia"), F.col("label").alias("la"))
        met = met.join(against, "bucket").filter((F.col("la") != F.col("lb")) & _close("na", "nb", similarity) & _fits(similarity))
        pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = space.put(pairs.join(compared, ["a", "b"], "left_anti"), f"pairs-{turn}")
        labels = components(_compare(pairs, bodies, similarity, space), labels, space)
        if last:
            return labels
        compared = compared.unionByName(pairs)
        pivots = chosen.select("bucket", "rep")
        done = pivots if done is None else done.unionByName(pivots)
        more *= 32


def _memberships(keyed: DataFrame, classes: DataFrame, labels: DataFrame, space: Workspace) -> DataFrame:
    grouped = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("class_id", F.coalesce("label", "rep"))
    tops = grouped.groupBy("class_id").agg(F.max("top").alias("best"), F.sum("n").alias("group_size"))
    grouped = space.put(grouped.join(tops, "class_id").select("same", "class_id", "best", "group_size"), "groups")
    number = F.concat(F.lower(F.hex("class_id.file")), F.lit("-"), F.col("class_id.row").cast("string"))
    return keyed.join(grouped, "same").select(
        LOCATOR, F.col("id").alias("doc_id"), F.col("best")["id"].alias("keep_id"),
        (F.col(LOCATOR) == F.col("best")[LOCATOR]).alias("kept"), number.alias("class_id"), "group_size",
    )


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each group, with the columns it came with."""
    docs = scanned(docs)
    dropped = near_duplicates(docs, text, doc_id).filter(~F.col("kept")).select(LOCATOR)
    return drop_rows(docs, dropped)
