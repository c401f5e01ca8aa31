"""Phrase collocations from a weighted de Bruijn graph of words.

Texts are lower-cased (A-Z only), cut at `[.,;:!?\\x0A-\\x0D]` into pieces and at spaces and tabs into words, everything
per language. Nodes of the graph are word pairs; an edge is a run of `LONGEST` words, which leads from its first pair to
its last and weighs as often as it occurs. Only these longest grams and the ends of pieces (a pair and a word that have
nothing after them) are counted over the text. All shorter counts follow from them: a pair's count is the flow out of its
node plus the pieces that end there, a word's count the flow out of all its pairs plus the pieces that end with it.

Map tasks count grams of their rows before anything moves and send them as blocks of sorted lines, dealt by a hash of the
first word, so edges and flows are summed in one place after one shuffle. Grams that start with a very frequent word are
dealt by their pair, and by the whole gram if its second word is very frequent too; their flows are summed in a second,
small step. Which words are frequent is read off a sample of rows: it decides about places only, never about results.

Nodes through which all flow comes in by one edge and leaves by one edge are inner nodes of unary paths. Paths are
compacted by pointer doubling into one row each: its words and its weight. A pair inside a path has the path's weight and
always lies in an edge of that weight, so it can't be a phrase of its own; other pairs are held against their heaviest
edges. Edges are read back off the paths.

A null language is `und` (and shares its counts with a language named so). Null and empty texts have no words. Texts of
any length are read in whole; a piece without cuts may be a whole text. Repeated rows count each time. An empty table
gives an empty result. Of equal scores and counts the phrase that is smaller in UTF-8 bytes comes first. Counts are exact
up to 10^15; scores are computed in 38-digit decimals. Only the text and language columns are read.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import compress, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelake.llm.common import small_batches, stored

LONGEST = 3
LEAST = 10
TOP = 2000
#: Percent of a phrase's occurrences that a longer one must hold to stand for it.
ABSORBED = 50
NO_LANGUAGE = "und"
#: Grams that a map task holds before it sends them.
HELD = 200_000
#: Rows of the sample that frequent words are read from, and how many of these words are kept.
SAMPLE_ROWS, FREQUENT_WORDS = 2_000, 128
#: Salts that share the search for the best phrases of one language.
SALTS = 32
WORD, PAIR, EDGE = 1, 2, 3

#: Stands after the last word of a piece; words have no such sign, since texts are cut there.
END = b"."
_CUTS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", END * 9)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def grams(text: bytes) -> Iterator[bytes]:
    """The longest gram that starts at each word of a text; near the end of a piece it is filled up with END."""
    filling = [END] * (LONGEST - 1)
    words = text.lower().translate(_CUTS).replace(END, b" " + b" ".join(filling) + b" ").split() + filling
    runs = zip(*(islice(words, i, None) for i in range(LONGEST)), strict=False)
    return compress(map(b" ".join, runs), map(END.__ne__, words))


def _parts(
    listed: pa.Array, first: np.ndarray, words: list[bytes], lang: str, parts: int, frequent: frozenset[bytes]
) -> tuple[np.ndarray, np.ndarray]:
    """The part of each gram, and of each of `words`, which `first` numbers as the grams' first words."""
    seed = zlib.crc32(lang.encode())
    home = np.fromiter((zlib.crc32(w, seed) % parts for w in words), np.int64, len(words))
    part = home[first]
    often = np.flatnonzero(np.fromiter((w in frequent for w in words), bool, len(words))[first])
    for i, gram in zip(often.tolist(), listed.take(pa.array(often)).cast(pa.binary()).to_pylist(), strict=True):
        pair = gram.split(b" ", 2)
        whole = len(pair) == LONGEST and pair[1] in frequent
        part[i] = zlib.crc32(gram if whole else b" ".join(pair[:2]), seed) % parts
    return part, home


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts rows with equal first two keys together, and where a run of them starts."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys[:2]], axis=0)
    return order, np.flatnonzero(new)


def _blocks(counts: dict[str, Counter], parts: int, frequent: frozenset[bytes]) -> Iterator[pa.RecordBatch]:
    """Counted grams, and the flow that leaves through each first word, as blocks of lines: one block for each language,
    part, kind and count."""
    for lang, counter in counts.items():
        if not counter:
            continue
        n = np.fromiter(counter.values(), np.int64, len(counter))
        listed = pc.ascii_rtrim(pa.array(list(counter), pa.binary()).cast(pa.string()), characters=" " + END.decode())
        coded = pc.list_element(pc.split_pattern(listed, " ", max_splits=1), 0).dictionary_encode()
        first, words = coded.indices.to_numpy(), coded.dictionary
        part, home = _parts(listed, first, words.cast(pa.binary()).to_pylist(), lang, parts, frequent)
        flow = np.zeros(len(words), dtype=np.int64)
        np.add.at(flow, first, n)
        for kind, lines, where, weights, near in ((EDGE, listed, part, n, first), (WORD, words, home, flow, np.arange(len(words)))):
            order, starts = _runs(where, weights, near)
            bounds = pa.array(np.append(starts, len(order)), pa.int32())
            blocks = pc.binary_join(pa.ListArray.from_arrays(bounds, lines.take(pa.array(order))), "\n")
            heads = order[starts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(heads), pa.string()), pa.array(where[heads], pa.int32()),
                    pa.array(np.full(len(heads), kind), pa.int32()), pa.array(weights[heads], pa.int64()), blocks,
                ],
                ["lang", "part", "kind", "n", "block"],
            )


def frequent_words(texts: DataFrame, rows: int = SAMPLE_ROWS, most: int = FREQUENT_WORDS) -> list[str]:
    """The most frequent words of about `rows` rows. Where edges are dealt depends on it, results don't."""
    share = min(1.0, rows / max(texts.count(), 1))
    words = texts.sample(share, seed=1).select(F.explode(F.split(F.translate("text", UPPER, LOWER), r"[\s.,;:!?]+")).alias("word"))
    ranked = words.filter("word != ''").groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word")
    return [r["word"] for r in ranked.limit(most).collect()]


def counted(texts: DataFrame, least: int = LEAST, frequent: list[str] | None = None) -> DataFrame:
    """lang, kind, phrase, n of (lang, text): all words, and the pairs and edges that occur `least` times.

    Counted are edges and piece ends; pairs and words come from node flow.
    """
    spark = texts.sparkSession
    small_batches(spark)
    known = frozenset(w.encode() for w in (frequent_words(texts) if frequent is None else frequent))
    parts = max(256, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            bodies = batch.column(1).cast(pa.binary())
            for lang, body in zip(batch.column(0), bodies, strict=True):
                counts[lang.as_py()].update(grams(body.as_py()))
                if sum(map(len, counts.values())) > HELD:
                    yield from _blocks(counts, parts, known)
                    counts.clear()
        if counts:
            yield from _blocks(counts, parts, known)

    blocks = texts.select("lang", "text").mapInArrow(run, "lang string, part int, kind int, n bigint, block string")
    lines = blocks.repartition("part").select("lang", "part", "kind", "n", F.explode(F.split("block", "\n")).alias("gram"))
    # The rows are dealt by part: these sums need no further exchange.
    counts = lines.groupBy("lang", "part", "kind", "gram").agg(F.sum("n").alias("n"))
    word, pair, gram, is_word = F.substring_index("gram", " ", 1), F.substring_index("gram", " ", 2), F.col("gram"), F.col("kind") == WORD
    flows = counts.select(
        "lang", "part", "n",
        F.explode(F.array(
            F.struct(F.when(is_word, WORD).otherwise(PAIR).alias("kind"), F.when(is_word, gram).when(word != gram, pair).alias("phrase")),
            F.struct(F.lit(EDGE).alias("kind"), F.when(~is_word & (F.col("n") >= least) & (pair != gram), gram).alias("phrase")),
        )).alias("key"),
    )
    flows = flows.select("lang", "part", "key.kind", "key.phrase", "n").filter("phrase IS NOT NULL")
    here = flows.groupBy("lang", "part", "kind", "phrase").agg(F.sum("n").alias("n"))
    # A pair of two frequent words has its flow in several parts.
    names = [w.decode() for w in sorted(known)]
    elsewhere = F.substring_index("phrase", " ", 1).isin(names) & F.substring_index("phrase", " ", -1).isin(names)
    here = here.filter((F.col("kind") == WORD) | (F.col("n") >= least) | ((F.col("kind") == PAIR) & elsewhere))
    sums = here.groupBy("lang", "kind", "phrase").agg(F.sum("n").alias("n"))
    return stored(sums.filter((F.col("kind") == WORD) | (F.col("n") >= least)), "graph")


def nodes_of(graph: DataFrame) -> DataFrame:
    """lang, phrase, n, heaviest, inner: the pairs, their heaviest edge, and whether all flow passes through two edges."""
    edges = graph.filter(F.col("kind") == EDGE)
    into = edges.groupBy("lang", F.substring_index("phrase", " ", -2).alias("phrase")).agg(F.max("n").alias("into"))
    out = edges.groupBy("lang", F.substring_index("phrase", " ", 2).alias("phrase")).agg(F.max("n").alias("out"))
    joined = graph.filter(F.col("kind") == PAIR).join(into, ["lang", "phrase"], "left").join(out, ["lang", "phrase"], "left")
    heaviest = F.coalesce(F.greatest("into", "out"), F.lit(0))
    inner = F.coalesce((F.col("into") == F.col("n")) & (F.col("out") == F.col("n")), F.lit(False))
    return stored(joined.select("lang", "phrase", "n", heaviest.alias("heaviest"), inner.alias("inner")), "nodes")


def paths(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """lang, words, n, n_edges: the edges, with unary paths compacted into one row each.

    Every edge points at the one before it if their common node is an inner one; pointers double until all are at the
    first edge of their path. An inner node has no other edge and no piece starts or ends there, so a path is no longer
    than a piece, and there are no circles.
    """
    edges = graph.filter(F.col("kind") == EDGE).select("lang", F.col("phrase").alias("edge"), "n")
    inner = nodes.filter("inner").select("lang", F.col("phrase").alias("node"))
    before = edges.select("lang", F.substring_index("edge", " ", -2).alias("node"), F.col("edge").alias("previous"))
    linked = edges.withColumn("node", F.substring_index("edge", " ", 2)).join(inner.join(before, ["lang", "node"]), ["lang", "node"], "left")
    hops = F.when(F.col("previous").isNull(), 0).otherwise(1)
    at = stored(linked.select("lang", "edge", "n", F.coalesce("previous", "edge").alias("to"), hops.alias("hops")), "pointers")
    while not at.filter("hops > 0").isEmpty():
        further = at.select("lang", F.col("edge").alias("to"), F.col("to").alias("next"), F.col("hops").alias("more"))
        # First edges point at themselves with no hop, so they stay where they are.
        doubled = at.join(further, ["lang", "to"]).select("lang", "edge", "n", F.col("next").alias("to"), (F.col("hops") + F.col("more")).alias("hops"), "more")
        doubled = stored(doubled, "pointers")
        at = doubled.drop("more")
        if doubled.filter("more > 0").isEmpty():
            break
    chain = F.sort_array(F.collect_list(F.struct("hops", "edge")))
    found = at.groupBy("lang", "to").agg(F.max("n").alias("n"), chain.alias("chain"))
    ends = F.transform("chain", lambda x: F.substring_index(x["edge"], " ", -1))
    words = F.concat_ws(" ", F.substring_index("to", " ", 2), F.array_join(ends, " "))
    return stored(found.select("lang", words.alias("words"), "n", F.size("chain").alias("n_edges")), "paths")


def edges_of(compacted: DataFrame) -> DataFrame:
    """lang, phrase, n: the edges of compacted paths."""
    words = F.split("words", " ")
    runs = F.transform(F.sequence(F.lit(1), F.size("list") - (LONGEST - 1)), lambda i: F.array_join(F.slice("list", i, LONGEST), " "))
    return compacted.withColumn("list", words).select("lang", F.explode(runs).alias("phrase"), "n")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly."""
    a, left, right = (c.cast("decimal(15,0)") for c in (a, left, right))
    top = (F.lit(1_000_000).cast("decimal(7,0)") * (a * a)).cast("decimal(38,0)")
    bottom = (left * right).cast("decimal(38,0)")
    return F.call_function("div", top, bottom).cast("bigint")


def scored(candidates: DataFrame, graph: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score: each (lang, phrase, a) by its lowest-scoring cut, the shorter first part on ties."""
    words = F.split("phrase", " ")
    cuts = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice(words, F.lit(1), k), " ").alias("left"),
        F.array_join(F.slice(words, k + 1, F.size(words)), " ").alias("right"),
    ))
    parts = candidates.select("lang", "phrase", "a", F.explode(cuts).alias("cut")).select("lang", "phrase", "a", "cut.*")
    counts = graph.filter(F.col("kind") < EDGE)
    parts = parts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    parts = parts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    best = F.min(F.struct(score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("best")
    return parts.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def best_of_each(found: DataFrame, top: int) -> DataFrame:
    """The first `top` rows of each language with their rank. Salts keep what reaches one task bounded."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = found.withColumn("__salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    near = salted.withColumn("__n", F.row_number().over(Window.partitionBy("lang", "__salt").orderBy(*order))).filter(F.col("__n") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return near.drop("__salt", "__n").withColumn("rank", rank.cast("bigint")).filter(F.col("rank") <= top)


def mine(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, absorbed: int = ABSORBED,
    frequent: list[str] | None = None,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` collocations of each language.

    Phrases of two or three words that occur `least` times, without those of which a longer one holds `absorbed` percent.
    """
    texts = docs.select(F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    graph = counted(texts, least, frequent)
    nodes = nodes_of(graph)
    free = nodes.filter(~F.col("inner") & (100 * F.col("heaviest") < absorbed * F.col("n")))
    candidates = free.select("lang", "phrase", F.col("n").alias("a")).unionByName(
        edges_of(paths(graph, nodes)).withColumnRenamed("n", "a")
    )
    chosen = best_of_each(scored(candidates, graph), top)
    totals = graph.filter(F.col("kind") == WORD).groupBy("lang").agg(F.sum("n").alias("n"))
    return chosen.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
