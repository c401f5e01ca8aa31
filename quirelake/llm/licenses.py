"""License scan: exact set-similarity join of text blocks with license templates. DataFrame functions only.

A block is a run of consecutive words of a paragraph, wherever its lines break; a paragraph ends at a blank line. A run is as
long as the largest template may be with `1 - threshold` of foreign words, and starts at any word; a shorter paragraph is one
block. A block is taken as its set of words, a template as the set of words of a known notice. A block matches when it
holds at least `threshold` of the template's words (containment). Tokens are ordered by the number of paragraphs of the
corpus that hold them, rarest first. A matching block must hold one of the first |T| - need + 1 tokens of that order
(prefix filter), at least `need` words at all (length filter), and, counted from the first shared token on, enough words
must remain on both sides (positional filter). A paragraph goes through the filters as a whole, which holds all words of
its runs, and its runs are looked at if it passes: the whole intersection verifies them, so the filters lose nothing.
Beside the join, base phrases are looked up in the words of the whole text.

Texts are split in whole, however long; a paragraph may be a whole text. Of equal containments none is preferred: labels
are a set and the score is the largest.
Null text counts as empty: no words, no places, no labels, score 0. Repeated rows give equal rows; an empty table gives
an empty result; further columns of the input are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.llm.common import LOCATOR, located

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before lower-casing.
RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices as they stand in files, by label.
TEMPLATES = {
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mit-notice": "Released under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction"
    ),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "reserved": "All rights reserved. No part of this publication may be reproduced without permission.",
}
THRESHOLD = 0.8
#: Between paragraphs: lines without a sign.
BLANK_LINES = r"\n(?:[\x20\x09\x0B-\x0D]*\n)+"


def _lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, NOT_WORD), lambda w: w != "")


def template_words(text: str) -> list[str]:
    words, word = [], ""
    for c in text.lower() + " ":
        if c.isalnum():
            word += c
        elif word:
            words.append(word)
            word = ""
    return sorted(set(words))


def paragraphs(rows: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """`keep` and block, one row per paragraph of the whole texts."""
    parts = F.split(F.coalesce(F.col(text), F.lit("")), BLANK_LINES)
    return rows.select(*keep, F.explode(parts).alias("block"))


def run_size(templates: dict[str, str], threshold: float) -> int:
    """Words in a run: the largest template's, repeated ones too, and as many foreign ones as the threshold lets miss."""
    return math.ceil(max((len(re.findall(r"[^\W_]+", t)) for t in templates.values()), default=1) / threshold)


def token_order(rows: DataFrame, templates: dict[str, str], text: str = "text") -> dict[str, int]:
    """In how many paragraphs of the whole corpus each template word stands. Bounded by the templates' vocabulary."""
    vocabulary = sorted({w for t in templates.values() for w in template_words(t)})
    known = F.array(*[F.lit(w) for w in vocabulary]).cast("array<string>")
    found = paragraphs(rows, text, []).select(
        F.explode(F.array_intersect(F.split(_lower(F.col("block")), NOT_WORD), known)).alias("token")
    )
    counted = {r["token"]: r["n"] for r in found.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: counted.get(w, 0) for w in vocabulary}


def prefix_index(templates: dict[str, str], counts: dict[str, int], threshold: float) -> list[tuple]:
    """(token, label, position in the template's order, template size, words needed) of all prefix tokens."""
    index = []
    for label, notice in templates.items():
        words = sorted(template_words(notice), key=lambda w: (counts[w], w))
        need = math.ceil(threshold * len(words) - 1e-9)
        index += [(w, label, i, len(words), need) for i, w in enumerate(words[: len(words) - need + 1])]
    return index


def matches(
    rows: DataFrame, text: str, keep: list[str], templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """`keep`, label, containment: the best block of every paragraph that has one with `threshold` of a template's words.

    Two passes over the texts count the templates' words and join the paragraphs. Only paragraphs with a prefix token
    leave their task's row; the index of prefix tokens is as small as the templates.
    """
    spark = rows.sparkSession
    counts = token_order(rows, templates, text)
    order = sorted(counts, key=lambda w: (counts[w], w))
    rank = {w: i for i, w in enumerate(order)}
    index_rows = prefix_index(templates, counts, threshold)
    least = min((need for *_, need in index_rows), default=1)
    schema = "__token string, label string, __i int, __size int, __need int, __all array<string>"
    whole = {label: sorted(template_words(notice), key=rank.get) for label, notice in templates.items()}
    index = spark.createDataFrame([(*r, whole[r[1]]) for r in index_rows], schema)
    vocabulary = F.array(*[F.lit(w) for w in order]).cast("array<string>")
    prefix = F.array(*[F.lit(w) for w in sorted({r[0] for r in index_rows})]).cast("array<string>")

    def candidates(found: DataFrame) -> DataFrame:
        # The block's words that any template has, rarest first: array_intersect keeps the first array's order.
        found = found.withColumn("__b", F.array_intersect(vocabulary, F.split(_lower(F.col("block")), NOT_WORD)))
        return found.filter((F.size("__b") >= least) & F.arrays_overlap("__b", prefix))

    def joined(found: DataFrame) -> DataFrame:
        tokens = found.select(*found.columns, F.posexplode("__b").alias("__j", "__token"))
        pairs = tokens.join(F.broadcast(index), "__token").filter(
            (F.size("__b") >= F.col("__need"))
            & (F.least(F.col("__size") - F.col("__i"), F.size("__b") - F.col("__j")) >= F.col("__need"))
        )
        return pairs.withColumn("__both", F.array_intersect("__b", "__all")).filter(F.size("__both") >= F.col("__need"))

    run = run_size(templates, threshold)
    numbered = F.transform(_words(_lower(F.col("block"))), lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    known = F.filter(numbered, lambda x: F.array_contains(vocabulary, x["word"]))
    # The first shared word is in the prefix: with it, a paragraph meets a template once.
    whole_fits = joined(candidates(paragraphs(rows, text, keep)).withColumn("__known", known).drop("block")).filter(
        F.get("__both", F.lit(0)) == F.col("__token")
    )

    def held(own: Column) -> Column:
        def near(first: Column, i: Column) -> Column:
            return F.filter(F.slice(own, i + 1, run), lambda x: x["at"] < first["at"] + run)

        return F.array_max(F.transform(own, lambda x, i: F.size(F.array_distinct(F.transform(near(x, i), lambda y: y["word"])))))

    # Bound as a lambda's variable, the template's words are found once and not once for every run.
    own = F.array(F.filter("__known", lambda x: F.array_contains("__all", x["word"])))
    runs = whole_fits.withColumn("__held", F.get(F.transform(own, held), F.lit(0))).filter(F.col("__held") >= F.col("__need"))
    return runs.select(*keep, "label", (F.col("__held") / F.col("__size")).alias("containment"))


def _places(words: Column, phrase: str, label: str) -> Column:
    first, *rest = phrase.split(" ")

    def at(w: Column, i: Column) -> Column:
        here = w == first
        for k, word in enumerate(rest, 1):
            here = here & F.coalesce(F.get(words, i + k) == word, F.lit(False))
        return F.when(here, F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))

    return F.filter(F.transform(words, at), lambda x: x.isNotNull())


def phrase_places(rows: DataFrame, text: str, keep: list[str], phrases: dict[str, str] = PHRASES) -> DataFrame:
    """`keep`, n_words, and __at: where phrases stand, as (word number, label)."""
    gap = r"[\x00-\x2F\x3A-\x60\x7B-\x7F&&[^A-Z]]+"
    maybe = "(?i)" + "|".join(p.replace(" ", gap) for p in phrases)
    t = F.coalesce(F.col(text), F.lit(""))
    found = rows.select(
        *keep,
        F.size(F.array_remove(F.split(t, RAW_GAP), "")).cast("long").alias("n_words"),
        F.when(t.rlike(maybe), _words(_lower(t))).otherwise(F.array().cast("array<string>")).alias("__words"),
    )
    places = F.concat(*[_places(F.col("__words"), p, label) for p, label in phrases.items()])
    return found.withColumn("__at", F.when(F.size("__words") > 0, places).otherwise(F.array().cast("array<struct<at:bigint,label:string>>"))).drop("__words")


def scan(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", templates: dict[str, str] = TEMPLATES,
    phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: counts and places of the base phrases, all labels, and the best containment.

    A base phrase counts as containment 1. Documents are told apart by where their row lies, not by their ids.
    """
    rows = located(docs).select(LOCATOR, F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
    base = phrase_places(rows, "__text", [LOCATOR, "doc_id"], phrases)
    found = matches(rows, "__text", [LOCATOR], templates, threshold).groupBy(LOCATOR).agg(
        F.collect_set("label").alias("__labels"), F.max("containment").alias("__best")
    )
    none = F.array().cast("array<string>")
    base_labels = F.array_distinct(F.transform("__at", lambda x: x["label"]))
    joined = base.join(found, LOCATOR, "left")
    return joined.select(
        "doc_id", "n_words", F.size("__at").cast("long").alias("n_base"),
        F.array_min(F.transform("__at", lambda x: x["at"])).alias("first_word"),
        F.array_max(F.transform("__at", lambda x: x["at"])).alias("last_word"),
        F.array_join(F.sort_array(base_labels), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base_labels, F.coalesce("__labels", none))), ",").alias("labels"),
        F.greatest(F.when(F.size("__at") > 0, 1.0).otherwise(0.0), F.coalesce("__best", F.lit(0.0))).alias("score"),
    )
