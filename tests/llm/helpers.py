"""Small tables with every kind of odd row, and brute-force versions to hold results against."""

from __future__ import annotations

import random

# Columns named like ones that operators make or use.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, words string, kept string, "
    "length string, file string, row string, n int, bucket string, label string, __locator string, __slot int, __words string"
)


def documents(spark, rows):
    """(doc_id, text) or (doc_id, text, lang) rows as a documents table with clashing columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, *[None] * 14) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def sentence(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n)]


def odd_rows() -> list[tuple]:
    """Nulls, empty and long texts, ties and repeated rows."""
    rng = random.Random(5)
    long = " ".join(sentence(rng, 20_000))
    text = " ".join(sentence(rng, 60)) + "\n" + " ".join(sentence(rng, 60))
    return [
        (1, text), (2, text), (2, text), (3, None), (4, ""), (4, ""), (None, text), (None, None), (5, long), (6, long + " x"),
        (7, "\n\n \n"), (8, "one"), (9, "one"), (10, "two words"), (11, "!!! ??? ..."), (12, text.replace(" ", "  ", 3)),
    ]


def bag(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
