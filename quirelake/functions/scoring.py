"""Quality score of a record."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (column, weight, must the text also be non-empty).
BOOK_WEIGHTS = [
    ("titre", 20, True),
    ("auteur", 20, True),
    ("prix", 20, False),
    ("note_etoiles", 20, False),
    ("annee_publication", 10, False),
    ("isbn", 10, True),
]

SCORE_EDGES = [0, 20, 40, 60, 80, 100]


def quality_score(weights=BOOK_WEIGHTS) -> Column:
    """Sum of the weights of the fields that are present; a zero counts as present."""

    def part(name: str, weight: int, non_empty: bool) -> Column:
        present = F.col(name).isNotNull()
        if non_empty:
            present = present & (F.col(name) != "")
        return F.when(present, F.lit(weight)).otherwise(F.lit(0))

    return reduce(add, [part(*w) for w in weights])


def score_bin(c: Column, edges=SCORE_EDGES) -> Column:
    """1-based bin, closed on the right, the lowest edge included; null outside."""
    bins = None
    for number, (low, high) in enumerate(zip(edges, edges[1:]), start=1):
        inside = (c >= low if number == 1 else c > low) & (c <= high)
        bins = F.when(inside, number) if bins is None else bins.when(inside, number)
    return bins
