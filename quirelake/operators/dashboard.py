"""Data behind the dashboard's figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.functions.numeric import round_exact
from quirelake.operators.cleaning import merge_single_rows


def headline(kpi: DataFrame, flat: DataFrame) -> DataFrame:
    """Total books, unweighted means over the category means, number of genres."""
    return merge_single_rows(
        flat.agg(F.count(F.lit(1)).alias("total_livres")),
        kpi.agg(
            round_exact(F.avg("prix_moyen"), 2).alias("prix_moyen"),
            round_exact(F.avg("note_moyenne"), 1).alias("note_moyenne"),
            F.count(F.lit(1)).alias("nb_genres"),
        ),
    )


def books_per_rating(distribution: DataFrame) -> DataFrame:
    return distribution.groupBy("note_etoiles").agg(F.sum("nb_livres").alias("nb_livres"))


def largest_genres(kpi: DataFrame, n: int = 10) -> DataFrame:
    return kpi.orderBy(F.col("nb_livres").desc(), "categorie").limit(n).select("categorie", "nb_livres")


def dearest_genres(kpi: DataFrame, n: int = 10) -> DataFrame:
    return kpi.orderBy(F.col("prix_moyen").desc_nulls_last(), "categorie").limit(n).select("categorie", "prix_moyen")


def top_books(top: DataFrame, n: int = 10) -> DataFrame:
    columns = ["titre", "auteur", "prix", "note_etoiles", "categorie"]  # fixed values: the list that is shown
    return top.orderBy("categorie", "rang").limit(n).select(*columns)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs, nulls left out, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), column)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


# The columns of the catalogue page.
CATALOGUE_COLUMNS = ("titre", "auteur", "prix", "note_etoiles", "categorie", "langue")


def catalogue(
    flat: DataFrame, genre: str | None = None, n: int = 100, order=("titre", "url"), category="categorie",
    columns=CATALOGUE_COLUMNS,
) -> DataFrame:
    """First n books, of one genre or of all; `order` makes "first" definite."""
    chosen = flat if genre is None else flat.filter(F.col(category) == genre)
    return chosen.orderBy(*order).limit(n).select(*columns)
