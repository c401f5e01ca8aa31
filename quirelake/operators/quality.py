"""Data-quality rules and profiles; every report is one pass over its table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.functions import text
from quirelake.functions.numeric import round_exact, round_half_even, round_half_up
from quirelake.functions.scoring import SCORE_EDGES, score_bin
from quirelake.operators.cleaning import merge_single_rows


@dataclass(frozen=True)
class Rule:
    name: str
    broken: Column
    threshold: int = 0


# The names of the rules, as the reports show them.
def book_rules(title="titre", url="url") -> list[Rule]:
    return [
        Rule("Livres sans titre", F.col(title).isNull() | (F.col(title) == "")),
        Rule("URLs manquantes", F.col(url).isNull() | (F.col(url) == "")),
    ]


def fact_rules(price="prix", rating="note_etoiles") -> list[Rule]:
    return [
        Rule("Prix negatifs", F.col(price) < 0),
        Rule("Notes hors plage", ~F.col(rating).between(1, 5)),
    ]


def check_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule: how many rows break it, and whether that is tolerated."""
    counts = df.agg(*[F.count_if(r.broken).alias(f"_{i}") for i, r in enumerate(rules)])
    rows = F.array(*[
        F.struct(
            F.lit(r.name).alias("regle"),
            F.col(f"_{i}").alias("resultat"),
            F.lit(r.threshold).cast("bigint").alias("seuil"),
        )
        for i, r in enumerate(rules)
    ])
    status = F.when(F.col("resultat") <= F.col("seuil"), "OK").otherwise("ECHEC")
    return counts.select(F.inline(rows)).withColumn("statut", status)


def check_star(fact: DataFrame, dim_book: DataFrame) -> DataFrame:
    return check_rules(dim_book, book_rules()).unionByName(check_rules(fact, fact_rules()))


def failed_rules(report: DataFrame) -> DataFrame:
    return report.agg(F.count_if(F.col("statut") == "ECHEC").alias("tests_echoues"))


def star_totals(fact: DataFrame, dim_book: DataFrame) -> DataFrame:
    return merge_single_rows(
        fact.agg(
            F.count(F.lit(1)).alias("total_faits"),
            round_half_up(F.avg("qualite_score")).alias("score_moyen"),
        ),
        dim_book.agg(F.count(F.lit(1)).alias("total_livres")),
    )


def _missing(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    fractional = df.schema[name].dataType.simpleString() in ("double", "float")
    return c.isNull() | F.isnan(c) if fractional else c.isNull()


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and percentage of the columns that hold nulls."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(_missing(df, c)).alias(f"_{i}") for i, c in enumerate(df.columns)],
    )
    rows = F.array(*[
        F.struct(F.lit(c).alias("colonne"), F.col(f"_{i}").alias("nulls")) for i, c in enumerate(df.columns)
    ])
    percent = round_half_even(F.try_divide(F.col("nulls"), F.col("_total")) * 100, 1)
    return counts.select("_total", F.inline(rows)).filter("nulls > 0").select("colonne", "nulls", percent.alias("pct"))


def column_types(df: DataFrame) -> DataFrame:
    """Every column with its type and its number of non-null cells."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[
        F.struct(
            F.lit(f.name).alias("colonne"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"_{i}").alias("non_nuls"),
        )
        for i, f in enumerate(df.schema.fields)
    ])
    return counts.select(F.inline(rows))


# The columns of the preview.
PREVIEW_COLUMNS = [
    "titre", "auteur", "prix", "note_etoiles", "categorie", "langue", "disponibilite",
    "annee_publication", "qualite_score",
]


def preview(df: DataFrame, n: int = 5, order=(), columns=PREVIEW_COLUMNS) -> DataFrame:
    shown = df.orderBy(*order) if order else df
    return shown.limit(n).select(*[c for c in columns if c in df.columns])


def residue_profile(
    df: DataFrame, price="prix", author="auteur", language="langue", description="description"
) -> DataFrame:
    """What cleaning should have removed; absent columns are skipped."""
    checks = {
        price: [
            F.count(F.col(price)).alias("prix_renseignes"),
            F.count_if(F.col(price) < 0).alias("prix_negatifs"),
        ],
        author: [F.count_if(F.col(author) == "Unknown").alias("auteurs_unknown")],
        language: [F.count_if(F.length(F.col(language)) == 3).alias("codes_3_lettres")],
        description: [F.count_if(text.has_repeated_half(F.col(description))).alias("descriptions_dupliquees")],
    }
    present = [c for name, cs in checks.items() if name in df.columns for c in cs]
    return df.agg(F.count(F.lit(1)).alias("total"), *present)


def score_summary(df: DataFrame, score="qualite_score") -> DataFrame:
    return df.agg(
        round_exact(F.avg(score), 1).alias("moyenne"), F.min(score).alias("min"), F.max(score).alias("max")
    )


def score_histogram(df: DataFrame, score="qualite_score", edges=SCORE_EDGES) -> DataFrame:
    """Rows per score bin; empty bins are shown with 0."""
    bins = list(zip(edges, edges[1:]))
    number = score_bin(F.col(score), edges)
    counts = df.agg(*[F.count_if(number == i).alias(f"_{i}") for i, _ in enumerate(bins, start=1)])
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("bin"), F.lit(low).alias("low"), F.lit(high).alias("high"), F.col(f"_{i}").alias("count")
        )
        for i, (low, high) in enumerate(bins, start=1)
    ])
    return counts.select(F.inline(rows))


def category_stats(
    df: DataFrame, category="categorie", title="titre", means=("prix", "note_etoiles", "qualite_score")
) -> DataFrame:
    present = [m for m in means if m in df.columns]
    return (
        df.filter(F.col(category).isNotNull())
        .groupBy(category)
        .agg(F.count(title).alias("nb_livres"), *[round_half_even(F.avg(m)).alias(m) for m in present])
    )
