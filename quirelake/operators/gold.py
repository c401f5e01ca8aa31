"""The five Gold tables.

Group keys that are null are left out, a sum over nulls only is 0, and averages
are rounded half to even. Partial aggregation happens before every shuffle, so
a category that holds a third of the rows costs one row per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirelake.functions.numeric import round_half_even
from quirelake.schemas import FLAT_COLUMNS, GOLD_ORDER


def _tag(df: DataFrame, source: str | None, run_ts: str | None) -> DataFrame:
    tags = {"source": source, "date_gold": run_ts}
    return df.withColumns({k: F.lit(v) for k, v in tags.items() if v is not None})


def kpi_by_category(
    df: DataFrame, category="categorie", title="titre", price="prix", rating="note_etoiles",
    reviews="nb_avis", source: str | None = None, run_ts: str | None = None,
) -> DataFrame:
    kpi = (
        df.filter(F.col(category).isNotNull())
        .groupBy(F.col(category).alias("categorie"))
        .agg(
            F.count(title).alias("nb_livres"),
            round_half_even(F.avg(price)).alias("prix_moyen"),
            round_half_even(F.min(price)).alias("prix_min"),
            round_half_even(F.max(price)).alias("prix_max"),
            round_half_even(F.avg(rating)).alias("note_moyenne"),
            F.coalesce(F.sum(reviews), F.lit(0)).cast("bigint").alias("total_avis"),
        )
    )
    return _tag(kpi, source, run_ts)


def kpi_by_dimension(
    fact: DataFrame, dimension: DataFrame, fk: str, id_name: str, category: str, title: str, price: str,
    rating: str, reviews: str, source: str | None = None, run_ts: str | None = None,
) -> DataFrame:
    """`kpi_by_category` where the category is an attribute of a joined table.

    Both sides are projected to what is needed, under names of their own, so
    columns of equal names don't meet. Spark chooses the join by its sizes.
    """
    facts = fact.select(
        F.col(fk).alias("_fk"), F.col(title).alias("_title"), F.col(price).alias("_price"),
        F.col(rating).alias("_rating"), F.col(reviews).alias("_reviews"),
    )
    named = dimension.select(F.col(id_name).alias("_id"), F.col(category).alias("_category"))
    joined = facts.join(named.filter(F.col("_category").isNotNull()), F.col("_fk") == F.col("_id"))
    return kpi_by_category(joined, "_category", "_title", "_price", "_rating", "_reviews", source, run_ts)


def rating_distribution(
    df: DataFrame, rating="note_etoiles", category="categorie", title="titre", price="prix",
    source: str | None = None, run_ts: str | None = None,
) -> DataFrame:
    counts = (
        df.filter(F.col(rating).isNotNull() & F.col(category).isNotNull())
        .groupBy(F.col(rating).alias("note_etoiles"), F.col(category).alias("categorie"))
        .agg(F.count(title).alias("nb_livres"), round_half_even(F.avg(price)).alias("prix_moyen"))
    )
    return _tag(counts, source, run_ts)


def top_by_price(
    df: DataFrame, category="categorie", price="prix", ties=("url",), n: int = 10,
    columns=("titre", "auteur", "prix", "note_etoiles", "isbn", "url"),
    source: str | None = None, run_ts: str | None = None,
) -> DataFrame:
    """The n dearest rows per category with their rank.

    Spark limits each group inside the map tasks (WindowGroupLimit), so no task
    receives more than n rows per category and map task.
    """
    by_price = Window.partitionBy(category).orderBy(F.col(price).desc(), *ties)
    top = (
        df.filter(F.col(category).isNotNull() & F.col(price).isNotNull())
        .withColumn("rang", F.row_number().over(by_price))
        .filter(F.col("rang") <= n)
        .select(F.col(category).alias("categorie"), "rang", *columns)
    )
    return _tag(top, source, run_ts)


def kpi_by_author(
    df: DataFrame, author="auteur", title="titre", reviews="nb_avis", year="annee_publication",
    source: str | None = None, run_ts: str | None = None,
) -> DataFrame:
    kpi = (
        df.filter(F.col(author).isNotNull())
        .groupBy(F.col(author).alias("auteur"))
        .agg(
            F.count(title).alias("nb_livres"),
            F.coalesce(F.sum(reviews), F.lit(0)).cast("bigint").alias("nb_avis_total"),
            F.min(year).alias("annee_min"),
            F.max(year).alias("annee_max"),
        )
    )
    return _tag(kpi, source, run_ts)


def flat_view(*sources: DataFrame, columns=FLAT_COLUMNS, run_ts: str | None = None) -> DataFrame:
    """All sources below each other on the chosen columns; absent ones are null."""
    parts = [df.select(*[c for c in columns if c in df.columns]) for df in sources]
    flat = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _tag(flat, None, run_ts)


def count_per_source(flat: DataFrame, names, source: str = "source") -> DataFrame:
    """Total rows and the rows of each named source, in one pass."""
    counts = [F.count_if(F.col(source) == name).alias(alias) for alias, name in names.items()]
    return flat.agg(F.count(F.lit(1)).alias("total"), *counts)


def in_order(df: DataFrame, table: str) -> DataFrame:
    """A Gold table in its presentation order; files of a table carry no order."""
    order = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in GOLD_ORDER[table]]
    return df.orderBy(*order) if order else df


def gold_tables(shop: DataFrame, library: DataFrame, shop_name: str, library_name: str, run_ts: str):
    """Table name -> DataFrame, all five over the two Silver tables."""
    return {
        "kpi_par_categorie": kpi_by_category(shop, source=shop_name, run_ts=run_ts),
        "distribution_notes": rating_distribution(shop, source=shop_name, run_ts=run_ts),
        "top_livres_chers": top_by_price(shop, source=shop_name, run_ts=run_ts),
        "kpi_par_auteur": kpi_by_author(library, source=library_name, run_ts=run_ts),
        "livres_flat": flat_view(shop, library, run_ts=run_ts),
    }
