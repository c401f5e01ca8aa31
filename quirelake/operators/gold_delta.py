"""KPIs per category kept up to date by signed changes, with retractions.

The state has a row per category: counts and exact sums, which a change adds to or takes from, and the least and greatest
price. An extreme follows additions; only categories that lose a price at their extreme have it read again from Silver. A
category without rows leaves the state. The KPIs of a state are those of `gold.kpi_by_category` over all rows.

Prices and ratings are added as decimals with six places, so that what is taken away is exactly what was added. A mean of
this sum can differ from one of doubles where it lies at a tie of the rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.functions.numeric import round_half_even

_MEASURES = ["categorie", "titre", "prix", "note_etoiles", "nb_avis"]
_SUMS = ["n_rows", "n_titles", "n_prices", "n_ratings", "prices", "ratings", "reviews"]
STATE = (
    "categorie string, n_rows bigint, n_titles bigint, n_prices bigint, n_ratings bigint, prices decimal(38,6), "
    "ratings decimal(38,6), reviews bigint, lowest double, highest double"
)


def changes(before: DataFrame, after: DataFrame, key: str = "url") -> DataFrame:
    """key, the measures, and `sign`: -1 for a row that is no more, 1 for one that is new. Rows that stay cancel out."""
    signed = before.select(key, *_MEASURES, F.lit(-1).alias("sign")).unionByName(after.select(key, *_MEASURES, F.lit(1).alias("sign")))
    return signed.groupBy(key, *_MEASURES).agg(F.sum("sign").alias("sign")).filter("sign <> 0")


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(22,6)")


def _deltas(changed: DataFrame) -> DataFrame:
    """One row per category: what the changes add up to, and the extremes of what comes and of what goes."""
    sign = F.col("sign")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    def counted(c: str) -> Column:
        return total(F.when(F.col(c).isNotNull(), sign))

    comes, goes = F.when(sign > 0, F.col("prix")), F.when(sign < 0, F.col("prix"))
    return changed.filter(F.col("categorie").isNotNull()).groupBy("categorie").agg(
        total(sign).alias("n_rows"), counted("titre").alias("n_titles"), counted("prix").alias("n_prices"),
        counted("note_etoiles").alias("n_ratings"), total(_exact("prix") * sign).cast("decimal(38,6)").alias("prices"),
        total(_exact("note_etoiles") * sign).cast("decimal(38,6)").alias("ratings"), total(F.col("nb_avis") * sign).cast("bigint").alias("reviews"),
        F.min(comes).alias("_lowest_in"), F.max(comes).alias("_highest_in"), F.min(goes).alias("_lowest_out"), F.max(goes).alias("_highest_out"),
    )


def apply_changes(state: DataFrame, changed: DataFrame, after: DataFrame) -> DataFrame:
    """The state after the changes. `after` is Silver as it is then; of it, only categories that lost an extreme are read."""
    old = state.select("categorie", *[F.col(c).alias(f"_{c}") for c in [*_SUMS, "lowest", "highest"]])
    both = old.join(_deltas(changed), "categorie", "full_outer")
    lost = (F.col("_lowest_out") <= F.col("_lowest")) | (F.col("_highest_out") >= F.col("_highest"))
    added = both.select(
        "categorie", *[(F.coalesce(f"_{c}", F.lit(0)) + F.coalesce(c, F.lit(0))).cast("decimal(38,6)" if c in ("prices", "ratings") else "bigint").alias(c) for c in _SUMS],
        F.least("_lowest", "_lowest_in").alias("lowest"), F.greatest("_highest", "_highest_in").alias("highest"),
        F.coalesce(lost, F.lit(False)).alias("_lost"),
    ).filter("n_rows > 0")
    again = added.filter("_lost").select("categorie")
    found = after.join(again, "categorie", "left_semi").groupBy("categorie").agg(F.min("prix").alias("_lo"), F.max("prix").alias("_hi"))
    joined = added.join(found, "categorie", "left")
    return joined.select(
        "categorie", *_SUMS, F.when(F.col("_lost"), F.col("_lo")).otherwise(F.col("lowest")).alias("lowest"),
        F.when(F.col("_lost"), F.col("_hi")).otherwise(F.col("highest")).alias("highest"),
    )


def kpi_of_state(state: DataFrame) -> DataFrame:
    def mean(total: str, n: str) -> Column:
        return round_half_even(F.when(F.col(n) > 0, F.col(total).cast("double") / F.col(n)))

    return state.select(
        "categorie", F.col("n_titles").alias("nb_livres"), mean("prices", "n_prices").alias("prix_moyen"),
        round_half_even(F.col("lowest")).alias("prix_min"), round_half_even(F.col("highest")).alias("prix_max"),
        mean("ratings", "n_ratings").alias("note_moyenne"), F.col("reviews").alias("total_avis"),
    )
