"""Star schema: dimensions, facts and the aggregates over them.

An aggregate projects the facts to their keys and measures and the dimensions to
the attributes it needs, joins them and groups once by those attributes. There is
one program for all sizes: Spark chooses each join from the sizes it sees, and
splits the tasks of a hot key. There are no broadcast hints.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from quirelake.functions.numeric import round_half_up
from quirelake.operators.dedup import keep_latest


def _hash(*parts: str) -> Column:
    return F.md5(F.to_json(F.array(*[F.col(c).cast("string") for c in parts])))


def surrogate_key(*natural: str) -> Column:
    """128-bit id of a natural key, computed without coordination between tasks.

    64 bits would collide at billions of keys. A null key has no id.
    """
    present = reduce(and_, [F.col(c).isNotNull() for c in natural])
    return F.when(present, _hash(*natural))


def build_dimension(df: DataFrame, key: str, id_name: str, name: str | None = None) -> DataFrame:
    """Distinct values of one natural key with their ids."""
    name = name or key
    values = df.select(F.col(key).alias(name)).filter(F.col(name).isNotNull()).distinct()
    return values.select(surrogate_key(name).alias(id_name), name)


def build_book_dimension(
    df: DataFrame, url="url", title="titre", author="auteur", newest="date_scraping"
) -> DataFrame:
    """One row per URL; the newest title and author if versions differ."""
    books = df.filter(F.col(url).isNotNull()).select(
        F.col(url).alias("url"), F.col(title).alias("titre"), F.col(author).alias("auteur"), F.col(newest).alias("_at")
    )
    latest = keep_latest(books, "url", "_at", ties=[F.col("titre"), F.col("auteur")])
    return latest.select(surrogate_key("url").alias("id_livre"), "titre", "auteur", "url")


def build_facts(
    df: DataFrame, url="url", category="categorie", site="source", available="est_disponible",
    day="date_val", price="prix", rating="note_etoiles", reviews="nb_avis", score="qualite_score",
    row_id: tuple[str, ...] | None = None,
) -> DataFrame:
    """Facts with hashed foreign keys; no join is needed to look an id up.

    The fact's own id is never null, even where a part of it is.
    """
    return df.select(
        _hash(*(row_id or (url, day))).alias("id"),
        surrogate_key(url).alias("fk_livre"),
        surrogate_key(category).alias("fk_categorie"),
        surrogate_key(site).alias("fk_source"),
        surrogate_key(available).alias("fk_dispo"),
        surrogate_key(day).alias("fk_date"),
        F.col(price).alias("prix"),
        F.col(rating).alias("note_etoiles"),
        F.col(reviews).alias("nb_avis"),
        F.col(score).alias("qualite_score"),
    )


def star_from_silver(silver: DataFrame) -> dict[str, DataFrame]:
    """All five dimensions and the facts from Silver rows."""
    rows = silver.withColumns({
        "est_disponible": F.col("disponibilite") == "available",
        "date_val": F.to_date("date_scraping"),
    })
    return {
        "dim_livre": build_book_dimension(rows),
        "dim_categorie": build_dimension(rows, "categorie", "id_categorie", "nom_categorie"),
        "dim_source": build_dimension(rows, "source", "id_source", "nom_site"),
        "dim_disponibilite": build_dimension(rows, "est_disponible", "id_dispo"),
        "dim_date": build_dimension(rows, "date_val", "id_date"),
        "fact_scraping": build_facts(rows),
    }


Link = tuple[DataFrame, str, str, str]  # dimension, foreign key in the facts, its id, its attribute


def _joined(fact: DataFrame, links: list[Link], **measures: str) -> DataFrame:
    """The measures and the dimensions' attributes, under their new names only."""
    keys = {f"_fk{i}": fk for i, (_, fk, _, _) in enumerate(links)}
    df = fact.select(*[F.col(c).alias(new) for new, c in {**keys, **measures}.items()])
    for i, (dimension, _, id_name, attribute) in enumerate(links):
        named = dimension.select(F.col(id_name).alias(f"_id{i}"), F.col(attribute).alias(f"_{attribute}"))
        df = df.join(named, F.col(f"_fk{i}") == F.col(f"_id{i}"))
    return df


def _mean(measure: str, name: str) -> Column:
    return round_half_up(F.avg(measure)).alias(name)


def _percent_available(whole: Column) -> Column:
    available = F.count_if(F.col("_est_disponible"))
    return round_half_up(F.try_divide(F.lit(100.0) * available, whole))


def genre_stats(fact: DataFrame, dim_category: DataFrame, dim_availability: DataFrame) -> DataFrame:
    links = [
        (dim_category, "fk_categorie", "id_categorie", "nom_categorie"),
        (dim_availability, "fk_dispo", "id_dispo", "est_disponible"),
    ]
    joined = _joined(fact, links, _row="id", _price="prix", _rating="note_etoiles")
    return joined.groupBy(F.col("_nom_categorie").alias("genre")).agg(
        F.count("_row").alias("nb_livres"),
        _mean("_price", "prix_moyen"),
        F.min("_price").alias("prix_min"),
        F.max("_price").alias("prix_max"),
        _mean("_rating", "note_moyenne"),
        _percent_available(F.count("_row")).alias("pct_disponible"),
    )


def daily_volumes(fact: DataFrame, dim_date: DataFrame, dim_source: DataFrame, row_id: str | None = "id") -> DataFrame:
    """Facts per day and site; counts `row_id`, or all rows when it is None."""
    links = [(dim_date, "fk_date", "id_date", "date_val"), (dim_source, "fk_source", "id_source", "nom_site")]
    joined = _joined(fact, links, **({"_row": row_id} if row_id else {}))
    counted = F.count("_row") if row_id else F.count(F.lit(1))
    return joined.groupBy(F.col("_date_val").alias("date_val"), F.col("_nom_site").alias("source")).agg(
        counted.alias("nb_livres")
    )


def timeline(fact: DataFrame, dim_date: DataFrame, dim_source: DataFrame) -> DataFrame:
    """Facts per day and site, newest day first."""
    volumes = daily_volumes(fact, dim_date, dim_source, row_id=None)
    return volumes.withColumnRenamed("source", "nom_site").orderBy(F.col("date_val").desc(), "nom_site")


def global_kpis(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("total_livres"),
        round_half_up(F.avg("prix")).alias("prix_moyen"),
        round_half_up(F.avg("note_etoiles")).alias("note_moyenne"),
        F.count_distinct("fk_source").alias("nb_sources"),
        F.count_distinct("fk_categorie").alias("nb_categories"),
    )


def top_genres(fact: DataFrame, dim_category: DataFrame, n: int = 10) -> DataFrame:
    links = [(dim_category, "fk_categorie", "id_categorie", "nom_categorie")]
    joined = _joined(fact, links, _price="prix", _rating="note_etoiles")
    return (
        joined.groupBy(F.col("_nom_categorie").alias("nom_categorie"))
        .agg(F.count(F.lit(1)).alias("nb_livres"), _mean("_price", "prix_moyen"), _mean("_rating", "note_moyenne"))
        .orderBy(F.col("nb_livres").desc(), "nom_categorie")
        .limit(n)
    )


def source_comparison(fact: DataFrame, dim_source: DataFrame, dim_availability: DataFrame) -> DataFrame:
    links = [
        (dim_source, "fk_source", "id_source", "nom_site"),
        (dim_availability, "fk_dispo", "id_dispo", "est_disponible"),
    ]
    joined = _joined(fact, links, _price="prix", _rating="note_etoiles")
    return joined.groupBy(F.col("_nom_site").alias("nom_site")).agg(
        F.count(F.lit(1)).alias("nb_livres"),
        _mean("_price", "prix_moyen"),
        _mean("_rating", "note_moyenne"),
        _percent_available(F.count(F.lit(1))).alias("pct_dispo"),
    )


def price_band(price: str, edges=(20, 40, 60)) -> Column:
    # fixed values: the edges and the labels of the bands
    low, middle, high = edges
    p = F.col(price)
    return (
        F.when(p < low, f"Moins de {low}")
        .when(p < middle, f"{low} a {middle}")
        .when(p < high, f"{middle} a {high}")
        .otherwise(f"Plus de {high}")
    )


def price_bands(fact: DataFrame, price="prix", rating="note_etoiles", edges=(20, 40, 60)) -> DataFrame:
    return (
        fact.filter(F.col(price).isNotNull())
        .groupBy(price_band(price, edges).alias("tranche_prix"))
        .agg(F.count(F.lit(1)).alias("nb_livres"), round_half_up(F.avg(rating)).alias("note_moyenne"))
        .orderBy("tranche_prix")
    )


#: Scores that the driver holds at once while it looks for a cutoff, and how much further each of its steps goes.
SCORES, WIDEN = 1000, 8


def _up_to(note: str, reviews: str, score: Row) -> Column:
    """Whether a fact stands at a score or before it; no reviews stand last. The first part reaches the file scan."""
    upper = F.col(note) >= F.lit(score[note])
    if score[reviews] is None:
        return upper
    return upper & ((F.col(note) > F.lit(score[note])) | (F.col(reviews) >= F.lit(score[reviews])))


def _after(note: str, reviews: str, score: Row) -> Column:
    lower = F.col(note) < F.lit(score[note])
    if score[reviews] is None:
        return lower
    fewer = F.col(reviews).isNull() | (F.col(reviews) < F.lit(score[reviews]))
    return lower | ((F.col(note) == F.lit(score[note])) & fewer)


def _score_cutoff(rated: DataFrame, matched: Callable[[DataFrame], DataFrame], n: int, note: str, reviews: str) -> Row | None:
    """The score down to which `n` facts match, or None if all facts together have fewer matches.

    The histogram of scores is counted before it is shuffled, and the driver sees its head only. Each step takes facts
    between two scores, some more than the step before, and joins them.
    """
    found, want, last = 0, WIDEN * n, None
    scores: list[Row] = []
    while True:
        left = rated if last is None else rated.filter(_after(note, reviews, last))
        if not scores:
            bars = left.groupBy(note, reviews).agg(F.count(F.lit(1)).alias("_n"))
            scores = bars.orderBy(F.col(note).desc(), F.col(reviews).desc_nulls_last()).limit(SCORES).collect()
        if not scores:
            return None
        total = 0
        while scores and total < want:
            last = scores.pop(0)
            total += last["_n"]
        found += matched(left.filter(_up_to(note, reviews, last))).limit(n).count()
        if found >= n:
            return last
        want *= WIDEN
def top_rated(
    fact: DataFrame, dim_book: DataFrame, dim_category: DataFrame, dim_source: DataFrame,
    n: int = 10, ties: tuple[str, ...] = ("id",), keys_complete: bool = False,
) -> DataFrame:
    """The n best rated, then most reviewed facts with their names.

    Facts whose keys match no dimension row drop out, so the limit comes after
    the joins. A search over the scores finds how far down n facts match; only
    facts down to there are joined, all others stay in their map tasks. Of facts
    with one score and the same three keys, which match or drop out together,
    only the n best go on. With `keys_complete` (every key has its dimension row,
    as in a star built by `star_from_silver` without nulls) the limit comes
    first: nothing is shuffled and n facts are joined.
    """
    note, reviews = "note_etoiles", "nb_avis"
    best = [F.col(note).desc(), F.col(reviews).desc_nulls_last(), *[F.col(t).asc() for t in ties]]
    keys = ["fk_livre", "fk_categorie", "fk_source"]
    columns = list(dict.fromkeys([*keys, "prix", note, reviews, *ties]))
    rated = fact.filter(F.col(note).isNotNull()).select(*columns)

    def matched(facts: DataFrame) -> DataFrame:
        return (
            facts.join(dim_category.select("id_categorie", "nom_categorie"), F.col("fk_categorie") == F.col("id_categorie"))
            .join(dim_source.select("id_source", "nom_site"), F.col("fk_source") == F.col("id_source"))
            .join(dim_book.select("id_livre", "titre", "auteur"), F.col("fk_livre") == F.col("id_livre"))
        )

    if keys_complete:
        rated = rated.orderBy(*best).limit(n)
    else:
        last = _score_cutoff(rated, matched, n, note, reviews)
        if last is not None:
            rated = rated.filter(_up_to(note, reviews, last))
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*best))
        rated = rated.withColumn("_nth", nth).filter(F.col("_nth") <= n).drop("_nth")
    return matched(rated).orderBy(*best).limit(n).select("titre", "auteur", "prix", note, reviews, "nom_categorie", "nom_site")
