"""Star schema, BI queries and dashboard figures.

Facts are order lines, books and their categories are parts and brands, sources
are the suppliers' nations, a line is available while its status is open.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelake.operators import dashboard, gold, star
from quirelake.plans.catalogue import query, table
from quirelake.plans.catalogue.bindings import SHOP_SQL
from quirelake.plans.catalogue.silver import shop_silver


def fact(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS id", "l_partkey AS fk_livre", "l_partkey AS fk_categorie", "l_suppkey AS fk_source",
        "l_linestatus AS fk_dispo", "CAST(l_shipdate AS date) AS fk_date", "l_extendedprice AS prix",
        "l_linenumber AS note_etoiles", "CAST(l_quantity AS bigint) AS nb_avis",
        "CAST(l_linenumber * 10 AS int) AS qualite_score",
    )


def dims(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    lines = table(spark, sf_dir, "lineitem")
    nation = table(spark, sf_dir, "nation")
    suppliers = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return {
        "livre": part.selectExpr(
            "p_partkey AS id_livre", "nullif(p_name, 'red widget') AS titre", "p_brand AS auteur",
            "CASE p_type WHEN 'SMALL' THEN '' ELSE concat('https://shop.example/', p_partkey) END AS url",
        ),
        "categorie": part.selectExpr("p_partkey AS id_categorie", "p_brand AS nom_categorie"),
        "source": suppliers.selectExpr("s_suppkey AS id_source", "n_name AS nom_site"),
        "dispo": lines.select("l_linestatus").distinct().selectExpr(
            "l_linestatus AS id_dispo", "l_linestatus = 'O' AS est_disponible"
        ),
        "date": lines.selectExpr("CAST(l_shipdate AS date) AS id_date").distinct().selectExpr(
            "id_date", "id_date AS date_val"
        ),
    }


def half_up(expression: str) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), 2) AS DOUBLE)"


_SITES = "lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"


@query(f"""
SELECT p_brand AS genre, count(*) AS nb_livres, {half_up('avg(l_extendedprice)')} AS prix_moyen,
  min(l_extendedprice) AS prix_min, max(l_extendedprice) AS prix_max, {half_up('avg(l_linenumber)')} AS note_moyenne,
  {half_up("100.0 * sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) / count(*)")} AS pct_disponible
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
""")
def star_genre_stats(spark, sf_dir):
    d = dims(spark, sf_dir)
    return star.genre_stats(fact(spark, sf_dir), d["categorie"], d["dispo"])


@query(f"SELECT CAST(l_shipdate AS DATE) AS date_val, n_name AS source, count(*) AS nb_livres FROM {_SITES} GROUP BY 1, 2")
def star_daily_volumes(spark, sf_dir):
    d = dims(spark, sf_dir)
    return star.daily_volumes(fact(spark, sf_dir), d["date"], d["source"])


@query(f"""
SELECT count(*) AS total_livres, {half_up('avg(l_extendedprice)')} AS prix_moyen,
  {half_up('avg(l_linenumber)')} AS note_moyenne, count(DISTINCT l_suppkey) AS nb_sources,
  count(DISTINCT l_partkey) AS nb_categories FROM lineitem
""")
def bi_global_kpis(spark, sf_dir):
    return star.global_kpis(fact(spark, sf_dir))


@query(f"""
SELECT p_brand AS nom_categorie, count(*) AS nb_livres, {half_up('avg(l_extendedprice)')} AS prix_moyen,
  {half_up('avg(l_linenumber)')} AS note_moyenne
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY nb_livres DESC, nom_categorie LIMIT 10
""")
def bi_top_genres(spark, sf_dir):
    return star.top_genres(fact(spark, sf_dir), dims(spark, sf_dir)["categorie"])


@query(f"""
SELECT n_name AS nom_site, count(*) AS nb_livres, {half_up('avg(l_extendedprice)')} AS prix_moyen,
  {half_up('avg(l_linenumber)')} AS note_moyenne,
  {half_up("100.0 * sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) / count(*)")} AS pct_dispo
FROM {_SITES} GROUP BY 1
""")
def bi_source_compare(spark, sf_dir):
    d = dims(spark, sf_dir)
    return star.source_comparison(fact(spark, sf_dir), d["source"], d["dispo"])


@query(f"""
SELECT CASE WHEN p < 20 THEN 'Moins de 20' WHEN p < 40 THEN '20 a 40' WHEN p < 60 THEN '40 a 60' ELSE 'Plus de 60' END
    AS tranche_prix,
  count(*) AS nb_livres, {half_up('avg(note)')} AS note_moyenne
FROM (SELECT CASE event_type WHEN 'error' THEN NULL ELSE value END AS p, length(event_type) AS note FROM events)
WHERE p IS NOT NULL GROUP BY 1 ORDER BY 1
""")
def bi_price_bands(spark, sf_dir):
    facts = table(spark, sf_dir, "events").selectExpr(
        "CASE event_type WHEN 'error' THEN NULL ELSE value END AS prix", "length(event_type) AS note_etoiles"
    )
    return star.price_bands(facts)


_TOP_RATED_SQL = """
SELECT nullif(p_name, 'red widget') AS titre, p_brand AS auteur, l_extendedprice AS prix, l_linenumber AS note_etoiles,
  CAST(l_quantity AS BIGINT) AS nb_avis, p_brand AS nom_categorie, n_name AS nom_site
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
ORDER BY note_etoiles DESC, nb_avis DESC, l_orderkey, l_partkey, l_suppkey, l_extendedprice LIMIT 10
"""
_TIES = ("id", "fk_livre", "fk_source", "prix")


@query(_TOP_RATED_SQL)
def bi_top_rated(spark, sf_dir):
    """Beside the facts there are better rated ones, whose keys match no dimension row."""
    d = dims(spark, sf_dir)
    facts = fact(spark, sf_dir)
    lost = facts.withColumns({"fk_livre": -1 - F.col("fk_livre"), "note_etoiles": F.col("note_etoiles") + 10})
    return star.top_rated(facts.unionByName(lost), d["livre"], d["categorie"], d["source"], ties=_TIES)


@query(_TOP_RATED_SQL)
def bi_top_rated_complete_keys(spark, sf_dir):
    """Every key of these facts has its dimension row, so ten facts are joined."""
    d = dims(spark, sf_dir)
    return star.top_rated(
        fact(spark, sf_dir), d["livre"], d["categorie"], d["source"], ties=_TIES, keys_complete=True
    )


@query(f"""
SELECT CAST(l_shipdate AS DATE) AS date_val, n_name AS nom_site, count(*) AS nb_livres FROM {_SITES}
GROUP BY 1, 2 ORDER BY 1 DESC, 2
""")
def bi_timeline(spark, sf_dir):
    d = dims(spark, sf_dir)
    return star.timeline(fact(spark, sf_dir), d["date"], d["source"])


@query(f"""
WITH {SHOP_SQL}
SELECT 'categorie' AS dimension, categorie AS valeur FROM (SELECT DISTINCT categorie FROM shop_silver)
UNION ALL SELECT 'source', source FROM (SELECT DISTINCT source FROM shop_silver)
UNION ALL SELECT 'disponible', CAST(d AS VARCHAR) FROM
  (SELECT DISTINCT disponibilite = 'available' AS d FROM shop_silver)
UNION ALL SELECT 'date', CAST(d AS VARCHAR) FROM
  (SELECT DISTINCT CAST(date_scraping AS DATE) AS d FROM shop_silver WHERE date_scraping IS NOT NULL)
UNION ALL SELECT 'livre', url || '|' || titre FROM shop_silver
""")
def dim_build(spark, sf_dir):
    """All five dimensions, by their natural keys."""
    s = star.star_from_silver(shop_silver(spark, sf_dir))

    def values(kind, name, value):
        return s[name].select(F.lit(kind).alias("dimension"), F.expr(value).alias("valeur"))

    return (
        values("categorie", "dim_categorie", "nom_categorie")
        .unionByName(values("source", "dim_source", "nom_site"))
        .unionByName(values("disponible", "dim_disponibilite", "CAST(est_disponible AS string)"))
        .unionByName(values("date", "dim_date", "CAST(date_val AS string)"))
        .unionByName(values("livre", "dim_livre", "concat(url, '|', titre)"))
    )


@query(f"""
WITH {SHOP_SQL}
SELECT url, categorie, source, disponibilite = 'available' AS est_disponible, CAST(date_scraping AS DATE) AS date_val,
  prix, note_etoiles, nb_avis, qualite_score
FROM shop_silver WHERE date_scraping IS NOT NULL
""")
def fact_build(spark, sf_dir):
    """Facts resolved back to natural keys through their dimensions."""
    s = star.star_from_silver(shop_silver(spark, sf_dir))
    return (
        s["fact_scraping"]
        .join(s["dim_livre"], F.col("fk_livre") == F.col("id_livre"))
        .join(s["dim_categorie"], F.col("fk_categorie") == F.col("id_categorie"))
        .join(s["dim_source"], F.col("fk_source") == F.col("id_source"))
        .join(s["dim_disponibilite"], F.col("fk_dispo") == F.col("id_dispo"))
        .join(s["dim_date"], F.col("fk_date") == F.col("id_date"))
        .selectExpr(
            "url", "nom_categorie AS categorie", "nom_site AS source", "est_disponible", "date_val", "prix",
            "note_etoiles", "nb_avis", "qualite_score",
        )
    )


def _kpi(spark, sf_dir):
    return gold.kpi_by_dimension(
        table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"), "l_partkey", "p_partkey", "p_brand",
        title="l_orderkey", price="l_extendedprice", rating="l_linenumber", reviews="l_quantity",
    )


_KPI_SQL = """
kpi AS (
  SELECT p_brand AS categorie, count(*) AS nb_livres, round_even(avg(l_extendedprice), 2) AS prix_moyen,
    round_even(avg(l_linenumber), 2) AS note_moyenne
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
"""


@query("""
SELECT p_brand AS categorie, count(*) AS nb_livres, round_even(avg(l_extendedprice), 2) AS prix_moyen FROM lineitem
  JOIN part ON l_partkey = p_partkey GROUP BY 1
""")
def gold_kpi_shared_name(spark, sf_dir):
    """Facts and dimension have columns of the same names; the category is the dimension's."""
    facts = table(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey AS cle", "l_returnflag AS categorie", "l_orderkey AS titre", "l_extendedprice AS prix",
        "l_linenumber AS note_etoiles", "l_quantity AS nb_avis",
    )
    dimension = table(spark, sf_dir, "part").selectExpr("p_partkey AS cle", "p_brand AS categorie", "p_name AS titre", "p_size AS prix")
    kpi = gold.kpi_by_dimension(facts, dimension, "cle", "cle", "categorie", "titre", "prix", "note_etoiles", "nb_avis")
    return kpi.select("categorie", "nb_livres", "prix_moyen")


@query(f"""
WITH {_KPI_SQL}
SELECT (SELECT count(*) FROM part) AS total_livres, round(avg(prix_moyen), 2) AS prix_moyen,
  round(avg(note_moyenne), 1) AS note_moyenne, count(*) AS nb_genres FROM kpi
""")
def dash_headline(spark, sf_dir):
    return dashboard.headline(_kpi(spark, sf_dir), table(spark, sf_dir, "part"))


@query("SELECT CAST(l_linenumber AS DOUBLE) AS note_etoiles, count(*) AS nb_livres FROM lineitem GROUP BY 1")
def dash_notes(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_linenumber AS double) AS note_etoiles", "l_returnflag AS categorie", "l_orderkey AS titre",
        "l_extendedprice AS prix",
    )
    return dashboard.books_per_rating(gold.rating_distribution(rows))


@query(f"WITH {_KPI_SQL} SELECT categorie, nb_livres FROM kpi ORDER BY nb_livres DESC, categorie LIMIT 10")
def dash_top_genres(spark, sf_dir):
    return dashboard.largest_genres(_kpi(spark, sf_dir))


@query(f"WITH {_KPI_SQL} SELECT categorie, prix_moyen FROM kpi ORDER BY prix_moyen DESC, categorie LIMIT 10")
def dash_top_price(spark, sf_dir):
    return dashboard.dearest_genres(_kpi(spark, sf_dir))


@query("""
SELECT p_name AS titre, p_type AS auteur, p_retailprice AS prix, p_size AS note_etoiles, p_brand AS categorie FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rang FROM part)
WHERE rang <= 10 ORDER BY p_brand, rang LIMIT 10
""")
def dash_top_books(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_brand AS categorie", "p_name AS titre", "p_type AS auteur", "p_retailprice AS prix",
        "p_size AS note_etoiles",
    )
    columns = ("titre", "auteur", "prix", "note_etoiles")
    return dashboard.top_books(gold.top_by_price(rows, ties=["p_partkey"], columns=columns))


@query("""
SELECT event_type, count(*) AS count FROM events WHERE event_type <> 'error' GROUP BY 1 ORDER BY 2 DESC, 1
""")
def value_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("nullif(event_type, 'error') AS event_type")
    return dashboard.value_counts(rows, "event_type")


@query("SELECT DISTINCT p_brand FROM part")
def distinct_values(spark, sf_dir):
    return dashboard.distinct_values(table(spark, sf_dir, "part"), "p_brand")


def _catalogue_rows(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_name AS titre", "p_brand AS auteur", "p_retailprice AS prix", "p_size AS note_etoiles",
        "p_type AS categorie", "'en' AS langue",
    )


_CATALOGUE_SQL = """
SELECT p_name AS titre, p_brand AS auteur, p_retailprice AS prix, p_size AS note_etoiles, p_type AS categorie,
  'en' AS langue FROM part {where} ORDER BY p_name, p_partkey LIMIT 100
"""


@query(_CATALOGUE_SQL.format(where="WHERE p_type = 'PROMO'"))
def catalogue_filter(spark, sf_dir):
    return dashboard.catalogue(_catalogue_rows(spark, sf_dir), "PROMO", order=("titre", "p_partkey"))


@query(_CATALOGUE_SQL.format(where=""))
def catalogue_all(spark, sf_dir):
    return dashboard.catalogue(_catalogue_rows(spark, sf_dir), None, order=("titre", "p_partkey"))
