"""Gold tables and their warehouse projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelake.operators import gold, warehouse
from quirelake.plans.catalogue import query, table
from quirelake.plans.catalogue.bindings import RUN_TS
from quirelake.schemas import SHOP_FOLDER

_KPI_SQL = f"""
SELECT p_brand AS categorie, count(l_orderkey) AS nb_livres, round_even(avg(l_extendedprice), 2) AS prix_moyen,
  round_even(min(l_extendedprice), 2) AS prix_min, round_even(max(l_extendedprice), 2) AS prix_max,
  round_even(avg(l_linenumber), 2) AS note_moyenne, CAST(sum(l_quantity) AS BIGINT) AS total_avis,
  '{SHOP_FOLDER}' AS source, '{RUN_TS}' AS date_gold
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
"""


def _kpi(spark, sf_dir):
    return gold.kpi_by_dimension(
        table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"), "l_partkey", "p_partkey", "p_brand",
        title="l_orderkey", price="l_extendedprice", rating="l_linenumber", reviews="l_quantity",
        source=SHOP_FOLDER, run_ts=RUN_TS,
    )


@query(_KPI_SQL)
def gold_kpi_category(spark, sf_dir):
    return _kpi(spark, sf_dir)


@query("""
SELECT p_type AS categorie, count(CASE p_brand WHEN 'Brand#1' THEN NULL ELSE p_name END) AS nb_livres,
  round_even(avg(CASE WHEN p_size > 25 THEN p_retailprice END), 2) AS prix_moyen,
  round_even(min(CASE WHEN p_size > 25 THEN p_retailprice END), 2) AS prix_min,
  round_even(max(CASE WHEN p_size > 25 THEN p_retailprice END), 2) AS prix_max,
  round_even(avg(CAST(NULL AS DOUBLE)), 2) AS note_moyenne,
  CAST(0 AS BIGINT) AS total_avis
FROM part WHERE p_type <> 'SMALL' GROUP BY p_type
""")
def gold_kpi_plain(spark, sf_dir):
    """Null keys dropped, null prices skipped, a sum of nulls is 0."""
    rows = table(spark, sf_dir, "part").selectExpr(
        "nullif(p_type, 'SMALL') AS categorie",
        "CASE p_brand WHEN 'Brand#1' THEN NULL ELSE p_name END AS titre",
        "CASE WHEN p_size > 25 THEN p_retailprice END AS prix",
        "CAST(NULL AS double) AS note_etoiles",
        "CAST(NULL AS bigint) AS nb_avis",
    )
    return gold.kpi_by_category(rows)


@query("""
SELECT CAST(l_linenumber AS DOUBLE) AS note_etoiles, l_returnflag AS categorie, count(*) AS nb_livres,
  round_even(avg(l_extendedprice), 2) AS prix_moyen
FROM lineitem WHERE l_linenumber <> 7 AND l_returnflag <> 'N' GROUP BY 1, 2
""")
def gold_rating_distribution(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(nullif(l_linenumber, 7) AS double) AS note_etoiles", "nullif(l_returnflag, 'N') AS categorie",
        "l_orderkey AS titre", "l_extendedprice AS prix",
    )
    return gold.rating_distribution(rows)


_TOP_SQL = f"""
SELECT categorie, CAST(rn AS INTEGER) AS rang, titre, auteur, prix, note_etoiles, isbn, url,
  '{SHOP_FOLDER}' AS source, '{RUN_TS}' AS date_gold
FROM (
  SELECT p_brand AS categorie, p_name AS titre, p_type AS auteur, p_retailprice AS prix,
    CAST(p_size AS DOUBLE) AS note_etoiles, CAST(NULL AS VARCHAR) AS isbn, 'https://shop.example/' || p_partkey AS url,
    row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn
  FROM part WHERE p_type <> 'SMALL')
WHERE rn <= 10
"""


def _top(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_brand AS categorie", "p_name AS titre", "p_type AS auteur",
        "CASE p_type WHEN 'SMALL' THEN NULL ELSE p_retailprice END AS prix", "CAST(p_size AS double) AS note_etoiles",
        "CAST(NULL AS string) AS isbn", "concat('https://shop.example/', p_partkey) AS url",
    )
    return gold.top_by_price(rows, ties=["p_partkey"], source=SHOP_FOLDER, run_ts=RUN_TS)


@query(_TOP_SQL)
def gold_top_expensive(spark, sf_dir):
    return _top(spark, sf_dir)


_AUTHOR_SQL = """
SELECT 'Customer ' || o_custkey AS auteur, count(*) AS nb_livres, CAST(sum(o_custkey) AS BIGINT) AS nb_avis_total,
  CAST(min(year(o_orderdate)) AS INTEGER) AS annee_min, CAST(max(year(o_orderdate)) AS INTEGER) AS annee_max
FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1
"""


def _authors(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "CASE o_orderstatus WHEN 'P' THEN NULL ELSE concat('Customer ', o_custkey) END AS auteur",
        "o_orderkey AS titre", "o_custkey AS nb_avis", "year(o_orderdate) AS annee_publication",
    )
    return gold.kpi_by_author(rows)


@query(_AUTHOR_SQL)
def gold_kpi_author(spark, sf_dir):
    return _authors(spark, sf_dir)


_FLAT_SQL = f"""
SELECT c_name AS titre, c_mktsegment AS auteur, c_acctbal AS prix, CAST(NULL AS DOUBLE) AS note_etoiles,
  CAST(NULL AS VARCHAR) AS categorie, CAST(NULL AS VARCHAR) AS langue, 'customer' AS source, '{RUN_TS}' AS date_gold
FROM customer
UNION ALL
SELECT s_name, NULL, s_acctbal, CAST(s_nationkey AS DOUBLE), 'Nation ' || s_nationkey, 'en', 'supplier', '{RUN_TS}'
FROM supplier
"""


def _flat(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_name AS titre", "c_mktsegment AS auteur", "c_acctbal AS prix", "'customer' AS source", "c_custkey AS extra"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_name AS titre", "s_acctbal AS prix", "CAST(s_nationkey AS double) AS note_etoiles",
        "concat('Nation ', s_nationkey) AS categorie", "'en' AS langue", "'supplier' AS source",
    )
    return gold.flat_view(customers, suppliers, run_ts=RUN_TS)


@query(_FLAT_SQL)
def gold_flat(spark, sf_dir):
    return _flat(spark, sf_dir)


@query("""
SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) AS total,
  (SELECT count(*) FROM customer) AS clients, (SELECT count(*) FROM supplier) AS fournisseurs
""")
def flat_source_counts(spark, sf_dir):
    return gold.count_per_source(_flat(spark, sf_dir), {"clients": "customer", "fournisseurs": "supplier"})


@query(f"""
SELECT categorie, nb_livres, prix_moyen, prix_min, prix_max, note_moyenne, total_avis, source, date_gold
FROM ({_KPI_SQL})
""")
def warehouse_kpi_par_categorie(spark, sf_dir):
    return warehouse.project(_kpi(spark, sf_dir), "kpi_par_categorie")


@query("""
SELECT CAST(l_linenumber AS DOUBLE) AS note_etoiles, l_returnflag AS categorie, count(*) AS nb_livres,
  round_even(avg(l_extendedprice), 2) AS prix_moyen, '' AS source, '' AS date_gold
FROM lineitem GROUP BY 1, 2
""")
def warehouse_distribution_notes(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_linenumber AS double) AS note_etoiles", "l_returnflag AS categorie", "l_orderkey AS titre",
        "l_extendedprice AS prix",
    )
    return warehouse.project(gold.rating_distribution(rows), "distribution_notes")


@query(f"SELECT * REPLACE ('' AS isbn, CAST(rang AS BIGINT) AS rang) FROM ({_TOP_SQL})")
def warehouse_top_livres_chers(spark, sf_dir):
    return warehouse.project(_top(spark, sf_dir), "top_livres_chers")


@query(f"""
SELECT auteur, nb_livres, nb_avis_total, CAST(annee_min AS DOUBLE) AS annee_min, CAST(annee_max AS DOUBLE) AS annee_max,
  '' AS source, '' AS date_gold FROM ({_AUTHOR_SQL})
""")
def warehouse_kpi_par_auteur(spark, sf_dir):
    return warehouse.project(_authors(spark, sf_dir), "kpi_par_auteur")


@query(f"""
SELECT titre, coalesce(auteur, '') AS auteur, prix, note_etoiles, coalesce(categorie, 'Unknown') AS categorie,
  'unknown' AS disponibilite, '' AS isbn, CAST(0 AS BIGINT) AS nb_avis, coalesce(langue, 'en') AS langue,
  CAST(NULL AS DOUBLE) AS annee_publication, source, CAST(NULL AS DOUBLE) AS qualite_score, '' AS date_scraping,
  '' AS url, date_gold FROM ({_FLAT_SQL})
""")
def warehouse_livres_flat(spark, sf_dir):
    return warehouse.project(_flat(spark, sf_dir), "livres_flat")


def _oversized(spark, sf_dir):
    """Whole document texts as category: many are wider than the warehouse column."""
    return table(spark, sf_dir, "documents").selectExpr(
        "concat('Document ', doc_id) AS titre", "text AS categorie", "text AS auteur",
        "CASE lang WHEN 'es' THEN 3000000000 WHEN 'fr' THEN -9223372036854775807 - 1 WHEN 'de' THEN -2147483648 "
        "ELSE n_chars END AS nb_avis", "source",
    )


@query("""
SELECT 'Document ' || doc_id AS titre,
  concat_ws('; ', CASE WHEN length(text) > 100 THEN 'categorie: longer than 100' END,
    CASE WHEN lang IN ('es', 'fr') THEN 'nb_avis: out of range' END) AS reasons
FROM documents WHERE length(text) > 100 OR lang IN ('es', 'fr')
""")
def load_rejects(spark, sf_dir):
    projected = warehouse.project(_oversized(spark, sf_dir), "livres_flat")
    return warehouse.split_rejects(projected, "livres_flat")[1].select("titre", "reasons")


@query("""
SELECT count(*) FILTER (WHERE length(text) <= 100 AND lang NOT IN ('es', 'fr')) AS chargees,
  count(*) FILTER (WHERE length(text) > 100 OR lang IN ('es', 'fr')) AS erreurs FROM documents
""")
def load_report(spark, sf_dir):
    return warehouse.load_report(warehouse.project(_oversized(spark, sf_dir), "livres_flat"), "livres_flat")


@query("""
SELECT 'Document ' || doc_id AS titre, substr(text, 1, 300) AS auteur FROM documents
""")
def warehouse_widths(spark, sf_dir):
    """Text wider than its column is cut only where the warehouse spec says so."""
    return warehouse.project(_oversized(spark, sf_dir), "livres_flat").select("titre", "auteur")


@query(_KPI_SQL + " ORDER BY nb_livres DESC, categorie")
def gold_kpi_ordered(spark, sf_dir):
    return gold.in_order(_kpi(spark, sf_dir), "kpi_par_categorie")


@query("""
SELECT 'categorie VARCHAR(100), nb_livres INTEGER, prix_moyen FLOAT, prix_min FLOAT, prix_max FLOAT, note_moyenne FLOAT, '
  || 'total_avis INTEGER, source VARCHAR(100), date_gold VARCHAR(30)' AS types, count(DISTINCT p_brand) AS lignes FROM part
""")
def load_column_types(spark, sf_dir):
    """Column types of a warehouse table, and the rows it would get."""
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("categorie")).distinct()
    types = F.lit(warehouse.column_types("kpi_par_categorie"))
    return rows.agg(types.alias("types"), F.count(F.lit(1)).alias("lignes"))
