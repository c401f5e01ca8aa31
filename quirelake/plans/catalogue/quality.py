"""Data-quality rules and profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.operators import profiles, quality
from quirelake.plans.catalogue import query, table
from quirelake.plans.catalogue.bindings import LIBRARY_SQL, SHOP_SQL
from quirelake.plans.catalogue.silver import library_silver, plain, shop_silver
from quirelake.plans.catalogue.star import dims, fact
from quirelake.session import scratch

_RULES_SQL = """
SELECT regle, resultat, CAST(0 AS BIGINT) AS seuil, CASE WHEN resultat <= 0 THEN 'OK' ELSE 'ECHEC' END AS statut
FROM (
  SELECT 'Livres sans titre' AS regle, (SELECT count(*) FROM part WHERE p_name = 'red widget') AS resultat
  UNION ALL SELECT 'URLs manquantes', (SELECT count(*) FROM part WHERE p_type = 'SMALL')
  UNION ALL SELECT 'Prix negatifs', (SELECT count(*) FROM lineitem WHERE l_extendedprice < 0)
  UNION ALL SELECT 'Notes hors plage', (SELECT count(*) FROM lineitem WHERE l_linenumber NOT BETWEEN 1 AND 5))
"""


def _report(spark, sf_dir):
    return quality.check_star(fact(spark, sf_dir), dims(spark, sf_dir)["livre"])


@query(_RULES_SQL)
def dq_checks(spark, sf_dir):
    return _report(spark, sf_dir)


@query(f"SELECT count(*) FILTER (WHERE statut = 'ECHEC') AS tests_echoues FROM ({_RULES_SQL})")
def dq_failures(spark, sf_dir):
    return quality.failed_rules(_report(spark, sf_dir))


@query("""
SELECT count(*) AS total_faits,
  CAST(round(CAST(avg(l_linenumber * 10) AS DECIMAL(38,10)), 2) AS DOUBLE) AS score_moyen,
  (SELECT count(*) FROM part) AS total_livres FROM lineitem
""")
def dq_totals(spark, sf_dir):
    return quality.star_totals(fact(spark, sf_dir), dims(spark, sf_dir)["livre"])


@query("""
SELECT 'event_id' AS colonne, 'bigint' AS type, count(event_id) AS non_nuls FROM events
UNION ALL SELECT 'ts', 'timestamp_ntz', count(ts) FROM events
UNION ALL SELECT 'user_id', 'bigint', count(user_id) FROM events
UNION ALL SELECT 'event_type', 'string', count(event_type) FROM events
UNION ALL SELECT 'value', 'double', count(value) FROM events
UNION ALL SELECT 'props', 'string', count(props) FROM events
""")
def dq_types(spark, sf_dir):
    return quality.column_types(table(spark, sf_dir, "events"))


_SILVER_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS colonne, count(*) - count({c}) AS nulls, count(*) AS total FROM shop_silver"
    for c in ["auteur", "prix", "note_etoiles", "description", "isbn", "annee_publication", "date_scraping", "titre"]
)


@query(f"""
WITH {SHOP_SQL}
SELECT colonne, nulls, round_even(nulls / total * 100, 1) AS pct FROM ({_SILVER_NULLS}) WHERE nulls > 0
""")
def null_profile(spark, sf_dir):
    return quality.null_profile(plain(shop_silver(spark, sf_dir)))


@query("""
SELECT count(*) AS total, count(CASE lang WHEN 'de' THEN NULL ELSE n_chars END) AS prix_renseignes,
  count(*) FILTER (WHERE lang = 'fr') AS prix_negatifs, count(*) FILTER (WHERE source = 'src0') AS auteurs_unknown,
  count(*) FILTER (WHERE lang = 'es') AS codes_3_lettres,
  count(*) FILTER (WHERE lang IN ('en', 'fr') AND length(text) > 30
    OR lang NOT IN ('en', 'fr') AND length(text) // 2 > 30 AND substr(text, length(text) // 2 + 1, 20) = substr(text, 1, 20))
    AS descriptions_dupliquees
FROM documents
""")
def residue_profile(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").selectExpr(
        "CASE lang WHEN 'de' THEN NULL WHEN 'fr' THEN -1D ELSE CAST(n_chars AS double) END AS prix",
        "CASE source WHEN 'src0' THEN 'Unknown' ELSE source END AS auteur",
        "CASE lang WHEN 'es' THEN 'spa' ELSE lang END AS langue",
        "CASE WHEN lang IN ('en', 'fr') THEN concat(text, text) ELSE text END AS description",
    )
    return quality.residue_profile(rows)


@query(f"""
WITH {SHOP_SQL}
SELECT round(avg(qualite_score), 1) AS moyenne, min(qualite_score) AS min, max(qualite_score) AS max FROM shop_silver
""")
def score_summary(spark, sf_dir):
    return quality.score_summary(shop_silver(spark, sf_dir))


@query(f"""
WITH {LIBRARY_SQL}, bins AS (
  SELECT CAST(i AS INTEGER) AS bin, CAST(20 * i - 20 AS INTEGER) AS low, CAST(20 * i AS INTEGER) AS high
  FROM range(1, 6) t(i))
SELECT bin, low, high, count(qualite_score) AS count
FROM bins LEFT JOIN library_silver ON (qualite_score > low OR low = 0 AND qualite_score = 0) AND qualite_score <= high
GROUP BY 1, 2, 3
""")
def score_histogram(spark, sf_dir):
    return quality.score_histogram(library_silver(spark, sf_dir))


@query("""
SELECT p_brand AS categorie, count(*) AS nb_livres, round_even(avg(p_retailprice), 2) AS prix,
  round_even(avg(CASE WHEN p_size < 40 THEN p_size END), 2) AS note_etoiles FROM part GROUP BY 1
""")
def category_stats(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_brand AS categorie", "p_name AS titre", "p_retailprice AS prix",
        "CASE WHEN p_size < 40 THEN CAST(p_size AS double) END AS note_etoiles",
    )
    return quality.category_stats(rows)


@query("""
SELECT p_name AS titre, p_brand AS auteur, p_retailprice AS prix, p_type AS categorie FROM part ORDER BY p_partkey LIMIT 5
""")
def preview(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_name AS titre", "p_brand AS auteur", "p_retailprice AS prix", "p_type AS categorie"
    )
    return quality.preview(rows, order=[F.col("p_partkey")])


_DAYS = "ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'"


@query(f"""
SELECT 'value' AS colonne, count(*) AS n, count(*) - count(value) AS nulls, min(value)::DOUBLE AS lo, max(value)::DOUBLE AS hi,
  true AS distincts_proches, 3 AS quantiles_proches FROM events WHERE {_DAYS}
UNION ALL
SELECT 'user_id', count(*), count(*) - count(user_id), min(user_id)::DOUBLE, max(user_id)::DOUBLE, true, 3 FROM events WHERE {_DAYS}
""")
def profile_days(spark, sf_dir):
    """Profiles stored per day, united over some of the days; estimates are held against one exact pass over the rows."""
    columns, shares = ["value", "user_id"], [0.1, 0.5, 0.99]
    events = table(spark, sf_dir, "events").select("ts", *columns)
    paths = [scratch(spark, name) for name in ("profiles", "histograms")]
    for build, path in zip((profiles.day_profiles, profiles.day_histograms), paths, strict=True):
        build(events, "ts", columns).write.parquet(path)
    span = "day >= DATE '2024-01-05' AND day < DATE '2024-01-20'"
    stored, histograms = (spark.read.parquet(path).filter(span) for path in paths)
    rows = events.filter(_DAYS)
    exact = [
        rows.agg(
            F.count_distinct(c).alias("exact"), F.expr(f"percentile_disc({s}) WITHIN GROUP (ORDER BY CAST({c} AS double))").alias("real")
        ).select(F.lit(c).alias("column"), F.lit(s).alias("share"), "exact", "real")
        for c in columns for s in shares
    ]
    close = reduce(DataFrame.unionByName, exact).join(profiles.quantiles(histograms, shares), ["column", "share"])
    near = F.abs(F.col("value") - F.col("real")) <= profiles.ERROR * F.abs("real") * (1 + 1e-9)
    counted = close.groupBy("column").agg(F.count_if(near).cast("int").alias("quantiles_proches"), F.max("exact").alias("exact"))
    told = profiles.united(stored).join(counted, "column")
    return told.select(
        F.col("column").alias("colonne"), "n", "nulls", "lo", "hi",
        (F.abs(F.col("distinct") - F.col("exact")) <= 0.08 * F.col("exact")).alias("distincts_proches"), "quantiles_proches",
    )
