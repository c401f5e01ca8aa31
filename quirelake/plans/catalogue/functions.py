"""Cleaning functions over dirty texts derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelake.functions import markup, numeric, text
from quirelake.plans.catalogue import query, table
from quirelake.plans.catalogue.bindings import WHITESPACE_SQL


@query("""
WITH dirty AS (
  SELECT p_partkey, CASE p_type
    WHEN 'ECONOMY' THEN '£' || p_retailprice WHEN 'LARGE' THEN p_retailprice || ' EUR'
    WHEN 'MEDIUM' THEN '-' || p_size WHEN 'PROMO' THEN p_size || ',50 EUR'
    WHEN 'SMALL' THEN '1.' || p_size || '.3' ELSE '  ' END AS prix_brut
  FROM part)
SELECT p_partkey, prix_brut, TRY_CAST(regexp_replace(prix_brut, '[^0-9.]', '', 'g') AS DOUBLE) AS prix FROM dirty
""")
def clean_price(spark, sf_dir):
    dirty = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "CASE p_type WHEN 'ECONOMY' THEN concat('£', p_retailprice) WHEN 'LARGE' THEN concat(p_retailprice, ' EUR') "
        "WHEN 'MEDIUM' THEN concat('-', p_size) WHEN 'PROMO' THEN concat(p_size, ',50 EUR') "
        "WHEN 'SMALL' THEN concat('1.', p_size, '.3') ELSE '  ' END AS prix_brut",
    )
    return dirty.withColumn("prix", numeric.clean_price(F.col("prix_brut")))


@query("""
WITH dirty AS (
  SELECT c_custkey, CASE c_mktsegment
    WHEN 'HOUSEHOLD' THEN ' UNKNOWN ' WHEN 'MACHINERY' THEN chr(9) || c_name || ' '
    WHEN 'FURNITURE' THEN '   ' WHEN 'BUILDING' THEN NULL ELSE c_name END AS brut
  FROM customer)
SELECT c_custkey, CASE WHEN lower(trim(brut, ' ' || chr(9))) IN ('unknown', '') THEN NULL
  ELSE trim(brut, ' ' || chr(9)) END AS auteur FROM dirty
""")
def clean_author(spark, sf_dir):
    dirty = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN ' UNKNOWN ' WHEN 'MACHINERY' THEN concat('\t', c_name, ' ') "
        "WHEN 'FURNITURE' THEN '   ' WHEN 'BUILDING' THEN NULL ELSE c_name END AS brut",
    )
    return dirty.select("c_custkey", text.clean_author(F.col("brut")).alias("auteur"))


@query(f"""
WITH doubled AS (
  SELECT doc_id, trim(CASE lang WHEN 'en' THEN text || text WHEN 'fr' THEN text || ' ' || text ELSE text END, {WHITESPACE_SQL})
    AS t FROM documents),
halves AS (SELECT doc_id, t, length(t) // 2 AS h FROM doubled)
SELECT doc_id, CASE WHEN h > 30 AND trim(substr(t, h + 1, 20), {WHITESPACE_SQL}) = trim(substr(t, 1, 20), {WHITESPACE_SQL})
  THEN trim(substr(t, 1, h), {WHITESPACE_SQL}) ELSE t END AS description FROM halves
""")
def dedup_half_text(spark, sf_dir):
    doubled = table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "CASE lang WHEN 'en' THEN concat(text, text) WHEN 'fr' THEN concat(text, ' ', text) ELSE text END AS t",
    )
    return doubled.select("doc_id", text.drop_repeated_half(F.col("t")).alias("description"))


@query(f"""
SELECT doc_id, trim(regexp_replace(nullif(text, ''), '[\\r\\n]+', ' ', 'g'), {WHITESPACE_SQL}) AS description FROM documents
""")
def clean_newlines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.join_lines(F.col("text")).alias("description"))


@query("""
SELECT doc_id, CASE lang WHEN 'en' THEN 'en' WHEN 'fr' THEN 'fr' WHEN 'de' THEN 'sw' ELSE 'pt-br' END AS langue
FROM documents
""")
def normalize_lang(spark, sf_dir):
    raw = F.expr("CASE lang WHEN 'en' THEN ' ENG ' WHEN 'fr' THEN 'fre' WHEN 'de' THEN 'swe' ELSE 'pt-BR' END")
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_language(raw).alias("langue"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'available' WHEN 'O' THEN 'unavailable' ELSE 'unknown' END
  AS disponibilite FROM orders
""")
def normalize_availability(spark, sf_dir):
    raw = F.expr(
        "CASE o_orderstatus WHEN 'F' THEN 'In Stock (22 available), without cover' WHEN 'O' THEN 'Out of stock' END"
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", text.normalize_availability(raw).alias("disponibilite"))


@query("""
SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN NULL WHEN 'PROMO' THEN NULL ELSE p_brand END AS isbn FROM part
""")
def clean_code(spark, sf_dir):
    raw = F.expr("CASE p_type WHEN 'SMALL' THEN '   ' WHEN 'PROMO' THEN NULL ELSE concat(' ', p_brand, '\n') END")
    return table(spark, sf_dir, "part").select("p_partkey", text.blank_to_null(raw).alias("isbn"))


@query("""
SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'Unknown' WHEN 'PROMO' THEN 'Unknown' WHEN 'LARGE' THEN 'Unknown'
  WHEN 'MEDIUM' THEN 'DEFAULT' ELSE p_brand END AS categorie FROM part
""")
def fix_category(spark, sf_dir):
    raw = F.expr(
        "CASE p_type WHEN 'SMALL' THEN 'Add a comment' WHEN 'PROMO' THEN ' default ' WHEN 'LARGE' THEN NULL "
        "WHEN 'MEDIUM' THEN 'DEFAULT' ELSE concat(' ', p_brand, ' ') END"
    )
    return table(spark, sf_dir, "part").select("p_partkey", text.fix_category(raw).alias("categorie"))


@query("SELECT doc_id, CASE lang WHEN 'fr' THEN 'en' ELSE lang END AS langue FROM documents")
def fill_language(spark, sf_dir):
    raw = F.expr("nullif(lang, 'fr')")
    return table(spark, sf_dir, "documents").select("doc_id", text.fill_language(raw).alias("langue"))


@query("""
SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN date_trunc('second', ts) ELSE ts END AS moment
FROM events
""")
def safe_timestamp(spark, sf_dir):
    raw = F.expr(
        "CASE event_type WHEN 'error' THEN 'bad' WHEN 'view' THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\") "
        "ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'\") END"
    )
    events = table(spark, sf_dir, "events")
    return events.select("event_id", text.utc_wall_clock(text.safe_timestamp(raw)).alias("moment"))


@query("""
SELECT p_partkey, replace(replace(p_name || '/' || p_type, ' ', '_'), '/', '_') AS categorie_key,
  replace(replace(p_brand || '.' || p_name, '.', '_'), ' ', '_') AS source_key FROM part
""")
def sanitize_key(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.path_key(F.expr("concat(p_name, '/', p_type)")).alias("categorie_key"),
        text.path_key(F.expr("concat(p_brand, '.', p_name)"), ". ").alias("source_key"),
    )


@query("""
WITH raw AS (
  SELECT event_id, CASE event_type WHEN 'error' THEN 'nan' WHEN 'view' THEN 'x' WHEN 'signup' THEN NULL
    WHEN 'click' THEN CAST(-value AS VARCHAR) ELSE CAST(value AS VARCHAR) END AS v FROM events)
SELECT event_id, CASE WHEN v IS NULL OR v = 'nan' THEN 'absent' ELSE v END AS texte,
  CASE WHEN v IN ('nan', 'x') THEN NULL ELSE CAST(v AS DOUBLE) END AS nombre,
  CASE WHEN v IS NULL OR v IN ('nan', 'x') THEN 0 ELSE CAST(trunc(CAST(v AS DOUBLE)) AS BIGINT) END AS entier
FROM raw
""")
def safe_casts(spark, sf_dir):
    raw = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE event_type WHEN 'error' THEN 'nan' WHEN 'view' THEN 'x' WHEN 'signup' THEN NULL "
        "WHEN 'click' THEN CAST(-value AS string) ELSE CAST(value AS string) END AS v",
    )
    v = F.col("v")
    return raw.select(
        "event_id",
        numeric.safe_text(v, "absent").alias("texte"),
        numeric.safe_float(v, from_text=True).alias("nombre"),
        numeric.safe_int(v, from_text=True).alias("entier"),
    )


@query("""
SELECT p_partkey, round_even(p_retailprice / 7, 2) AS pair,
  CAST(round(CAST(p_retailprice / 7 AS DECIMAL(38,10)), 2) AS DOUBLE) AS superieur FROM part
""")
def rounding(spark, sf_dir):
    seventh = F.col("p_retailprice") / 7
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        numeric.round_half_even(seventh).alias("pair"),
        numeric.round_half_up(seventh).alias("superieur"),
    )


@query("""
SELECT event_id, CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 5 ELSE 0 END AS INTEGER)
  AS note FROM events
""")
def rating_map(spark, sf_dir):
    classes = F.expr(
        "CASE event_type WHEN 'click' THEN 'star-rating One' WHEN 'view' THEN ' star-rating  Two ' "
        "WHEN 'signup' THEN 'Five' WHEN 'error' THEN '' ELSE 'star-rating' END"
    )
    return table(spark, sf_dir, "events").select("event_id", markup.word_rating(classes).alias("note"))
