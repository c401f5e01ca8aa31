"""De-duplication, quarantine and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelake.functions.scoring import quality_score as score
from quirelake.functions.text import utc_wall_clock
from quirelake.operators import cleaning, dedup, quarantine
from quirelake.plans.catalogue import query, table
from quirelake.plans.catalogue.bindings import (
    LIBRARY_SQL, RUN_TS, SHOP_SQL, SILVER_LIST, library_books, shop_books,
)
from quirelake.schemas import BOOK_COLUMNS, SILVER_COLUMNS


def plain(df):
    """The Silver columns with the date as UTC wall-clock time, without run tags."""
    columns = [c for c in SILVER_COLUMNS if c not in ("date_silver", "source_layer")]
    return df.select(*columns).withColumn("date_scraping", utc_wall_clock(F.col("date_scraping")))


def shop_versions(spark, sf_dir):
    rows = shop_books(spark, sf_dir).withColumn("_at", F.try_to_timestamp("date_scraping"))
    return dedup.latest_versions(rows, "url", "_at").drop("_at")


def shop_silver(spark, sf_dir):
    valid, _ = quarantine.split_untitled(shop_versions(spark, sf_dir).drop("n_versions"))
    return cleaning.to_silver(valid, cleaning.clean_shop, RUN_TS)


def library_silver(spark, sf_dir):
    return cleaning.to_silver(library_books(spark, sf_dir), cleaning.clean_library, RUN_TS)


@query("""
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM events)
WHERE rn = 1
""")
def dedup_latest(spark, sf_dir):
    return dedup.keep_latest(table(spark, sf_dir, "events"), "user_id", "ts", ties=[F.col("event_id")])


@query("""
WITH o AS (SELECT CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_custkey END AS k,
    CASE o_orderpriority WHEN '5-LOW' THEN NULL ELSE o_orderdate END AS d, o_orderkey FROM orders)
SELECT k, d, o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY d DESC NULLS LAST, o_orderkey DESC) AS rn FROM o) WHERE rn = 1
""")
def dedup_null_keys(spark, sf_dir):
    """Null keys form one group, null dates lose; ties by order key."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_custkey END AS k",
        "CASE o_orderpriority WHEN '5-LOW' THEN NULL ELSE o_orderdate END AS d",
        "o_orderkey",
    )
    return dedup.keep_latest(rows, "k", "d", ties=[F.col("o_orderkey")])


@query("""
WITH o AS (SELECT CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_custkey END AS k FROM orders)
SELECT CAST(count(*) AS BIGINT) AS rows_read, count(DISTINCT k) + max(CASE WHEN k IS NULL THEN 1 ELSE 0 END) AS rows_kept,
  count(*) - count(DISTINCT k) - max(CASE WHEN k IS NULL THEN 1 ELSE 0 END) AS duplicates
FROM o
""")
def dedup_report(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr("CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_custkey END AS k")
    return dedup.duplicate_report(rows, "k")


def _titled(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.withColumn(
        "titre", F.expr("CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN ' \t ' ELSE event_type END")
    )


@query("SELECT event_id, event_type AS titre FROM events WHERE event_type NOT IN ('error', 'view')")
def quarantine_valid(spark, sf_dir):
    return quarantine.split_untitled(_titled(spark, sf_dir))[0].select("event_id", "titre")


@query("""
SELECT event_id, CASE event_type WHEN 'view' THEN ' ' || chr(9) || ' ' END AS titre FROM events
WHERE event_type IN ('error', 'view')
""")
def quarantine_invalid(spark, sf_dir):
    return quarantine.split_untitled(_titled(spark, sf_dir))[1].select("event_id", "titre")


CUT = "TIMESTAMP '2024-01-15 00:00:00'"


@query(f"""
WITH pages AS (SELECT CASE event_type WHEN 'error' THEN NULL ELSE user_id || '/' || hour(ts) || '/' || event_type END AS url, ts FROM events)
SELECT DISTINCT url FROM pages WHERE ts >= {CUT} AND url IS NOT NULL
  AND url NOT IN (SELECT url FROM pages WHERE ts < {CUT} AND url IS NOT NULL)
""")
def frontier_new_urls(spark, sf_dir):
    """What each user did at which hour, before and after a time; some rows have no key."""
    pages = table(spark, sf_dir, "events").selectExpr(
        "CASE event_type WHEN 'error' THEN NULL ELSE concat_ws('/', user_id, hour(ts), event_type) END AS url", "ts"
    )
    cut = F.expr(f"CAST({CUT} AS timestamp_ntz)")
    return dedup.new_keys(pages.filter(F.col("ts") >= cut), pages.filter(F.col("ts") < cut), "url").select("url")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS titre, CAST(NULL AS VARCHAR) AS prix, 'unknown' AS disponibilite,
  'Unknown' AS categorie, '0' AS nb_avis, CASE o_orderstatus WHEN 'P' THEN NULL ELSE 'u' || o_custkey END AS url,
  o_orderpriority AS supplement FROM orders
""")
def schema_align(spark, sf_dir):
    """Required columns that are absent get their defaults, extra ones stay, null cells stay null."""
    batch = table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS string) AS titre",
        "CASE o_orderstatus WHEN 'P' THEN NULL ELSE concat('u', o_custkey) END AS url",
        "o_orderpriority AS supplement",
    )
    aligned = cleaning.align(batch, BOOK_COLUMNS)
    return aligned.select("titre", "prix", "disponibilite", "categorie", "nb_avis", "url", "supplement")


@query("""
SELECT p_partkey, CAST(CASE p_type WHEN 'SMALL' THEN 0 ELSE 20 END + CASE p_type WHEN 'PROMO' THEN 0 ELSE 20 END
  + CASE p_type WHEN 'LARGE' THEN 0 ELSE 20 END + 20 + CASE p_type WHEN 'MEDIUM' THEN 0 ELSE 10 END
  + CASE p_type WHEN 'PROMO' THEN 0 ELSE 10 END AS INTEGER) AS qualite_score FROM part
""")
def quality_score(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "CASE p_type WHEN 'SMALL' THEN '' ELSE p_name END AS titre",
        "CASE p_type WHEN 'PROMO' THEN NULL ELSE p_brand END AS auteur",
        "CASE p_type WHEN 'LARGE' THEN NULL ELSE 0D END AS prix",
        "0D AS note_etoiles",
        "CASE p_type WHEN 'MEDIUM' THEN NULL ELSE p_size END AS annee_publication",
        "CASE p_type WHEN 'PROMO' THEN '' ELSE p_brand END AS isbn",
    )
    return rows.select("p_partkey", score().alias("qualite_score"))


@query(f"WITH {SHOP_SQL} SELECT {SILVER_LIST} FROM shop_silver")
def silver_source1(spark, sf_dir):
    return plain(shop_silver(spark, sf_dir))


@query(f"WITH {LIBRARY_SQL} SELECT {SILVER_LIST} FROM library_silver")
def silver_source2(spark, sf_dir):
    return plain(library_silver(spark, sf_dir))


@query(f"""
WITH {SHOP_SQL}
SELECT (SELECT count(*) FROM shop) AS rows_read, (SELECT count(*) FROM shop_latest) AS rows_deduplicated,
  count(*) AS rows_written, round(avg(qualite_score), 1) AS mean_score, count(DISTINCT categorie) AS categories,
  (SELECT count(*) FROM shop_latest) - count(*) AS rows_quarantined
FROM shop_silver
""")
def silver_report(spark, sf_dir):
    versions = shop_versions(spark, sf_dir)
    valid, _ = quarantine.split_untitled(versions)
    return cleaning.silver_report(versions, cleaning.to_silver(valid, cleaning.clean_shop, RUN_TS))


@query(f"WITH {SHOP_SQL} SELECT DISTINCT categorie FROM shop_silver ORDER BY categorie")
def silver_categories(spark, sf_dir):
    return cleaning.category_list(shop_silver(spark, sf_dir))
