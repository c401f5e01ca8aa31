"""Book records derived from the given tables, in Spark and in SQL.

`events` gives the shop's records: many versions per URL, with the kinds of
dirt the cleaning rules are about. `documents` gives the library's records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.plans.catalogue import table
from quirelake.schemas import BOOK_COLUMNS, LIBRARY_SITE, SHOP_SITE

RUN_TS = "2026-05-01T10:00:00Z"


def iso(ts: str):
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def shop_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "CASE event_type WHEN 'error' THEN '  ' ELSE concat(' Tome ', user_id) END AS titre",
        "CASE event_type WHEN 'view' THEN 'Unknown' WHEN 'signup' THEN NULL "
        "ELSE concat(' Auteur ', get_json_object(props, '$.k'), ' ') END AS auteur",
        "CASE event_type WHEN 'signup' THEN NULL WHEN 'click' THEN concat(value, ' EUR') "
        "ELSE concat('£', value) END AS prix",
        "CASE event_type WHEN 'signup' THEN NULL ELSE CAST(length(event_type) AS string) END AS note_etoiles",
        "CASE event_type WHEN 'view' THEN 'In stock (22 available)' WHEN 'click' THEN 'Out of stock' "
        "WHEN 'signup' THEN NULL ELSE 'N/A' END AS disponibilite",
        "CASE event_type WHEN 'click' THEN 'Poetry' WHEN 'view' THEN 'Add a comment' "
        "WHEN 'purchase' THEN 'Science Fiction' WHEN 'signup' THEN NULL ELSE ' Travel ' END AS categorie",
        "CASE event_type WHEN 'signup' THEN '' WHEN 'view' THEN repeat(concat('Event ', event_id, ' by user ', "
        "user_id, ' of type ', event_type, '.'), 2) ELSE concat(' Event ', event_id) END AS description",
        "CASE event_type WHEN 'click' THEN '  ' ELSE concat(' ', get_json_object(props, '$.k'), ' ') END AS isbn",
        "get_json_object(props, '$.k') AS nb_avis",
        "CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN ' ENG ' ELSE 'fre' END AS langue",
        "CASE event_type WHEN 'purchase' THEN NULL ELSE CAST(year(ts) AS string) END AS annee_publication",
        "concat('https://shop.example/', user_id) AS url",
        f"'{SHOP_SITE}' AS source",
        "CASE event_type WHEN 'signup' THEN 'bad' "
        "ELSE concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00') END AS date_scraping",
    )


_K = "regexp_extract(props, '[0-9]+')"

# The same records in SQL, with the parsed date as `moment`.
SHOP_SQL = f"""
shop AS (
  SELECT
    CASE event_type WHEN 'error' THEN '  ' ELSE ' Tome ' || user_id END AS titre,
    CASE event_type WHEN 'view' THEN 'Unknown' WHEN 'signup' THEN NULL ELSE ' Auteur ' || {_K} || ' ' END AS auteur,
    CASE event_type WHEN 'signup' THEN NULL ELSE value END AS prix,
    CASE event_type WHEN 'signup' THEN NULL ELSE CAST(length(event_type) AS DOUBLE) END AS note_etoiles,
    CASE event_type WHEN 'view' THEN 'available' WHEN 'click' THEN 'unavailable' ELSE 'unknown' END AS disponibilite,
    CASE event_type WHEN 'click' THEN 'Poetry' WHEN 'purchase' THEN 'Science Fiction'
      WHEN 'error' THEN 'Travel' ELSE 'Unknown' END AS categorie,
    CASE event_type WHEN 'signup' THEN NULL
      WHEN 'view' THEN 'Event ' || event_id || ' by user ' || user_id || ' of type ' || event_type || '.'
      ELSE 'Event ' || event_id END AS description,
    CASE event_type WHEN 'click' THEN NULL ELSE {_K} END AS isbn,
    CAST({_K} AS BIGINT) AS nb_avis,
    CASE event_type WHEN 'view' THEN 'en' WHEN 'click' THEN ' ENG ' ELSE 'fre' END AS langue,
    CASE event_type WHEN 'purchase' THEN NULL ELSE CAST(year(ts) AS INTEGER) END AS annee_publication,
    'https://shop.example/' || user_id AS url,
    '{SHOP_SITE}' AS source,
    CASE event_type WHEN 'signup' THEN NULL ELSE ts END AS moment,
    event_type
  FROM events
),
shop_latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY moment DESC NULLS LAST) AS rn FROM shop
  ) WHERE rn = 1
),
shop_silver AS (
  SELECT titre,
    CASE WHEN trim(auteur) IN ('Unknown') THEN NULL ELSE trim(auteur) END AS auteur,
    prix, note_etoiles, disponibilite, categorie, description, isbn, nb_avis, langue, annee_publication,
    url, source, moment AS date_scraping,
    CAST(20
      + CASE WHEN auteur IS NOT NULL AND trim(auteur) <> 'Unknown' THEN 20 ELSE 0 END
      + CASE WHEN prix IS NOT NULL THEN 20 ELSE 0 END
      + CASE WHEN note_etoiles IS NOT NULL THEN 20 ELSE 0 END
      + CASE WHEN annee_publication IS NOT NULL THEN 10 ELSE 0 END
      + CASE WHEN isbn IS NOT NULL THEN 10 ELSE 0 END AS INTEGER) AS qualite_score
  FROM shop_latest WHERE trim(titre) <> ''
)
"""

# Three-letter forms of the documents' languages, to be mapped back by the cleaner.
LONG_CODES = {"en": " ENG ", "fr": "fre", "de": "ger", "es": "spa"}
_LONG = "CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LONG_CODES.items()) + " ELSE lang END"


def library_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        "concat('Document ', doc_id) AS titre",
        "CASE lang WHEN 'de' THEN 'unknown ' ELSE concat(' ', source) END AS auteur",
        "'9.99' AS prix",
        "CAST(NULL AS string) AS note_etoiles",
        "'N/A' AS disponibilite",
        "CASE lang WHEN 'fr' THEN 'default' ELSE 'Fiction/Prose' END AS categorie",
        "text AS description",
        "CASE lang WHEN 'es' THEN '' ELSE concat('978', doc_id) END AS isbn",
        "CAST(n_chars AS string) AS nb_avis",
        f"{_LONG} AS langue",
        "CASE lang WHEN 'en' THEN '1954' END AS annee_publication",
        "concat('https://lib.example/works/', doc_id) AS url",
        f"'{LIBRARY_SITE}' AS source",
        "'2026-05-01T10:00:00+00:00' AS date_scraping",
    )


# Python-style stripping in SQL, by the same characters.
WHITESPACE_SQL = (
    "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || ' ' || "
    "chr(133) || chr(160) || chr(5760) || "
    + " || ".join(f"chr({c})" for c in range(0x2000, 0x200B))
    + " || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288)"
)

LIBRARY_SQL = f"""
library_silver AS (
  SELECT
    'Document ' || doc_id AS titre,
    CASE lang WHEN 'de' THEN NULL ELSE source END AS auteur,
    CAST(NULL AS DOUBLE) AS prix,
    CAST(NULL AS DOUBLE) AS note_etoiles,
    'unknown' AS disponibilite,
    CASE lang WHEN 'fr' THEN 'Unknown' ELSE 'Fiction/Prose' END AS categorie,
    trim(regexp_replace(nullif(text, ''), '[\\r\\n]+', ' ', 'g'), {WHITESPACE_SQL}) AS description,
    CASE lang WHEN 'es' THEN NULL ELSE '978' || doc_id END AS isbn,
    n_chars AS nb_avis,
    lang AS langue,
    CASE lang WHEN 'en' THEN 1954 END AS annee_publication,
    'https://lib.example/works/' || doc_id AS url,
    '{LIBRARY_SITE}' AS source,
    TIMESTAMP '2026-05-01 10:00:00' AS date_scraping,
    CAST(20 + CASE WHEN lang <> 'de' THEN 20 ELSE 0 END + CASE WHEN lang = 'en' THEN 10 ELSE 0 END
      + CASE WHEN lang <> 'es' THEN 10 ELSE 0 END AS INTEGER) AS qualite_score
  FROM documents
)
"""

SILVER_LIST = ", ".join([*BOOK_COLUMNS, "qualite_score"])
