"""Links and records out of stored pages and API answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelake.functions import markup
from quirelake.functions.links import resolve_url
from quirelake.operators import pages, payloads
from quirelake.plans.catalogue import query, spread, table
from quirelake.plans.catalogue.bindings import RUN_TS
from quirelake.schemas import LIBRARY_SITE, SHOP_SITE, VOLUME_SITE

_LINKS_SQL = """
links AS (
  SELECT page_id, url, unnest(l) AS link, unnest(range(len(l))) AS position
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages))
"""


@query(f"WITH {_LINKS_SQL} SELECT page_id, CAST(position AS INTEGER) AS position, "
       "replace(link, '&amp;', '&') AS link FROM links")
def page_links(spark, sf_dir):
    return pages.page_links(table(spark, sf_dir, "pages"), keep=["page_id"])


@query(f"""
WITH {_LINKS_SQL}
SELECT page_id, CAST(position AS INTEGER) AS position,
  CASE WHEN link LIKE 'http%' THEN link
    ELSE regexp_extract(url, '^(https?://[^/?#]*)', 1) || replace(link, '&amp;', '&') END AS target
FROM links
""")
def page_links_resolved(spark, sf_dir):
    links = pages.page_links(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return pages.resolved_links(links).select("page_id", "position", "target")


@query("""
SELECT page_id, trim(replace(replace(regexp_extract(html, '<h1>([^<]*)', 1), '&quot;', '"'), '&amp;', '&')) AS titre,
  trim(replace(replace(regexp_extract(html, '<title>([^<]*)', 1), '&quot;', '"'), '&amp;', '&')) AS titre_onglet
FROM pages
""")
def page_headings(spark, sf_dir):
    html = markup.visible(F.col("html"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        markup.heading(html).alias("titre"),
        markup.first_text(html, r"<title\b[^>]*>", "title").alias("titre_onglet"),
    )


def _category_pages(spark, sf_dir):
    """A listing page per supplier with its parts' country, in the shop's markup; links in comments and scripts are none."""
    nav = (
        "concat('<!-- <h3><a href=\"dead.html\">x</a></h3> --><script>var a = [<h3><a href=\"no.html\">x</a></h3>];</script>"
        "<style><a href=none.html></style><ul class=\"nav nav-list\"><li><a href=\"index.html\">Books</a><ul>"
        "<li><a href=\"category/', s_nationkey, '/index.html\">N</a></li></ul></li></ul>"
        "<article class=\"product_pod\"><h3><a title=x data-href=no href=../../', s_suppkey, '/index.html>x</a></h3>"
        "</article><ul class=\"pager\"><li class=\"next\"><a href=\"page-2.html?a=1&amp;b=', s_suppkey, '\">next</a>"
        "</li></ul>')"
    )
    return spread(table(spark, sf_dir, "supplier")).selectExpr(
        "s_suppkey", "concat('https://shop.example/catalogue/', s_suppkey, '/index.html') AS url", f"{nav} AS html"
    )


@query("""
SELECT s_suppkey, 'https://shop.example/catalogue/' || s_suppkey || '/category/' || s_nationkey || '/index.html'
    AS categorie,
  'https://shop.example/' || s_suppkey || '/index.html' AS produit,
  'https://shop.example/catalogue/' || s_suppkey || '/page-2.html?a=1&b=' || s_suppkey AS suivante
FROM supplier
""")
def page_navigation(spark, sf_dir):
    html, url = F.col("html"), F.col("url")

    def first(found):
        return resolve_url(url, F.get(found, F.lit(0)))

    return _category_pages(spark, sf_dir).select(
        "s_suppkey",
        first(markup.category_links(html)).alias("categorie"),
        first(markup.links(html, markup.PRODUCT_LINK)).alias("produit"),
        first(markup.links(html, markup.NEXT_LINK)).alias("suivante"),
    )


def _product_pages(spark, sf_dir):
    """A product page per part, in the shop's markup."""
    html = (
        "concat('<html><ul class=\"breadcrumb\"><li><a href=\"/\">Home</a></li><li><a href=\"/b\">Books</a></li>"
        "<li><a href=\"/c\">', p_type, '</a></li><li class=\"active\">x</li></ul>', "
        "'<script>document.write(\"<h1>no</h1>\")</script><article class=\"product_page\"><!-- <h1>no</h1> -->"
        "<article class=\"aside\"><p>no</p><article><p class=x>neither</p></article></article><div class=\"row\">', "
        "CASE p_type WHEN 'LARGE' THEN concat(repeat('<div>', 12), '<p>not this</p>', repeat('</div>', 12)) "
        "WHEN 'PROMO' THEN '<section><p>nor this</p></section>' ELSE '<div class=\"col\"><p>not this</p></div>' END, '</div>"
        "<h1>', CASE p_type WHEN 'LARGE' THEN '<span>new</span>' ELSE '' END, ' ', p_name, ' &amp;&#0000032;c&#x6F; </h1>"
        "<p class=\"price_color\">&pound;', p_retailprice, '</p>', "
        "CASE p_type WHEN 'SMALL' THEN '' WHEN 'PROMO' THEN concat('<p class=\"instock\">In stock (', p_size, "
        "' available) <b>now</b></p>') ELSE concat('<p class=\"instock availability\"><i class=\"icon-ok\"></i>\n"
        " In stock (', p_size, ' available)\n</p>') END, "
        "'<p class=\"star-rating ', CASE p_type WHEN 'PROMO' THEN 'Three' WHEN 'LARGE' THEN 'Five' ELSE 'Zero' END, "
        "'\"><i></i></p><div id=\"product_description\"><h2>About</h2></div>"
        "<table class=\"table\"><tr><th>UPC</th><td>', p_brand, '</td></tr><tr><th>Number of reviews</th><td>', "
        "p_size, '</td></tr></table><table class=\"other\"><tr><th>UPC</th><td>wrong</td></tr></table></article></html>')"
    )
    return spread(table(spark, sf_dir, "part")).selectExpr(
        "p_partkey", "concat('https://shop.example/', p_partkey) AS url", f"{html} AS html"
    )


@query(f"""
SELECT p_name || ' & co' AS titre, 'Unknown' AS auteur, '£' || p_retailprice AS prix,
  CAST(CASE p_type WHEN 'PROMO' THEN 3 WHEN 'LARGE' THEN 5 ELSE 0 END AS INTEGER) AS note_etoiles,
  CASE p_type WHEN 'SMALL' THEN 'Out of stock' ELSE 'In stock (' || p_size || ' available)' END AS disponibilite,
  p_type AS categorie, '£' || p_retailprice AS description, p_brand AS isbn, CAST(p_size AS BIGINT) AS nb_avis,
  'en' AS langue, CAST(NULL AS INTEGER) AS annee_publication, 'https://shop.example/' || p_partkey AS url,
  '{SHOP_SITE}' AS source, '{RUN_TS}' AS date_scraping
FROM part
""")
def page_record(spark, sf_dir):
    return pages.product_records(_product_pages(spark, sf_dir), RUN_TS)


@query("SELECT p_partkey, p_brand AS upc, CAST(p_size AS VARCHAR) AS avis, 2 AS lignes FROM part")
def page_kv_map(spark, sf_dir):
    return (
        _product_pages(spark, sf_dir)
        .withColumn("t", markup.table_map(F.col("html")))
        .select(
            "p_partkey",
            F.try_element_at("t", F.lit("UPC")).alias("upc"),
            F.try_element_at("t", F.lit("Number of reviews")).alias("avis"),
            F.size("t").alias("lignes"),
        )
    )


def _subject_payloads(spark, sf_dir):
    """An answer per order that lists two works; pending orders answer without a list."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_orderstatus",
        "o_custkey",
        "CASE o_orderstatus WHEN 'O' THEN 'historical FICTION' ELSE 'science' END AS subject",
        "CASE o_orderstatus WHEN 'P' THEN '{}' ELSE to_json(named_struct('works', array("
        "named_struct('key', concat('/works/', o_orderkey), 'title', concat(' Order ', o_orderkey, ' '), "
        "'authors', array(named_struct('name', concat('Customer ', o_custkey)), named_struct('name', 'Other')), "
        "'edition_count', o_custkey, 'first_publish_year', year(o_orderdate)), "
        "named_struct('key', concat('/works/', o_orderkey, '-b'), 'title', 'Second', "
        "'authors', CAST(array() AS array<struct<name:string>>), 'edition_count', CAST(NULL AS bigint), "
        "'first_publish_year', CAST(NULL AS int))))) END AS payload",
    )


_WORKS_SQL = """
works AS (
  SELECT *, '/works/' || o_orderkey AS work_key, TRUE AS lead FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL
  SELECT *, '/works/' || o_orderkey || '-b' AS work_key, FALSE AS lead FROM orders WHERE o_orderstatus <> 'P')
"""


@query(f"""
WITH {_WORKS_SQL}
SELECT o_orderkey, work_key, 'https://{LIBRARY_SITE}' || work_key || '.json' AS detail_url FROM works
""")
def json_explode(spark, sf_dir):
    works = payloads.works(_subject_payloads(spark, sf_dir), keep=["o_orderkey"])
    return works.select("o_orderkey", F.col("work.key").alias("work_key"), "detail_url")


@query(f"""
WITH {_WORKS_SQL}
SELECT CASE WHEN lead THEN 'Order ' || o_orderkey ELSE 'Second' END AS titre,
  CASE WHEN lead THEN 'Customer ' || o_custkey ELSE 'Unknown' END AS auteur,
  CAST(NULL AS VARCHAR) AS prix, CAST(NULL AS DOUBLE) AS note_etoiles, 'N/A' AS disponibilite,
  CASE o_orderstatus WHEN 'O' THEN 'Historical fiction' ELSE 'Science' END AS categorie,
  CASE WHEN NOT lead THEN '' WHEN o_orderstatus = 'O' THEN substr(repeat(o_custkey || ' ', 300), 1, 500)
    ELSE 'about ' || o_custkey END AS description,
  CASE WHEN NOT lead THEN '' WHEN o_orderstatus = 'O' THEN '978' || o_custkey ELSE '10' || o_custkey END AS isbn,
  CASE WHEN lead THEN o_custkey ELSE 0 END AS nb_avis, 'eng' AS langue,
  CASE WHEN lead THEN CAST(year(o_orderdate) AS INTEGER) END AS annee_publication,
  'https://{LIBRARY_SITE}' || work_key AS url, '{LIBRARY_SITE}' AS source, '{RUN_TS}' AS date_scraping
FROM works
""")
def json_work_record(spark, sf_dir):
    """Details hold a text, an object or no description, and maybe an empty ISBN list."""
    works = payloads.works(_subject_payloads(spark, sf_dir), keep=["subject", "o_orderstatus", "o_custkey"])
    detail = F.expr(
        "CASE WHEN work.key LIKE '%-b' THEN '{}' "
        "WHEN o_orderstatus = 'O' THEN to_json(named_struct('description', repeat(concat(o_custkey, ' '), 300), "
        "'isbn_13', array(concat('978', o_custkey)))) "
        "ELSE to_json(named_struct('description', named_struct('value', concat('about ', o_custkey)), "
        "'isbn_13', CAST(array() AS array<string>), 'isbn_10', array(concat('10', o_custkey)))) END"
    )
    return payloads.work_records(works.withColumn("detail", detail), RUN_TS)


def _volume_payloads(spark, sf_dir):
    """A volume answer per part: with and without price, authors, ISBN, date."""
    return spread(table(spark, sf_dir, "part")).selectExpr(
        "p_partkey",
        "concat('https://vol.example/', p_partkey) AS url",
        "to_json(named_struct('volumeInfo', named_struct('title', concat(' ', p_name, ' '), "
        "'authors', CASE p_type WHEN 'SMALL' THEN NULL ELSE array(p_brand, 'C D') END, "
        "'averageRating', p_size / 10, 'categories', CASE p_type WHEN 'LARGE' THEN CAST(array() AS array<string>) "
        "ELSE array(p_type, 'Other') END, 'description', repeat(p_name, 100), 'ratingsCount', p_size, "
        "'language', CASE p_type WHEN 'PROMO' THEN NULL ELSE 'fr' END, "
        "'publishedDate', CASE p_type WHEN 'ECONOMY' THEN '9e99' WHEN 'MEDIUM' THEN '2004' ELSE '1999-05-01' END, "
        "'infoLink', CASE p_type WHEN 'SMALL' THEN concat('https://info.example/', p_partkey) END, "
        "'industryIdentifiers', CASE p_type WHEN 'STANDARD' THEN NULL ELSE array("
        "named_struct('type', 'ISBN_10', 'identifier', 'x'), "
        "named_struct('type', 'ISBN_13', 'identifier', concat('978', p_partkey)), "
        "named_struct('type', 'ISBN_13', 'identifier', 'later')) END), "
        "'saleInfo', named_struct('saleability', 'FOR_SALE', 'listPrice', CASE p_type WHEN 'PROMO' THEN NULL "
        "WHEN 'LARGE' THEN named_struct('amount', CAST(NULL AS double), 'currencyCode', CAST(NULL AS string)) "
        "ELSE named_struct('amount', p_retailprice, 'currencyCode', 'EUR') END))) AS payload",
    )


@query(f"""
SELECT p_name AS titre, CASE p_type WHEN 'SMALL' THEN 'Unknown' ELSE p_brand || ', C D' END AS auteur,
  CASE WHEN p_type IN ('PROMO', 'LARGE') THEN NULL ELSE p_retailprice || ' EUR' END AS prix, p_size / 10 AS note_etoiles,
  'FOR_SALE' AS disponibilite, CASE p_type WHEN 'LARGE' THEN 'Unknown' ELSE p_type END AS categorie,
  substr(repeat(p_name, 100), 1, 500) AS description,
  CASE p_type WHEN 'STANDARD' THEN '' ELSE '978' || p_partkey END AS isbn, CAST(p_size AS BIGINT) AS nb_avis,
  CASE p_type WHEN 'PROMO' THEN 'en' ELSE 'fr' END AS langue,
  CAST(CASE p_type WHEN 'ECONOMY' THEN NULL WHEN 'MEDIUM' THEN 2004 ELSE 1999 END AS INTEGER) AS annee_publication,
  CASE p_type WHEN 'SMALL' THEN 'https://info.example/' ELSE 'https://vol.example/' END || p_partkey AS url,
  '{VOLUME_SITE}' AS source, '{RUN_TS}' AS date_scraping
FROM part
""")
def json_volume_record(spark, sf_dir):
    return payloads.volume_records(_volume_payloads(spark, sf_dir), RUN_TS)


@query("""
SELECT o_orderkey, 'v' || o_orderkey AS volume_id, 'https://vol.example/volumes/v' || o_orderkey AS detail_url
FROM orders WHERE o_orderstatus <> 'P'
UNION ALL
SELECT o_orderkey, 'w' || o_custkey, 'https://vol.example/volumes/w' || o_custkey FROM orders WHERE o_orderstatus <> 'P'
""")
def json_volume_list(spark, sf_dir):
    answers = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE o_orderstatus WHEN 'P' THEN '{}' ELSE to_json(named_struct('items', array("
        "named_struct('id', concat('v', o_orderkey)), named_struct('id', concat('w', o_custkey))))) END AS payload",
    )
    return payloads.volume_urls(answers, "https://vol.example/volumes/", keep=["o_orderkey"])
