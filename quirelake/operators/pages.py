"""Records and links from stored HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.functions import markup
from quirelake.functions.links import resolve_url
from quirelake.functions.numeric import parse_long
from quirelake.functions.text import bind
from quirelake.schemas import SHOP_SITE


def page_links(
    pages: DataFrame, keep=("url",), html="html", targets: Column | None = None, pattern: str = markup.LINK
) -> DataFrame:
    """One row per link of each page. `targets` replaces the plain pattern search."""
    found = targets if targets is not None else markup.links(F.col(html), pattern)
    return pages.select(*keep, F.posexplode(found).alias("position", "link"))


def resolved_links(links: DataFrame, page="url", link="link") -> DataFrame:
    return links.withColumn("target", resolve_url(F.col(page), F.col(link)))


def product_records(pages: DataFrame, run_ts: str, url="url", html="html") -> DataFrame:
    """Product pages to Bronze records. A missing node gives '' or the default,
    and the row is kept for the quarantine step to judge.

    What a page hides is cut away once, and its table is read once for all fields.
    """

    def record(page: Column) -> Column:
        def with_table(table: Column) -> Column:
            reviews = parse_long(F.try_element_at(table, F.lit("Number of reviews")))
            return F.struct(
                markup.heading(page).alias("titre"),
                F.lit("Unknown").alias("auteur"),
                markup.text_of_class(page, "p", "price_color").alias("prix"),
                markup.word_rating(markup.rating_classes(page)).alias("note_etoiles"),
                markup.last_text_of_class(page, "p", "instock", "Out of stock").alias("disponibilite"),
                markup.breadcrumb(page, 3).alias("categorie"),
                markup.direct_paragraph(page, "article", "product_page").alias("description"),
                F.coalesce(F.try_element_at(table, F.lit("UPC")), F.lit("")).alias("isbn"),
                F.coalesce(reviews, F.lit(0)).cast("bigint").alias("nb_avis"),
            )

        return bind(markup.table_map(page), with_table)

    seen = markup.visible(F.coalesce(F.col(html), F.lit("")))
    return pages.select(F.col(url).alias("url"), bind(seen, record).alias("_r")).select(
        "_r.*",
        F.lit("en").alias("langue"),
        F.lit(None).cast("int").alias("annee_publication"),
        "url",
        F.lit(SHOP_SITE).alias("source"),
        F.lit(run_ts).alias("date_scraping"),
    )
