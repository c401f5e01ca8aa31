"""Records from stored API answers kept as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.functions.numeric import parse_number
from quirelake.functions.text import capitalize, trim_ws
from quirelake.schemas import LIBRARY_SITE, VOLUME_SITE

WORK = (
    "struct<key: string, title: string, authors: array<struct<name: string>>, "
    "edition_count: bigint, first_publish_year: int>"
)
SUBJECT = f"works array<{WORK}>"
WORK_DETAIL = "description string, isbn_13 array<string>, isbn_10 array<string>"
VOLUME_LIST = "items array<struct<id: string>>"
VOLUME = (
    "volumeInfo struct<title: string, authors: array<string>, averageRating: double, "
    "categories: array<string>, description: string, ratingsCount: bigint, language: string, "
    "publishedDate: string, infoLink: string, "
    "industryIdentifiers: array<struct<type: string, identifier: string>>>, "
    "saleInfo struct<saleability: string, listPrice: struct<amount: string, currencyCode: string>>"
)

LIBRARY_URL = f"https://{LIBRARY_SITE}"
DESCRIPTION_LIMIT = 500


def works(payloads: DataFrame, payload="payload", keep=("subject",)) -> DataFrame:
    """One row per work of each subject answer, with the URL of its detail."""
    listed = payloads.select(*keep, F.explode(F.from_json(payload, SUBJECT)["works"]).alias("work"))
    key = F.coalesce(F.col("work.key"), F.lit(""))
    return listed.withColumn("detail_url", F.concat(F.lit(LIBRARY_URL), key, F.lit(".json")))


def volume_urls(payloads: DataFrame, base: str, payload="payload", keep=("query",)) -> DataFrame:
    """One row per volume of each search answer, with the URL of its detail."""
    listed = payloads.select(*keep, F.explode(F.from_json(payload, VOLUME_LIST)["items"]).alias("_item"))
    volume = F.coalesce(F.col("_item.id"), F.lit(""))
    return listed.select(*keep, volume.alias("volume_id"), F.concat(F.lit(base), volume).alias("detail_url"))


def work_records(
    details: DataFrame, run_ts: str, detail="detail", work="work", subject="subject",
    description_chars: int = DESCRIPTION_LIMIT,
) -> DataFrame:
    """Works joined with their stored details to Bronze records; descriptions are cut to `description_chars`."""
    parsed = details.withColumn("_detail", F.from_json(detail, WORK_DETAIL))
    data = F.col("_detail")
    author = F.get(F.col(f"{work}.authors"), 0)["name"]
    # the description is a text or an object that holds the text as `value`
    as_object = F.from_json(detail, "description struct<value: string>")["description"]
    nested = F.when(as_object.isNotNull(), as_object["value"]).otherwise(data["description"])
    description = F.coalesce(
        F.when(data["description"].startswith("{"), nested).otherwise(data["description"]), F.lit("")
    )
    isbn = F.coalesce(F.get(data["isbn_13"], 0), F.get(data["isbn_10"], 0), F.lit(""))
    key = F.coalesce(F.col(f"{work}.key"), F.lit(""))
    return parsed.select(
        trim_ws(F.coalesce(F.col(f"{work}.title"), F.lit(""))).alias("titre"),
        F.coalesce(author, F.lit("Unknown")).alias("auteur"),
        F.lit(None).cast("string").alias("prix"),
        F.lit(None).cast("double").alias("note_etoiles"),
        F.lit("N/A").alias("disponibilite"),
        capitalize(F.col(subject)).alias("categorie"),
        F.substring(description, 1, description_chars).alias("description"),
        isbn.alias("isbn"),
        F.coalesce(F.col(f"{work}.edition_count"), F.lit(0)).cast("bigint").alias("nb_avis"),
        F.lit("eng").alias("langue"),
        F.col(f"{work}.first_publish_year").alias("annee_publication"),
        F.concat(F.lit(LIBRARY_URL), key).alias("url"),
        F.lit(LIBRARY_SITE).alias("source"),
        F.lit(run_ts).alias("date_scraping"),
    )


def volume_records(
    payloads: DataFrame, run_ts: str, payload="payload", url="url", description_chars: int = DESCRIPTION_LIMIT
) -> DataFrame:
    """Volume answers to Bronze records; descriptions are cut to `description_chars`."""
    parsed = payloads.withColumn("_volume", F.from_json(payload, VOLUME))
    info, sale = F.col("_volume.volumeInfo"), F.col("_volume.saleInfo")
    listed = sale["listPrice"]
    # an object without any field says as little as none
    fields = F.json_object_keys(F.get_json_object(payload, "$.saleInfo.listPrice"))
    price = F.when(
        listed.isNotNull() & (F.size(fields) > 0),
        F.concat_ws(
            " ", F.coalesce(listed["amount"], F.lit("")), F.coalesce(listed["currencyCode"], F.lit(""))
        ),
    )
    isbn = F.get(F.filter(info["industryIdentifiers"], lambda x: x["type"] == "ISBN_13"), 0)["identifier"]
    year = parse_number(F.substring(info["publishedDate"], 1, 4)).try_cast("int")
    return parsed.select(
        trim_ws(F.coalesce(info["title"], F.lit(""))).alias("titre"),
        F.array_join(F.coalesce(info["authors"], F.array(F.lit("Unknown"))), ", ").alias("auteur"),
        price.alias("prix"),
        info["averageRating"].alias("note_etoiles"),
        F.coalesce(sale["saleability"], F.lit("N/A")).alias("disponibilite"),
        F.coalesce(F.get(info["categories"], 0), F.lit("Unknown")).alias("categorie"),
        F.substring(F.coalesce(info["description"], F.lit("")), 1, description_chars).alias("description"),
        F.coalesce(isbn, F.lit("")).alias("isbn"),
        F.coalesce(info["ratingsCount"], F.lit(0)).cast("bigint").alias("nb_avis"),
        F.coalesce(info["language"], F.lit("en")).alias("langue"),
        F.nullif(year, F.lit(0)).alias("annee_publication"),
        F.coalesce(info["infoLink"], F.col(url)).alias("url"),
        F.lit(VOLUME_SITE).alias("source"),
        F.lit(run_ts).alias("date_scraping"),
    )
