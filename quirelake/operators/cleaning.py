"""Cleaning of whole records, from Bronze text to typed Silver rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.functions import numeric, text
from quirelake.functions.scoring import quality_score
from quirelake.schemas import BOOK_COLUMNS, PARTITION_KEY, SILVER_TYPES

Cleaner = Callable[[DataFrame], DataFrame]


def align(df: DataFrame, required: dict[str, str | None] = BOOK_COLUMNS) -> DataFrame:
    """Add the required columns the batch lacks, with their defaults; keep all others.

    The default belongs to an absent column, not to a null cell.
    """
    absent = {n: F.lit(d).cast("string") for n, d in required.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df


def clean_shop(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "prix": numeric.clean_price(F.col("prix")),
        "auteur": text.clean_author(F.col("auteur")),
        "description": text.drop_repeated_half(F.col("description")),
        "disponibilite": text.normalize_availability(F.col("disponibilite")),
        "isbn": text.blank_to_null(F.col("isbn")),
        "langue": text.fill_language(F.col("langue")),
        "categorie": text.fix_category(F.col("categorie")),
    })


def clean_library(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "prix": F.lit(None).cast("double"),
        "auteur": text.clean_author(F.col("auteur")),
        "description": text.join_lines(F.col("description")),
        "disponibilite": text.normalize_availability(F.col("disponibilite")),
        "isbn": text.blank_to_null(F.col("isbn")),
        "langue": text.normalize_language(F.col("langue")),
        "categorie": text.fix_category(F.col("categorie")),
    })


def set_types(df: DataFrame, types: dict[str, str] = SILVER_TYPES) -> DataFrame:
    """Give the text columns their Silver types; what does not parse becomes null."""
    casts = {}
    for name, kind in types.items():
        if name not in df.columns or df.schema[name].dataType.simpleString() != "string":
            continue
        c = F.col(name)
        if kind == "timestamp":
            casts[name] = text.safe_timestamp(c)
        elif kind == "double":
            casts[name] = numeric.parse_number(c)
        else:
            casts[name] = numeric.parse_number(c).try_cast(kind)
    return df.withColumns(casts)


def to_silver(df: DataFrame, clean: Cleaner, run_ts: str) -> DataFrame:
    """Valid Bronze rows to Silver: clean, type, score, tag."""
    return set_types(clean(df)).withColumns({
        "qualite_score": quality_score(),
        "date_silver": F.lit(run_ts),
        "source_layer": F.lit("silver"),
        PARTITION_KEY: text.path_key(F.col("categorie")),
    })


def silver_report(versions: DataFrame, silver: DataFrame) -> DataFrame:
    """One row: rows read, kept, set aside, written, mean score, categories.

    `versions` is the de-duplicated table with `n_versions`, so that no second
    pass over Bronze is needed to count it.
    """
    kept = versions.agg(
        F.coalesce(F.sum("n_versions"), F.lit(0)).alias("rows_read"),
        F.count(F.lit(1)).alias("rows_deduplicated"),
    )
    written = silver.agg(
        F.count(F.lit(1)).alias("rows_written"),
        numeric.round_exact(F.avg("qualite_score"), 1).alias("mean_score"),
        F.count_distinct("categorie").alias("categories"),
    )
    return merge_single_rows(kept, written).withColumn(
        "rows_quarantined", F.col("rows_deduplicated") - F.col("rows_written")
    )


def written_metrics() -> list[Column]:
    """What a write of Silver observes for the run's report; the categories are those of its folders."""
    return [
        F.count(F.lit(1)).alias("rows_written"), F.avg("qualite_score").alias("mean_score"),
        F.collect_set("categorie").alias("categories"),
    ]


def run_report(
    spark: SparkSession, rows_read: int, rows_deduplicated: int, written: dict, skipped_lines: int, skipped: DataFrame
) -> DataFrame:
    """The row of `silver_report` from counts that the run has made on its way, with the skipped lines and files."""
    n = written.get("rows_written", 0)
    values = (rows_read, rows_deduplicated, n, written.get("mean_score"), len(written.get("categories", ())), rows_deduplicated - n, skipped_lines)
    row = spark.createDataFrame(
        [values], "rows_read bigint, rows_deduplicated bigint, rows_written bigint, mean_score double, categories bigint, "
        "rows_quarantined bigint, skipped_lines bigint",
    )
    files = skipped.agg(F.count(F.lit(1)).alias("skipped_files"))
    return merge_single_rows(row.withColumn("mean_score", numeric.round_exact(F.col("mean_score"), 1)), files)


def category_list(silver: DataFrame, category: str = "categorie") -> DataFrame:
    """The distinct categories in order, as a table and not as one array cell."""
    return silver.select(category).distinct().orderBy(category)


def merge_single_rows(*rows: DataFrame) -> DataFrame:
    """Put one-row tables with different columns side by side."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in stacked.columns])
