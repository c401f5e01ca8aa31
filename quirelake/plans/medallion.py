"""The daily run: Bronze -> Silver -> Gold -> warehouse."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from quirelake.functions.text import is_blank, safe_timestamp
from quirelake.operators import gold, star
from quirelake.operators.cleaning import Cleaner, clean_library, clean_shop, run_report, to_silver, written_metrics
from quirelake.operators.dedup import latest_versions
from quirelake.operators.quarantine import split_untitled
from quirelake.schemas import BOOK_COLUMNS, GOLD_COLUMNS, LIBRARY_FOLDER, SHOP_FOLDER, STAR
from quirelake.session import discard, prepare, scratch
from quirelake.sources import snapshots, tables
from quirelake.sources.bronze import CORRUPT, ReadFiles, parse_lines, read_lines, split_corrupt


@dataclass(frozen=True)
class Source:
    name: str
    bronze: str
    silver: str
    clean: Cleaner
    key: str = "url"


@dataclass(frozen=True)
class Config:
    shop: Source
    library: Source
    quarantine: str
    gold: str
    star: str
    reports: str
    jdbc: dict[str, str] = field(default_factory=dict)
    rejects: str | None = None


def layout(root: str, jdbc: dict[str, str] | None = None) -> Config:
    """The usual folders below one root."""

    def source(name: str, clean: Cleaner) -> Source:
        return Source(name, f"{root}/bronze/books/source_key={name}", f"{root}/silver/books/{name}", clean)

    return Config(
        shop=source(SHOP_FOLDER, clean_shop),
        library=source(LIBRARY_FOLDER, clean_library),
        quarantine=f"{root}/quarantine",
        gold=f"{root}/gold/analytics",
        star=f"{root}/gold/star",
        reports=f"{root}/reports",
        jdbc=jdbc or {},
        rejects=f"{root}/rejects",
    )


# Defaults that show up when a whole batch lacks the column.
_DEFAULTED = [name for name, default in BOOK_COLUMNS.items() if default is not None]


def stage_versions(records: DataFrame, key: str, path: str) -> DataFrame:
    """Write the newest version per key once, and read that table back.

    Bronze is read and parsed by one job only. The valid rows, the quarantine
    and the report all start from the written table, which also outlives lost
    executors. A line that is no record is a key of its own, so that the table
    holds it with the number of its occurrences.
    """
    rows = records.withColumn("_at", safe_timestamp(F.col("date_scraping")))
    seen = {f"_has_{c}": F.bool_or(F.array_contains("_names", c)) for c in _DEFAULTED}
    versions = latest_versions(rows, [key, CORRUPT], "_at", **seen).drop("_at", "_names")
    versions.write.mode("overwrite").parquet(path)
    return records.sparkSession.read.parquet(path)


def batch_facts(staged: DataFrame) -> Row:
    """What decides how the batch goes on, and the counts of its report, from one pass over the written table."""
    good, untitled, n = F.col(CORRUPT).isNull(), is_blank(F.col("titre")), F.col("n_versions")
    return staged.agg(
        F.count_if(good & untitled).alias("untitled"),
        F.count_if(good & ~untitled).alias("valid"),
        F.coalesce(F.sum(F.when(good, n)), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum(F.when(~good, n)), F.lit(0)).alias("skipped_lines"),
        *[F.bool_or(f"_has_{c}").alias(c) for c in _DEFAULTED],
    ).first()


def fill_absent(staged: DataFrame, facts: Row) -> DataFrame:
    """Defaults for columns that no row of the batch has; null cells stay null."""
    defaults = {c: F.lit(BOOK_COLUMNS[c]) for c in _DEFAULTED if facts[c] is False}
    filled = staged.withColumns(defaults) if defaults else staged
    return filled.drop(*[f"_has_{c}" for c in _DEFAULTED])


def run_source(spark: SparkSession, source: Source, config: Config, run_ts: str) -> DataFrame:
    """One source from Bronze to Silver; returns the stored one-row report.

    Bronze is read by one job, and Silver isn't read at all: the files that gave lines are noted while they are read, the
    counts of Silver while it is written.
    """
    stage, files, written = scratch(spark, f"versions-{source.name}"), ReadFiles(spark), Observation()
    try:
        lines = files.watch(read_lines(spark, source.bronze, "_path"), "_path")
        staged = stage_versions(parse_lines(lines), source.key, stage)
        facts = batch_facts(staged)
        good, _ = split_corrupt(staged)
        valid, untitled = split_untitled(fill_absent(good, facts))
        if facts["skipped_lines"]:
            broken = staged.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("ligne"), "n_versions")
            tables.write_quarantine(broken, f"{config.quarantine}-corrupt", source.name, run_ts)
        if facts["untitled"]:
            tables.write_quarantine(untitled.drop("n_versions"), config.quarantine, source.name, run_ts)
        counts = {}
        if facts["valid"]:
            silver = to_silver(valid.drop("n_versions"), source.clean, run_ts)
            tables.write_silver(silver, source.silver, observation=written, metrics=written_metrics())
            counts = written.get
    finally:
        discard(spark, stage)
    kept = facts["valid"] + facts["untitled"]
    report = run_report(spark, facts["rows_read"], kept, counts, facts["skipped_lines"], files.skipped(source.bronze))
    path = f"{config.reports}/{source.name}/{run_ts.replace(':', '-')}"
    report.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def run_gold(spark: SparkSession, config: Config, run_ts: str) -> None:
    """The five Gold tables. Each scans only its own columns of Silver."""
    shop = tables.read_silver(spark, config.shop.silver)
    library = tables.read_silver(spark, config.library.silver)
    built = gold.gold_tables(shop, library, config.shop.name, config.library.name, run_ts)
    empty = {"shop": shop.isEmpty(), "library": library.isEmpty()}
    needs = {"kpi_par_auteur": ["library"], "livres_flat": ["shop", "library"]}
    filled = {t: df for t, df in built.items() if not all(empty[s] for s in needs.get(t, ["shop"]))}
    if filled:
        tables.write_all(filled, config.gold)


def write_star(spark: SparkSession, silver: DataFrame, root: str) -> snapshots.Snapshot:
    """Rebuild the star schema and the two aggregates over it, and publish them as one version.

    A reader that began with the version before goes on with it; none sees tables of both.
    """

    def build(version: snapshots.Publication) -> None:
        version.write(star.star_from_silver(silver))
        made = version.so_far()
        s = {name: made.table(name, schema) for name, schema in STAR.items() if name in made.tables}
        version.write({
            "agg_genre_stats": star.genre_stats(s["fact_scraping"], s["dim_categorie"], s["dim_disponibilite"]),
            "agg_daily_volumes": star.daily_volumes(s["fact_scraping"], s["dim_date"], s["dim_source"]),
        })

    return snapshots.publish(spark, root, build)


def run_star(spark: SparkSession, config: Config) -> None:
    silver = tables.read_silver(spark, config.shop.silver).unionByName(
        tables.read_silver(spark, config.library.silver)
    )
    if not silver.isEmpty():
        write_star(spark, silver, config.star)


def run_warehouse(spark: SparkSession, config: Config, run_ts: str) -> None:
    """Refresh the warehouse tables that have Gold rows; keep the rejected rows."""
    for table in GOLD_COLUMNS:
        df = tables.read_gold(spark, config.gold, table)
        if df.isEmpty():
            continue
        rejected = tables.load_warehouse(df, table, config.jdbc)
        if config.rejects:
            rejected.write.mode("overwrite").json(f"{config.rejects}/{table}/{run_ts.replace(':', '-')}")


def run(spark: SparkSession, config: Config, run_ts: str) -> dict[str, DataFrame]:
    """The whole run in order; returns the report of each source."""
    prepare(spark)
    reports = {
        source.name: run_source(spark, source, config, run_ts)
        for source in (config.shop, config.library)
    }
    run_gold(spark, config, run_ts)
    run_star(spark, config)
    if config.jdbc:
        run_warehouse(spark, config, run_ts)
    return reports
