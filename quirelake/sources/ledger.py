"""Incremental Bronze: every file is read once, and a ledger knows which.

A run reads the files that no committed run has: those that are new, or whose length or time is another than noted. It
parses them once into a stage, writes the newest row per key of its files, and commits by writing its page of the ledger
(path, length, time, lines and broken lines of each file). What a run wrote counts only if its page is there, so a run
that dies leaves nothing behind that counts, and the next one reads exactly the files that were not committed.

The driver holds the paths of the files of one run, as any reader does.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelake.functions.text import safe_timestamp
from quirelake.operators.dedup import content_hash, latest_versions
from quirelake.session import discard, folders, scratch, subfolders
from quirelake.sources.bronze import CORRUPT, EXTRAS, listed_files, parse_lines
from quirelake.schemas import BOOK_COLUMNS

PAGE = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("length", T.LongType()), T.StructField("modified", T.TimestampType()),
    T.StructField("lines", T.LongType()), T.StructField("broken", T.LongType()),
])
_ROWS = T.StructType([
    *[T.StructField(c, T.StringType()) for c in BOOK_COLUMNS], T.StructField(EXTRAS, T.MapType(T.StringType(), T.StringType())),
    T.StructField("_at", T.TimestampType()), T.StructField("n_versions", T.LongType()),
])


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """The files of all committed runs."""
    runs = folders(spark, f"{root}/ledger")
    return spark.read.schema(PAGE).parquet(*[f"{root}/ledger/{r}" for r in runs]) if runs else spark.createDataFrame([], PAGE)


def pending_files(spark: SparkSession, prefix: str, root: str) -> DataFrame:
    """path, length, modified of the files that no committed run has read as they are now."""
    return listed_files(spark, prefix).join(read_ledger(spark, root).drop("lines", "broken"), ["path", "length", "modified"], "left_anti")


def stage_run(spark: SparkSession, prefix: str, root: str, key: str = "url") -> str | None:
    """Read what is pending and write the run's rows and its page, still without effect. The run's name, if there is one."""
    files = pending_files(spark, prefix, root).collect()
    if not files:
        return None
    done = subfolders(spark, f"{root}/ledger")
    run = f"{int(done[-1].split('-')[0]) + 1 if done else 0:08d}-{uuid.uuid4().hex[:8]}"
    stage = scratch(spark, "bronze-run")
    try:
        reader = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
        lines = reader.text([f["path"] for f in files]).withColumn("_path", F.col("_metadata.file_path"))
        parse_lines(lines, keep=["_path"]).drop("_names").write.parquet(stage)
        rows = spark.read.parquet(stage)
        good = rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "_path").withColumn("_at", safe_timestamp(F.col("date_scraping")))
        latest_versions(good, key, "_at").write.parquet(f"{root}/rows/{run}")
        uri = F.regexp_replace("_path", "^([a-z0-9]+):/+", "$1:/").alias("_uri")
        counted = rows.groupBy(uri).agg(F.count(F.lit(1)).alias("lines"), F.count(CORRUPT).alias("broken"))
        listed = spark.createDataFrame(files, "path string, length bigint, modified timestamp")
        listed = listed.withColumn("_uri", F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/"))
        page = listed.join(counted, "_uri", "left").drop("_uri").fillna(0, ["lines", "broken"])
        page.select(*PAGE.names).coalesce(1).write.parquet(f"{root}/pages/{run}")
    finally:
        discard(spark, stage)
    return run


def commit_run(spark: SparkSession, root: str, run: str) -> None:
    """Enter the run's page into the ledger; from now on its rows count. What dead runs have left is deleted."""
    spark.read.schema(PAGE).parquet(f"{root}/pages/{run}").coalesce(1).write.parquet(f"{root}/ledger/{run}")
    committed = set(folders(spark, f"{root}/ledger"))
    for kind in ("pages", "rows"):
        for name in subfolders(spark, f"{root}/{kind}"):
            if name not in committed or kind == "pages":
                discard(spark, f"{root}/{kind}/{name}")


def ingest(spark: SparkSession, prefix: str, root: str, key: str = "url") -> int:
    """One run over what is pending; how many files it has read."""
    run = stage_run(spark, prefix, root, key)
    if run is None:
        return 0
    commit_run(spark, root, run)
    return spark.read.schema(PAGE).parquet(f"{root}/ledger/{run}").count()


def read_versions(spark: SparkSession, root: str, key: str = "url") -> DataFrame:
    """The newest row per key over all committed runs, and the number of its versions."""
    runs = folders(spark, f"{root}/ledger")
    if not runs:
        return spark.createDataFrame([], _ROWS).drop("_at")
    rows = spark.read.schema(_ROWS).parquet(*[f"{root}/rows/{r}" for r in runs])
    seen = rows.withColumnRenamed("n_versions", "_n")
    ties = [content_hash(seen.drop("_n", "_at"))]
    merged = latest_versions(seen, key, "_at", ties, _total=F.sum("_n"))
    return merged.drop("_n", "_at", "n_versions").withColumnRenamed("_total", "n_versions")
