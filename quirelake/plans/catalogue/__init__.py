"""Named queries over the given tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}
TASKS_PER_CORE = 4


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            CHECK_SQL[function.__name__] = sql.strip()
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt over several tasks for each core, where the work on a row is much larger than the row itself.

    Spark cuts a scan by its bytes and never within a row group: a million narrow rows can be a single task.
    """
    wanted = TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= wanted else rows.repartition(wanted)


def load_all() -> None:
    from quirelake.plans.catalogue import (  # noqa: F401
        extraction, functions, gold, quality, silver, star, storage, streams,
    )
