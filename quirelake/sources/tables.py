"""Silver, Gold, quarantine and warehouse tables."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelake.operators import warehouse
from quirelake.operators.gold import in_order
from quirelake.schemas import GOLD, PARTITION_KEY, SILVER


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None, merge: bool = False) -> DataFrame:
    """All Parquet files below a path; an absent path reads as an empty table.

    `merge` keeps columns that only some files have, at the price of reading
    every file's footer.
    """
    reader = spark.read
    if merge:
        reader = reader.option("mergeSchema", True)
    elif schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema or T.StructType([]))


def read_silver(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """Silver rows; the folder key is dropped, `categorie` holds the real label."""
    return read_parquet(spark, path, SILVER, merge).drop(PARTITION_KEY)


def write_silver(
    df: DataFrame, path: str, keys=(PARTITION_KEY,), observation: Observation | None = None, metrics: Sequence[Column] = ()
) -> None:
    """Replace the partitions that occur in `df`, leave all others as they are.

    The rebalance hint keeps a partition in few files but splits a huge one over
    many tasks. `metrics` are observed by the tasks that write, after the
    exchange: each of them counts once, whatever was lost and done again before.
    """
    rows = df.hint("rebalance", *keys)
    if observation:
        rows = rows.observe(observation, *metrics)
    (
        rows
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    )


def write_quarantine(df: DataFrame, root: str, source: str, run_ts: str) -> None:
    """One folder per source and run, so a repeated run replaces its own rows only."""
    folder = f"{root.rstrip('/')}/{source}/{run_ts.replace(':', '-')}"
    df.write.mode("overwrite").option("ignoreNullFields", False).json(folder)


def gold_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def write_gold(df: DataFrame, root: str, table: str) -> None:
    """Replace one table. Aggregates arrive in few partitions already, and a
    flat table is written by the tasks that read it, without a shuffle."""
    df.write.mode("overwrite").parquet(gold_path(root, table))


def write_all(frames: dict[str, DataFrame], root: str) -> None:
    """Replace several tables at once. Their jobs run side by side, so the tail
    of one does not leave the cluster idle."""
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        for done in [pool.submit(write_gold, df, root, table) for table, df in frames.items()]:
            done.result()


def read_gold(spark: SparkSession, root: str, table: str, ordered: bool = False) -> DataFrame:
    df = read_parquet(spark, gold_path(root, table), GOLD.get(table))
    return in_order(df, table) if ordered else df


def read_jdbc(spark: SparkSession, options: dict[str, str], query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options).option("query", query).load()


def load_warehouse(
    df: DataFrame, table: str, options: dict[str, str], connections: int = 8, fmt: str = "jdbc"
) -> DataFrame:
    """Refresh one warehouse table and return the rejected rows.

    The rows go in batches over `connections` connections; the exchange before
    the write keeps the tasks that read the table as many as they are. The table
    is emptied, not dropped, so its id column and grants stay.
    """
    loadable, rejected = warehouse.split_rejects(warehouse.project(df, table), table)
    (
        loadable.repartition(connections).write.format(fmt).options(**options)
        .option("dbtable", table)
        .option("truncate", "true")
        .option("numPartitions", str(connections))
        .option("batchsize", "10000")
        .option("createTableColumnTypes", warehouse.column_types(table))
        .mode("overwrite").save()
    )
    return rejected


def event_payload(df: DataFrame, value: str = "value") -> DataFrame:
    """Records as the JSON value of a topic message; no key, nulls kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(value))


def publish(df: DataFrame, topic: str, options: dict[str, str], fmt: str = "kafka") -> None:
    event_payload(df).write.format(fmt).options(**options).option("topic", topic).save()
