"""Tables stored by key bucket, and the set of visited keys as one of them.

A key's bucket is its hash modulo a number that is fixed when the table is made.
Every file holds keys of one bucket, so a batch of candidates is brought to the
buckets and joined there: the history is neither shuffled nor sorted by an
exchange, however long it has grown, and a round costs one read of it and a
shuffle of the batch.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelake.operators.dedup import keep_latest
from quirelake.session import discard, folders, subfolders

BUCKETS = 64
_MARK = "_buckets="


def _buckets(spark: SparkSession, path: str, wanted: int) -> int:
    """The number of buckets of the set at a path. It is written beside the files when the set is made."""
    marks = [name for name in subfolders(spark, path) if name.startswith(_MARK)]
    if marks:
        return int(marks[0].removeprefix(_MARK))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{_MARK}{wanted}")
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)
    return wanted


def _version(spark: SparkSession, path: str) -> str:
    """The folder with the keys: the last one that was written as a whole."""
    complete = [name for name in folders(spark, path) if name.startswith("version=")]
    return complete[-1] if complete else f"version={0:06d}"


def _table(spark: SparkSession, folder: str, schema: T.StructType, key: str, buckets: int) -> str:
    """The name of the folder's table in this session's catalogue, which is told how the files are laid out."""
    name = "buckets_" + hashlib.md5(folder.encode()).hexdigest()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{folder}'"
    )
    spark.catalog.refreshTable(name)
    return name


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The rows of a table by key bucket; an absent one is empty. `buckets` counts for a new table only."""
    n = _buckets(spark, path, buckets)
    return spark.table(_table(spark, f"{path}/{_version(spark, path)}", schema, key, n))


def by_bucket(rows: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Rows dealt as the table's files are, so that a merge join with it needs no exchange on either side."""
    return rows.repartition(_buckets(rows.sparkSession, path, buckets), key)


def append_buckets(rows: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Add rows, one file per bucket."""
    spark = rows.sparkSession
    n = _buckets(spark, path, buckets)
    name = _table(spark, f"{path}/{_version(spark, path)}", rows.schema, key, n)
    rows.repartition(n, key).write.insertInto(name)


def read_visited(spark: SparkSession, path: str, key: T.StructField, buckets: int = BUCKETS) -> DataFrame:
    """The keys of the set; a path without a set has none. `buckets` counts for a new set only."""
    return read_buckets(spark, path, T.StructType([key]), key.name, buckets)


def append_visited(keys: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Remember keys as visited. A repeated append does no harm: it is a set."""
    append_buckets(keys.select(key), path, key, buckets)


def unvisited(candidates: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Candidates whose key is not in the set, one row per key; rows without a key are left out.

    Candidates are made distinct first, which collapses hot keys inside the map
    tasks, and then dealt to the buckets. The set's files are read in place.
    """
    fresh = by_bucket(keep_latest(candidates.filter(F.col(key).isNotNull()), key, key), path, key, buckets)
    seen = read_visited(candidates.sparkSession, path, candidates.schema[key], buckets)
    return fresh.join(seen.hint("merge"), key, "left_anti")


def compact_visited(spark: SparkSession, path: str, key: T.StructField) -> None:
    """Write each bucket as one file of distinct keys. Readers go on with the files before until it is complete; those
    are deleted by the next compaction."""
    current = _version(spark, path)
    n = _buckets(spark, path, BUCKETS)
    following = f"{path}/version={int(current.split('=')[1]) + 1:06d}"
    keys = read_visited(spark, path, key).dropDuplicates([key.name])
    keys.repartition(n, key.name).sortWithinPartitions(key.name).write.insertInto(_table(spark, following, T.StructType([key]), key.name, n))
    for old in folders(spark, path):
        if old.startswith("version=") and old < current:
            discard(spark, f"{path}/{old}")
