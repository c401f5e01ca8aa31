"""Silver merged by key: a row that changes its partition leaves the old one.

`write_silver` replaces whole partitions. A merge knows where each key lies: an index of (key, partition, number of the
merge), stored by key bucket, so a batch finds its keys' old places without a shuffle of the index. Only partitions that
the batch's rows come from or go to are read, written to a stage and swapped; a partition that has lost its last row is
deleted. Of two rows of one key the one with the greater order stays; in equal ones, the batch's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelake.operators.dedup import latest_versions
from quirelake.schemas import PARTITION_KEY, SILVER
from quirelake.session import discard, scratch, subfolders
from quirelake.sources import visited
from quirelake.sources.tables import read_parquet, write_silver


def _index(kind: T.DataType, key: str) -> T.StructType:
    return T.StructType([
        T.StructField(key, kind), T.StructField(PARTITION_KEY, T.StringType()), T.StructField("number", T.LongType()),
    ])


def places(batch: DataFrame, index: str, key: str) -> DataFrame:
    """The partitions in which the batch's keys lie or have lain: key and partition. The index isn't shuffled."""
    spark, schema = batch.sparkSession, _index(batch.schema[key].dataType, key)
    keys = batch.filter(F.col(key).isNotNull()).select(key).distinct()
    entries = visited.read_buckets(spark, index, schema, key)
    found = visited.by_bucket(keys, index, key).join(entries.hint("merge"), key)
    # The last two: the one before counts if the last merge died before it swapped the partitions.
    last = F.slice(F.sort_array(F.collect_set(F.struct("number", PARTITION_KEY)), asc=False), 1, 2)
    return found.groupBy(key).agg(last.alias("_at")).select(key, F.explode("_at").alias("_at")).select(key, f"_at.{PARTITION_KEY}")


def merge_silver(batch: DataFrame, path: str, index: str, key: str = "url", order: str = "date_scraping") -> list[str]:
    """Merge Silver rows (with their partition key) into the table; the names of the partitions that were touched."""
    spark: SparkSession = batch.sparkSession
    stage, fresh = scratch(spark, "silver-merge"), scratch(spark, "silver-batch")
    try:
        latest_versions(batch, key, order).drop("n_versions").write.parquet(fresh)
        rows = spark.read.schema(batch.schema).parquet(fresh)
        old = places(rows, index, key)
        # Names of folders, as in any listing of the table.
        touched = sorted({r[0] for r in rows.select(PARTITION_KEY).union(old.select(PARTITION_KEY)).distinct().collect()})
        lying = read_parquet(spark, path, SILVER).filter(F.col(PARTITION_KEY).isin(touched))
        both = lying.withColumn("_turn", F.lit(0)).unionByName(rows.withColumn("_turn", F.lit(1)), allowMissingColumns=True)
        keyed = both.filter(F.col(key).isNotNull())
        merged = latest_versions(keyed, key, order, [F.col("_turn")]).drop("_turn", "n_versions")
        merged = merged.unionByName(both.filter(F.col(key).isNull()).drop("_turn"))
        merged.hint("rebalance", PARTITION_KEY).write.partitionBy(PARTITION_KEY).parquet(stage)
        staged = spark.read.schema(merged.schema).parquet(stage)
        entries = visited.read_buckets(spark, index, _index(batch.schema[key].dataType, key), key)
        # The index first, beside the entries before: if the run dies after this, the batch's keys have two places, and
        # when the batch is merged again, both are looked at.
        number = (entries.agg(F.max("number")).first()[0] or 0) + 1
        now = staged.join(rows.select(key), key, "left_semi").select(key, PARTITION_KEY, F.lit(number).cast("bigint").alias("number"))
        visited.append_buckets(now, index, key)
        write_silver(staged, path)
        left = {name.split("=", 1)[1] for name in subfolders(spark, stage) if "=" in name}
        for name in set(touched) - left:
            discard(spark, f"{path}/{PARTITION_KEY}={name}")
        return touched
    finally:
        discard(spark, stage)
        discard(spark, fresh)
