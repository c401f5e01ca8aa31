"""Exact dedup over a stateful stream: disk-backed keyed state without expiry, full bytes compared on hits.

The documents' keys (id, locator, digest; no text) land as Parquet and run through a streaming aggregation whose state
lies in the RocksDB store, one entry per digest that never expires: the digest, the largest id so far with the locator
of its content, and the row count. The stream can be restarted from its checkpoint, and more files can land later.
Rows that hit an entry are then compared byte by byte with the content at the entry's locator. Rows whose digest is
equal and whose bytes are not go through another round under the same digest, so a weak digest costs time, not results.

Null text counts as empty. Of equal texts the row with the largest id stays; a null id is smaller than any; of repeated
rows with that same id, the one with the largest locator. Every row has its own result, repeated rows too. An empty
table gives an empty result. Only the id and text columns are read, under names of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.llm.common import LOCATOR, drop_rows, located, only_keys, scanned, stored, without_keys
from quirelake.session import scratch

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LANDING = "__locator struct<file:bigint,row:bigint>, id bigint, sha string, key string"


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own, so that the state store's settings don't reach the caller's other streams."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "200")
    # Many small stores: no space is reserved ahead for their logs.
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    return own


def keyed_state(spark: SparkSession, landing: str, checkpoint: str, max_files: int | None = None) -> DataFrame:
    """Run what has landed through the state and return the state: key, keep_id, keep_locator, n."""
    own = _stream_session(spark)
    reader = own.readStream.schema(LANDING)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    entries = reader.parquet(landing).groupBy("key").agg(
        F.max(F.struct("id", LOCATOR)).alias("top"), F.count(F.lit(1)).alias("n")
    )
    writer = entries.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    state = own.read.format("statestore").load(checkpoint)
    top, count = [state.schema["value"].dataType.fieldNames()[i] for i in (0, 1)]
    return state.select(
        F.col("key.key").alias("key"),
        F.col("value")[top]["id"].alias("keep_id"),
        F.col("value")[top][LOCATOR].alias("keep_locator"),
        F.col("value")[count].alias("n"),
    )


def _differing(texts: DataFrame, hits: DataFrame) -> DataFrame:
    """Locators of hits whose bytes differ from the content at their entry's locator."""
    wanted = hits.select(LOCATOR).union(hits.select(F.col("keep_locator").alias(LOCATOR)).distinct())
    bodies = only_keys(texts, wanted, LOCATOR)
    mine = bodies.join(hits, LOCATOR)
    kept = bodies.join(hits.select(F.col("keep_locator").alias(LOCATOR)).distinct(), LOCATOR, "left_semi").select(
        F.col(LOCATOR).alias("keep_locator"), F.col("body").alias("kept_body")
    )
    # One row per entry on the right, however many hits there are; a hot entry's hits are split by the adaptive join.
    both = mine.join(kept, "keep_locator", "left")
    return both.filter(~F.col("body").eqNullSafe(F.col("kept_body"))).select(LOCATOR)


def exact_dedup(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", digest=sha256, max_files: int | None = None
) -> DataFrame:
    """__locator, doc_id, keep_id, keep_locator, group_size, kept, text_sha256 per row of `docs`."""
    spark, docs = docs.sparkSession, scanned(docs)
    texts = located(docs).select(
        LOCATOR, F.col(doc_id).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body")
    )
    narrow = texts.select(LOCATOR, "id", sha256(F.col("body")).alias("sha"), digest(F.col("body")).alias("key"))
    texts = texts.select(LOCATOR, "body")
    landing = scratch(spark, "landing")
    narrow.write.parquet(landing)
    settled = None
    while True:
        waiting = spark.read.schema(LANDING).parquet(landing)
        entries = keyed_state(spark, landing, scratch(spark, "dedup-state"), max_files)
        entries = spark.read.parquet(_written(entries, spark))
        matched = stored(waiting.join(entries, "key", "left"), "matched")
        hits = matched.filter((F.col("n") > 1) & (F.col(LOCATOR) != F.col("keep_locator"))).select(LOCATOR, "keep_locator")
        differing = stored(_differing(texts, hits), "differing")
        if differing.isEmpty():
            return _results(matched if settled is None else settled.unionByName(matched))
        # Equal digests over different bytes: settle what agrees, give the rest another round.
        same = without_keys(matched, differing, LOCATOR)
        sizes = same.groupBy("keep_locator").agg(F.count(F.lit(1)).alias("n"))
        same = same.drop("n").join(sizes, "keep_locator").select(matched.columns)
        settled = stored(same if settled is None else settled.unionByName(same), "settled")
        again = only_keys(waiting, differing, LOCATOR)
        landing = scratch(spark, "landing")
        again.select(LOCATOR, "id", "sha", "key").write.parquet(landing)


def _written(df: DataFrame, spark: SparkSession) -> str:
    path = scratch(spark, "entries")
    df.write.parquet(path)
    return path


def _results(matched: DataFrame) -> DataFrame:
    return matched.select(
        LOCATOR, F.col("id").alias("doc_id"), "keep_id", "keep_locator", F.col("n").alias("group_size"),
        (F.col(LOCATOR) == F.col("keep_locator")).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that stay, with the columns they came with."""
    docs = scanned(docs)
    dropped = exact_dedup(docs, text, doc_id).filter(~F.col("kept")).select(LOCATOR)
    return drop_rows(docs, stored(dropped, "dropped"))
