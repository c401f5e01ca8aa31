"""Streams of records into Bronze and Silver, visited keys, daily volumes.

Every job takes a checkpoint folder and stops when the available input is done
unless another trigger is given. A batch that is repeated after a failure
writes the same folder again, so rows are neither lost nor doubled.

A checkpoint counts its batches from 0, so their numbers say nothing about a
table that outlives the checkpoint. Folders are therefore named by the id of
the stream (a new checkpoint has a new one) and its batch, and where order
matters by a number in front of them that the table gives out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quirelake.operators.cleaning import Cleaner, to_silver
from quirelake.operators.dedup import keep_latest
from quirelake.operators.quarantine import split_untitled
from quirelake.session import discard, folders, subfolders
from quirelake.sources.bronze import LANDING_KEYS, landing_columns, parse_lines, split_corrupt
from quirelake.sources.tables import event_payload

AVAILABLE = {"availableNow": True}
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream(spark: SparkSession, fmt: str, options: dict[str, str], schema=None, path: str | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def message_text(messages: DataFrame, value="value") -> DataFrame:
    """The value of topic messages as text; it arrives as bytes."""
    return messages.select(F.col(value).cast("string").alias("value"))


def stream_session(spark: SparkSession) -> SparkSession:
    """A session for streams that keeps their state on disk; the caller's settings stay as they are."""
    own = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(name, spark.conf.get(name))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return own


def _adaptive(batch: DataFrame) -> DataFrame:
    """Streams switch adaptive execution off; the write of a batch may use it,
    so that a rebalance splits huge folders and merges small ones."""
    batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
    return batch


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a running stream has for as long as its checkpoint is there."""
    row = spark.read.schema("id string").json(f"{checkpoint}/metadata").first()
    return row["id"].replace("-", "")


def batch_name(stream: str, batch_id: int) -> str:
    return f"{stream}-{batch_id:012d}"


def numbered_folder(spark: SparkSession, root: str, stream: str, batch_id: int, after: int = -1) -> str:
    """The folder of a stream's batch below `root`: the next number of the table, greater than `after`, and the batch's
    name. A repeated batch finds the folder it has begun, complete or not."""
    own, last = batch_name(stream, batch_id), after
    for name in subfolders(spark, root):
        number, rest = name.split("-", 1)
        if rest == own:
            return name
        last = max(last, int(number))
    return f"{last + 1:012d}-{own}"


def to_bronze(records: DataFrame, root: str, checkpoint: str, at: Column, trigger=AVAILABLE) -> StreamingQuery:
    """Land a stream of records as JSON lines below source / hour / category / batch."""
    keys = [*LANDING_KEYS, "batch_id"]

    def write(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(stream_id(batch.sparkSession, checkpoint), batch_id)
        keyed = _adaptive(batch).withColumn("batch_id", F.lit(name))
        (
            keyed.hint("rebalance", *LANDING_KEYS)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys)
            .option("ignoreNullFields", False).json(root)
        )

    stream = landing_columns(records, at)
    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def publish(
    records: DataFrame, topic: str, options: dict[str, str], checkpoint: str, fmt: str = "kafka", trigger=AVAILABLE
) -> StreamingQuery:
    """Send a stream of records to a topic as JSON messages."""
    return (
        event_payload(records).writeStream.format(fmt).options(**options).option("topic", topic)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def _thin(stream: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key of every Arrow batch, before anything is shuffled."""
    at = [stream.columns.index(c) for c in key]

    def first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.table([batch.column(i) for i in at], names=[str(i) for i in at]).to_pandas()
            yield batch.filter(pa.array((~keys.duplicated()).to_numpy()))

    return stream.mapInArrow(first_rows, stream.schema)


def unseen(stream: DataFrame, key: Sequence[str]) -> DataFrame:
    """First row per key over the whole life of the stream; the state has one entry per key, for ever.

    A streaming de-duplication sends all rows of a key to one task. The rows are
    thinned out where they are read, so that a hot key arrives as one row per
    Arrow batch.
    """
    return _thin(stream, key).dropDuplicates(list(key))


def unseen_recently(stream: DataFrame, key: Sequence[str], time: str, delay: str) -> DataFrame:
    """Bounded state: a key that comes back after `delay` passes again."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))


def to_silver_batches(
    lines: DataFrame, silver: str, quarantine: str, checkpoint: str, clean: Cleaner, run_ts: str, trigger=AVAILABLE
) -> StreamingQuery:
    """Clean a stream of JSON lines; one folder per batch for Silver, for rows without a title in quarantine, and for
    lines that are no records in `<quarantine>-corrupt`. Fields outside the schema stay in `_extras`.

    Folders carry the stream's id: a stream with a new checkpoint adds its batches to those that are there.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"batch_id={batch_name(stream_id(batch.sparkSession, checkpoint), batch_id)}"
        rows = parse_lines(batch).drop("_names").persist()
        try:
            good, corrupt = split_corrupt(rows)
            valid, untitled = split_untitled(good)
            to_silver(valid, clean, run_ts).write.mode("overwrite").parquet(f"{silver}/{folder}")
            for df, root in ((untitled, quarantine), (corrupt.toDF("ligne"), f"{quarantine}-corrupt")):
                df.write.mode("overwrite").option("ignoreNullFields", False).json(f"{root}/{folder}")
        finally:
            rows.unpersist()

    return (
        lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def write_delta(
    batch: DataFrame, path: str, stream: str, batch_id: int, key: Sequence[str], order: str, ties: Sequence[Column],
    numbered: str | None = None,
) -> None:
    """Add a batch's newest rows per key to the table at `path`; a repeated batch writes the same folder again.

    Only the batch's own rows are written, whatever keys they have. `numbered` names a column for the number that the
    table gives to the batch: it grows from batch to batch, whatever streams write them.
    """
    spark = batch.sparkSession
    name = numbered_folder(spark, f"{path}/deltas", stream, batch_id, _published(spark, path)[1])
    if numbered:
        batch = batch.withColumn(numbered, F.lit(int(name.split("-", 1)[0])).cast("bigint"))
    keep_latest(batch, key, order, ties).write.mode("overwrite").parquet(f"{path}/deltas/{name}")


def _published(spark: SparkSession, path: str) -> tuple[str | None, int, list[str]]:
    """The base that is valid now, the last number given out when it was made, and the batches it contains."""
    versions = folders(spark, f"{path}/published")
    if not versions:
        return None, -1, []
    row = spark.read.schema("base string, number bigint, merged array<string>").json(f"{path}/published/{versions[-1]}").first()
    return row["base"], row["number"], row["merged"]


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str], order: str, ties: Sequence[Column] = ()
) -> DataFrame:
    """The newest row per key over the published base and the batches that it lacks; only complete folders count."""
    base, _, merged = _published(spark, path)
    parts = [f"{path}/deltas/{name}" for name in folders(spark, f"{path}/deltas") if name not in merged]
    parts += [f"{path}/bases/{base}"] if base else []
    rows = spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
    return keep_latest(rows, key, order, ties)


def compact_latest(
    spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str], order: str, ties: Sequence[Column] = ()
) -> None:
    """Merge base and batches into a new base, as a job of its own beside the streams.

    Readers go on with the old base until the new one is complete and published,
    which is one small file that lists the batches the base contains. What the
    version before the last needed is deleted then; a reader has a whole
    compaction's time to finish.
    """
    batches = folders(spark, f"{path}/deltas")
    base, number, merged = _published(spark, path)
    if set(batches) <= set(merged):
        return
    last = max(number, *(int(name.split("-", 1)[0]) for name in batches))
    name = f"{int(base) + 1 if base else 0:012d}"
    read_latest(spark, path, schema, key, order, ties).write.mode("overwrite").parquet(f"{path}/bases/{name}")
    row = spark.createDataFrame([(name, last, batches)], "base string, number bigint, merged array<string>")
    row.coalesce(1).write.mode("overwrite").json(f"{path}/published/{name}")
    for old in merged:
        discard(spark, f"{path}/deltas/{old}")
    for old in folders(spark, f"{path}/bases"):
        if base and old < base:
            discard(spark, f"{path}/bases/{old}")


def upsert_latest(
    stream: DataFrame, path: str, checkpoint: str, key: Sequence[str], order: str,
    ties: Sequence[Column] = (), trigger=AVAILABLE,
) -> StreamingQuery:
    """Keep a table of the newest row per key up to date from a stream; see `read_latest` and `compact_latest`.

    The table outlives the checkpoint: a stream with a new one adds its batches to the same table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_delta(_adaptive(batch), path, stream_id(batch.sparkSession, checkpoint), batch_id, key, order, ties)

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def daily_volumes(stream: DataFrame, time: str, source: str, delay: str = "1 day") -> DataFrame:
    """Rows per day and source. The partial counts are formed before the shuffle."""
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, "1 day").alias("_day"), F.col(source).alias("source"))
        .agg(F.count(F.lit(1)).alias("nb_livres"))
        .select(F.col("_day.start").cast("date").alias("date_val"), "source", "nb_livres")
    )


VOLUMES = T.StructType([
    T.StructField("date_val", T.DateType()), T.StructField("source", T.StringType()),
    T.StructField("nb_livres", T.LongType()), T.StructField("number", T.LongType()),
])
_VOLUME_KEY = ["date_val", "source"]


def write_daily_volumes(
    stream: DataFrame, path: str, checkpoint: str, time: str, source: str, delay: str = "1 day", trigger=AVAILABLE
) -> StreamingQuery:
    """Write the counts a batch has changed. Days older than the delay leave the state; their counts are final.

    A stream with a new checkpoint reads its source again and counts from the start: what it writes replaces the counts
    of the same days, and days that it does not meet keep theirs.
    """

    def write(counts: DataFrame, batch_id: int) -> None:
        name = stream_id(counts.sparkSession, checkpoint)
        write_delta(_adaptive(counts), path, name, batch_id, _VOLUME_KEY, "number", [], numbered="number")

    return (
        daily_volumes(stream, time, source, delay)
        .writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def read_daily_volumes(spark: SparkSession, path: str) -> DataFrame:
    return read_latest(spark, path, VOLUMES, _VOLUME_KEY, "number").drop("number")
