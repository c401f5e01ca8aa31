"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.session import discard, scratch

LOCATOR = "__locator"
#: Bits of a membership filter for each key, and the most it can have: 2^29 bits, a broadcast of 64 MiB.
BITS_PER_KEY, MOST_BITS = 16, 1 << 29
#: Bits of a block of the filter: what a bitmap of Spark's bitmap functions holds.
BLOCK = 32768
HASHES = 2


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table below the cluster's shared folder and read it back: lineage ends, lost executors don't matter."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Workspace:
    """Scratch tables of one computation. A table is deleted when the next one of its name has been written, and all of
    them at the end, also when a step fails; what is to outlive it is written by `stored`.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *error) -> None:
        self.drop(*self.paths)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch(self.spark, name)
        df.write.parquet(path)
        before, self.paths[name] = self.paths.get(name), path
        if before:
            discard(self.spark, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            discard(self.spark, self.paths.pop(name))


def unique_name(taken: list[str], stem: str) -> str:
    """A column name that no column has, whatever its case."""
    names = {c.lower() for c in taken}
    return stem if stem.lower() not in names else f"{stem}_{uuid.uuid4().hex[:8]}"


def _add_locator(df: DataFrame) -> DataFrame:
    meta = df.metadataColumn("_metadata")
    return df.withColumn(LOCATOR, F.struct(F.xxhash64(meta["file_path"]).alias("file"), meta["row_index"].alias("row")))


def scanned(df: DataFrame) -> DataFrame:
    """The frame itself if it scans files, whose rows have a place; any other is written to the shared folder first."""
    try:
        _add_locator(df)
    except AnalysisException:
        return stored(df, "rows")
    return df


def located(df: DataFrame) -> DataFrame:
    """Add `__locator`: the hash of the row's file and its position there.

    It names a row whatever its columns hold (null or repeated ids too), and it is the same in every scan of the files.
    """
    return _add_locator(scanned(df))


def is_set(bits: Column, cell: Column) -> Column:
    """Whether a bitmap, as `bitmap_construct_agg` makes it, has the bit `cell`."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(cell / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, cell % 8) == 1


class KeyFilter:
    """A Bloom filter over the values of a column, in blocks that are broadcast as one bitmap each.

    It is sized by the number of keys up to MOST_BITS. Beyond, it lets more rows through and results stay the same.
    """

    def __init__(self, keys: DataFrame, key: str):
        self.key = key
        self.blocks = max(1, min(MOST_BITS, BITS_PER_KEY * keys.count()) // BLOCK)
        marked = keys.select(self._block().alias("__block"), F.explode(F.array(*self._cells())).alias("__cell"))
        bitmaps = marked.groupBy("__block").agg(F.call_function("bitmap_construct_agg", F.col("__cell")).alias("__bits"))
        self.bitmaps = F.broadcast(bitmaps)

    def _block(self) -> Column:
        return F.pmod(F.xxhash64(self.key, F.lit(0)), F.lit(self.blocks))

    def _cells(self) -> list[Column]:
        return [F.pmod(F.xxhash64(self.key, F.lit(i + 1)), F.lit(BLOCK)).cast("int") for i in range(HASHES)]

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows whose key may be one of the keys, rows whose key certainly is none)."""
        hit = F.forall(F.array(*self._cells()), lambda cell: is_set(F.col("__bits"), cell))
        met = df.withColumn("__block", self._block()).join(self.bitmaps, "__block", "left")
        maybe = F.coalesce(hit, F.lit(False))
        return tuple(met.filter(c).drop("__block", "__bits") for c in (maybe, ~maybe))


def only_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among `keys`. Rows that the filter rules out are not shuffled."""
    maybe, _ = KeyFilter(keys, key).split(df)
    return maybe.join(keys.select(key).distinct(), key, "left_semi")


def without_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among `keys`; only those that the filter can't clear are shuffled."""
    unclear, clear = KeyFilter(keys, key).split(df)
    return clear.unionByName(unclear.join(keys.select(key).distinct(), key, "left_anti"))


def with_values(df: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """Rows with the columns of `values`, which holds a key once, or null; rows without values are hardly ever shuffled."""
    maybe, clear = KeyFilter(values, key).split(df)
    return maybe.join(values, key, "left").unionByName(clear, allowMissingColumns=True)


def drop_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows whose locators aren't in `dropped`, with the columns they came with, whatever their names."""
    rows = located(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc")))
    left = without_keys(rows, dropped, LOCATOR)
    return left.select(*[F.col("__doc")[c].alias(c) for c in docs.columns])


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of a few rows, so that what a task makes of one at a time is small.

    Spark bounds a batch by its bytes, but what is made of the texts in it can be many times as large.
    """
    for batch in batches:
        for start in range(0, max(batch.num_rows, 1), rows):
            yield batch.slice(start, rows)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Rows may be long texts: hand Python few of them at a time.

    The setting is only ever lowered, and stays so: a lazy result reads it when it runs, which may be much later.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) not in range(1, rows + 1):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
