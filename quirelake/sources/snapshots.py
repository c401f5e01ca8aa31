"""Several tables published as one version, and readers that stay with the version they began with.

A version is a folder of its own that is never written again; publishing it is one small file, its manifest, after all its
tables are complete. A reader takes the newest manifest and reads that version's folders, so it never sees tables of two
versions, nor a table that is being written. Old versions go when `keep` newer ones are published; a reader has that many
publications' time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quirelake.session import discard, folders, subfolders
from quirelake.sources.tables import read_parquet

KEEP = 2


@dataclass(frozen=True)
class Snapshot:
    """One published version; without one, all tables are empty."""

    spark: SparkSession
    root: str
    version: str | None
    tables: tuple[str, ...] = ()

    def path(self, table: str) -> str:
        return f"{self.root}/versions/{self.version}/{table}"

    def table(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        if name not in self.tables:
            return self.spark.createDataFrame([], schema or T.StructType([]))
        return read_parquet(self.spark, self.path(name), schema)


def snapshot(spark: SparkSession, root: str) -> Snapshot:
    """The version that is published now."""
    published = folders(spark, f"{root}/manifests")
    if not published:
        return Snapshot(spark, root, None)
    rows = spark.read.schema("name string").json(f"{root}/manifests/{published[-1]}").collect()
    return Snapshot(spark, root, published[-1], tuple(sorted(r["name"] for r in rows)))


class Publication:
    """A version in the making. Its tables can be read back before it is published, by whoever makes it."""

    def __init__(self, spark: SparkSession, root: str):
        last = subfolders(spark, f"{root}/versions")
        number = int(last[-1].split("-")[0]) + 1 if last else 0
        self.spark, self.root, self.version, self.tables = spark, root, f"{number:08d}-{uuid.uuid4().hex[:8]}", set()

    def write(self, frames: dict[str, DataFrame]) -> None:
        """Write tables side by side, so the tail of one does not leave the cluster idle."""
        with ThreadPoolExecutor(max_workers=len(frames)) as pool:
            jobs = [pool.submit(df.write.parquet, f"{self.root}/versions/{self.version}/{name}") for name, df in frames.items()]
            for job in jobs:
                job.result()
        self.tables |= set(frames)

    def so_far(self) -> Snapshot:
        return Snapshot(self.spark, self.root, self.version, tuple(sorted(self.tables)))

    def publish(self, keep: int = KEEP) -> Snapshot:
        rows = self.spark.createDataFrame([(name,) for name in sorted(self.tables)], "name string")
        rows.coalesce(1).write.json(f"{self.root}/manifests/{self.version}")
        published = folders(self.spark, f"{self.root}/manifests")
        for old in published[: -1 - keep]:
            # no manifest first: who lists versions now doesn't find it any more
            discard(self.spark, f"{self.root}/manifests/{old}")
            discard(self.spark, f"{self.root}/versions/{old}")
        return self.so_far()


def publish(spark: SparkSession, root: str, build: Callable[[Publication], None], keep: int = KEEP) -> Snapshot:
    """Make a version and publish it; if making it fails, nothing is published and its folder is deleted."""
    version = Publication(spark, root)
    try:
        build(version)
        return version.publish(keep)
    except BaseException:
        discard(spark, f"{root}/versions/{version.version}")
        raise
