"""Newest version per key, duplicate counts, keys not seen before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _hashable(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    simple = not isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
    return c if simple else F.to_json(c)


def content_hash(df: DataFrame) -> Column:
    """A tie-break that depends on the row's content only, never on its position."""
    return F.xxhash64(*[_hashable(f) for f in df.schema.fields])


def latest_versions(
    df: DataFrame,
    key: str | Sequence[str],
    order: str,
    ties: Sequence[Column] | None = None,
    **extra: Column,
) -> DataFrame:
    """One row per key, the one with the greatest `order`, and `n_versions`.

    A null `order` loses to any value, and null keys form one group. `ties`
    (greatest wins) decide equal orders. `extra` adds further aggregates per key.

    It is one aggregation, so every map task sends at most one row per key: a
    key that holds a third of the table is reduced before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(F.col(order), *(ties if ties is not None else [content_hash(df)]))
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), rank).alias("_newest")
    counted = df.groupBy(*keys).agg(
        newest, F.count(F.lit(1)).alias("n_versions"), *[c.alias(n) for n, c in extra.items()]
    )
    columns = [F.col(f"`{c}`") if c in keys else F.col("_newest")[c].alias(c) for c in df.columns]
    return counted.select(*columns, "n_versions", *extra)


def keep_latest(
    df: DataFrame, key: str | Sequence[str], order: str, ties: Sequence[Column] | None = None
) -> DataFrame:
    return latest_versions(df, key, order, ties).drop("n_versions")


def duplicate_report(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows before and after `keep_latest`, and how many it removes."""
    keys = [key] if isinstance(key, str) else list(key)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_read"),
        F.count(F.lit(1)).alias("rows_kept"),
    ).withColumn("duplicates", F.col("rows_read") - F.col("rows_kept"))


def new_keys(candidates: DataFrame, visited: DataFrame, key: str) -> DataFrame:
    """Candidates whose key is not in `visited`, one row per key; rows without a key are left out.

    The candidates are made distinct first, which collapses hot keys inside the
    map tasks. `visited` holds each key once, or a few times; no matter.
    """
    fresh = keep_latest(candidates.filter(F.col(key).isNotNull()), key, key)
    return fresh.join(visited.select(key), key, "left_anti")
