"""Profiles of columns that can be added up: stored once per day, united over any days without reading rows.

A profile of a day and column is a row (rows, nulls, least and greatest number, a HyperLogLog sketch of its values) and a
histogram of its numbers in bins that grow by a constant factor. Counts, extremes and histograms add up to the same as one
pass over all rows. Sketches unite to the same registers, whose estimate varies within its error (about 1.6 % as a standard
deviation with 2^12 registers) with the way they were united; a quantile is within `ERROR` of the number at its rank, relatively, whatever the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The relative error of quantiles, and the registers of the distinct counts as a power of two.
ERROR = 0.01
REGISTERS = 12
_GROWTH = (1 + ERROR) / (1 - ERROR)
#: Between the bins of negative numbers, zero, and those of positive ones; numbers have exponents within it.
_SIDE = 100_000


def _bin(number: Column) -> Column:
    """The number's bin; bins are in the order of their numbers."""
    place = F.ceil(F.log(F.abs(number)) / math.log(_GROWTH)) + _SIDE
    return F.when(number == 0, F.lit(0)).otherwise(F.signum(number) * place).cast("bigint")


def _middle(at: Column) -> Column:
    """The number that is relatively closest to all of a bin."""
    edge = F.pow(F.lit(_GROWTH), (F.abs(at) - _SIDE).cast("double"))
    return F.when(at == 0, 0.0).otherwise(F.signum(at.cast("double")) * edge * (2 / (1 + _GROWTH)))


def _cells(df: DataFrame, day: str, columns: list[str]) -> DataFrame:
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text"), F.col(c).cast("double").alias("number")) for c in columns
    ])
    return df.select(F.col(day).cast("date").alias("day"), F.explode(cells).alias("c")).select("day", "c.*")


def day_profiles(df: DataFrame, day: str, columns: list[str]) -> DataFrame:
    """day, column, n, nulls, lo, hi, distinct (a sketch): one row per day and numeric column."""
    return _cells(df, day, columns).groupBy("day", "column").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("text").isNull()).alias("nulls"), F.min("number").alias("lo"),
        F.max("number").alias("hi"), F.hll_sketch_agg("text", F.lit(REGISTERS)).alias("distinct"),
    )


def day_histograms(df: DataFrame, day: str, columns: list[str]) -> DataFrame:
    """day, column, bin, n of the finite numbers."""
    finite = F.col("number").isNotNull() & ~F.isnan("number") & (F.abs("number") < float("inf"))
    return _cells(df, day, columns).filter(finite).groupBy("day", "column", _bin(F.col("number")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def united(profiles: DataFrame) -> DataFrame:
    """column, n, nulls, lo, hi, distinct (an estimate) over all rows of stored profiles."""
    return profiles.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct"),
    )


def quantiles(histograms: DataFrame, shares: list[float]) -> DataFrame:
    """column, share, value: for each share, the value of the first number that so many don't exceed.

    Bins are added up first; what is ordered then is one row per bin, some thousands for any number of rows.
    """
    bins = histograms.groupBy("column", "bin").agg(F.sum("n").alias("n"))
    upwards = Window.partitionBy("column").orderBy("bin")
    ranked = bins.withColumn("upto", F.sum("n").over(upwards)).withColumn("all", F.sum("n").over(Window.partitionBy("column")))
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    reached = ranked.select("*", wanted).filter(F.col("upto") >= F.greatest(F.ceil(F.col("share") * F.col("all")), F.lit(1)))
    return reached.groupBy("column", "share").agg(_middle(F.min("bin")).alias("value"))
