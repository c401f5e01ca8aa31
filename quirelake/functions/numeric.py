"""Parsing and rounding of numbers.

Three roundings coexist, because the layers that feed a dashboard round in
different places: data frames round half to even after scaling, SQL rounds
half up on decimals, and the loader rounds the exact binary value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing cell when a table is loaded.
MISSING_TEXTS = ["nan", "NaT", "None", ""]

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def clean_price(c: Column) -> Column:
    """Keep digits and dots only, then parse; anything unparsable is null."""
    return F.regexp_replace(c, "[^0-9.]", "").try_cast("double")


def parse_number(c: Column) -> Column:
    """Text to double, plain decimal notation only.

    A bare cast would also take Java's own forms such as '3d' or '0x1p3'.
    """
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def parse_long(c: Column) -> Column:
    return parse_number(c).try_cast("bigint")


def round_half_even(c: Column, digits: int = 2) -> Column:
    scale = F.lit(float(10**digits))
    return F.rint(c * scale) / scale


def round_half_up(c: Column, digits: int = 2) -> Column:
    return F.round(c.try_cast("decimal(38,10)"), digits).cast("double")


def round_exact(c: Column, digits: int = 2) -> Column:
    """Round the exact binary value of a double, ties to even.

    `x * 10^d` is not exact, so its rounding error is recovered with the usual
    splitting of a product into a rounded part and a remainder, and decides the
    cases that look like ties. From 2^45 on a double's fraction has at most seven
    bits, so its digits are exact by themselves; from 2^53 on it has none.
    """
    scale = F.lit(float(10**digits))
    size = F.abs(c)
    product = size * scale
    wide = size * F.lit(134217729.0)  # 2^27 + 1
    high = wide - (wide - size)
    remainder = (high * scale - product) + (size - high) * scale
    below = F.floor(product).cast("double")
    excess = product - below - F.lit(0.5)
    up = (excess > 0) | ((excess == 0) & (remainder > 0))
    tie = (excess == 0) & (remainder == 0)
    rounded = F.when(tie, F.rint(product)).when(up, below + 1).otherwise(below) / scale
    whole = F.floor(size).cast("double")
    large = whole + F.rint((size - whole) * scale) / scale
    return (
        F.when(size < F.lit(float(2**45)), rounded * F.signum(c))
        .when(size < F.lit(float(2**53)), large * F.signum(c))
        .otherwise(c)
    )


def safe_text(c: Column, default: str | None = None) -> Column:
    text = c.cast("string")
    return F.when(text.isNull() | text.isin(MISSING_TEXTS), F.lit(default)).otherwise(text)


def safe_float(c: Column, from_text: bool = False) -> Column:
    """Number or null, rounded to 2 decimals."""
    value = parse_number(c) if from_text else c.cast("double")
    return round_exact(F.nanvl(value, F.lit(None).cast("double")))


# What a whole number too large for 64 bits becomes: no table column takes it either, so the load rejects it.
TOO_LARGE = 2**63 - 1


def safe_int(c: Column, from_text: bool = False) -> Column:
    """Truncate toward zero; what is no number becomes 0, and what is too large `TOO_LARGE`."""
    value = parse_number(c) if from_text else c.try_cast("double")
    is_number = F.abs(value) < F.lit(float("inf"))  # false for nan as well
    whole = F.coalesce(value.try_cast("bigint"), F.lit(TOO_LARGE))
    return F.when(is_number, whole).otherwise(F.lit(0).cast("bigint"))
