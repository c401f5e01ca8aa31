"""Rows that may go on, and rows set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.functions.text import is_blank


def split(df: DataFrame, bad: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, set aside). Both are filters over `df`: hand in a written table
    or a cheap plan, since each side reads it once."""
    bad = F.coalesce(bad, F.lit(True))
    return df.filter(~bad), df.filter(bad)


def split_untitled(df: DataFrame, title: str = "titre") -> tuple[DataFrame, DataFrame]:
    """Runs after de-duplication: a newest version without a title sets its key aside."""
    return split(df, is_blank(F.col(title)))
