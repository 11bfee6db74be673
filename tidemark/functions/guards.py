"""Checks that stop a running plan instead of needing a job of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, condition: Column, message: str | Column) -> DataFrame:
    """``df`` unchanged, failing when a row with an untrue ``condition`` is met."""
    text = F.lit(message) if isinstance(message, str) else message
    return df.where(F.when(condition, F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))


def true(condition: Column) -> Column:
    """``condition`` with NULL counted as false."""
    return F.coalesce(condition, F.lit(False))
