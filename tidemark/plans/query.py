"""A registered query: what Spark runs, and the SQL another engine can state the same result in."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def time_text(column: str | Column) -> Column:
    """A timestamp as text with six decimals, whatever the session's time zone."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.rpad(F.when(F.length(text) == 19, F.concat(text, F.lit("."))).otherwise(text), 26, "0")


def times_as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: time_text(c) for c in columns})


def sql_time(column: str, alias: str | None = None) -> str:
    text = f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"
    return f"{text} AS {alias}" if alias else text
