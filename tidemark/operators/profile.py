"""What tables hold: row counts, columns, and how old their newest row is."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.moments import Moment, moment


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, largest first. The counts read no column."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).orderBy(F.desc("row_count"), "table_name")


def table_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name and type of every column, in table order."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (name, position, field.name, field.dataType.simpleString())
        for name, df in tables.items()
        for position, field in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(
        rows, "table_name STRING, ordinal_position INT, column_name STRING, data_type STRING"
    ).orderBy("table_name", "ordinal_position")


def stale_tables(tables: Mapping[str, tuple[DataFrame, str]], cutoff: Moment) -> DataFrame:
    """Tables whose newest row is older than the cut-off, by name.

    Read from the data: the largest value of each table's own "modified" column.
    """
    parts = [
        df.agg(F.max(column).cast("timestamp_ntz").alias("last_update")).select(F.lit(name).alias("table_name"), "last_update")
        for name, (df, column) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).where(F.col("last_update") < moment(cutoff)).orderBy("table_name")


def copy_columns(source: DataFrame, columns: Iterable[str] | Mapping[str, str]) -> DataFrame:
    """The named columns of a source, renamed where a mapping says so, ready to be written."""
    if isinstance(columns, Mapping):
        return source.select(*(F.col(c).alias(new) for c, new in columns.items()))
    return source.select(*columns)
