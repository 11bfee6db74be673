"""Rows for load tests, and data sets of any size."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.moments import Moment, moment
from tidemark.operators.compare import assert_same_rows
from tidemark.spec import ForeignKey, TableSpec

# What a fixture row holds for each type of column, and what a changed one holds.
BASE_TEXT, CHANGED_TEXT = "A", "B"
BASE_NUMBER, CHANGED_NUMBER = 1, 2
BASE_BIT, CHANGED_BIT = True, False
BASE_GUID = "00000000-0000-0000-0000-000000000001"
CHANGED_GUID = "00000000-0000-0000-0000-000000000002"


def _value(field: T.StructField, now: Moment, changed: bool) -> Column:
    kind = field.dataType
    if isinstance(kind, T.StringType):
        if "guid" in (field.metadata or {}):
            return F.lit(CHANGED_GUID if changed else BASE_GUID)
        return F.lit(CHANGED_TEXT if changed else BASE_TEXT)
    if isinstance(kind, T.BooleanType):
        return F.lit(CHANGED_BIT if changed else BASE_BIT)
    if isinstance(kind, T.NumericType):
        return F.lit(CHANGED_NUMBER if changed else BASE_NUMBER).cast(kind)
    if isinstance(kind, T.BinaryType):
        return F.unhex(F.lit("01"))
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        at = moment(now, "timestamp_ntz") + F.make_dt_interval(days=F.lit(1 if changed else 0))
        return at.cast(kind)
    if isinstance(kind, T.TimeType):
        return F.make_time(F.lit(1 if changed else 0), F.lit(0), F.lit(0).cast("decimal(16,6)")).cast(kind)
    return F.lit(None).cast(kind)


def _base(field: T.StructField, now: Moment) -> Column:
    name = field.name.lower()
    if name in ("deleted", "serverexecutionid"):
        return F.lit(0).cast(field.dataType)
    return _value(field, now, changed=False)


def fixture_rows(spark: SparkSession, schema: T.StructType, n: int, now: Moment) -> DataFrame:
    """``n`` rows whose values follow from the column types."""
    return spark.range(n).select(*(_base(f, now).alias(f.name) for f in schema.fields))


def fixture_like(df: DataFrame, keep: Iterable[str], now: Moment) -> DataFrame:
    """One fixture row per row of ``df``, with the columns in ``keep`` left as they are."""
    kept = {c.lower() for c in keep}
    return df.select(*(F.col(f.name) if f.name.lower() in kept else _base(f, now).alias(f.name) for f in df.schema.fields))


def perturbed_column(schema: T.StructType, spec: TableSpec, versioned: bool = True) -> str:
    """The first column whose change makes a version, or the first whose change does not."""
    generated_or_key = {c.lower() for c in (*spec.keys, spec.row_hash, spec.start, spec.end)}
    outside = {c.lower() for c in spec.non_versioned}
    for field in schema.fields:
        name = field.name.lower()
        if name not in generated_or_key and (name in outside) != versioned:
            return field.name
    raise ValueError("the table has no such column")


def perturb(df: DataFrame, spec: TableSpec, now: Moment, versioned: bool = True) -> DataFrame:
    """Change one column of every row; ``Deleted`` and binary columns keep their value."""
    name = perturbed_column(df.schema, spec, versioned)
    field = df.schema[name]
    if name.lower() == "deleted":
        return df.withColumn(name, _base(field, now))
    return df.withColumn(name, _value(field, now, changed=True).cast(field.dataType))


def parent_rows(
    child: DataFrame,
    foreign_keys: Iterable[ForeignKey],
    schemas: Mapping[str, T.StructType],
    now: Moment,
    leave_out: str | None = None,
) -> dict[str, DataFrame]:
    """For each foreign key a parent table with one fixture row per value the child uses.

    ``leave_out`` names one parent that stays empty.
    """
    parents = {}
    for fk in foreign_keys:
        schema = schemas[fk.parent_name]
        values = child.select(F.col(fk.column).cast(schema[fk.parent_column].dataType).alias(fk.parent_column))
        values = values.where(F.col(fk.parent_column).isNotNull()).distinct()
        if fk.parent_name == leave_out:
            values = values.where(F.lit(False))
        parents[fk.parent_name] = values.select(
            *(F.col(f.name) if f.name == fk.parent_column else _base(f, now).alias(f.name) for f in schema.fields)
        )
    return parents


def check_view(
    view: Callable[[dict[str, DataFrame]], DataFrame],
    sources: Mapping[str, T.StructType | DataFrame],
    spark: SparkSession,
    now: Moment,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Fill every source of a view by type and expect every column of its output filled like that.

    A source given as a schema has one row; one given as rows has as many, and keeps its ``keys``, by
    which the view may join. Returns, per column of the view, how many rows are filled; fails with the
    rows that differ from what is expected.
    """
    filled = {
        name: fixture_rows(spark, source, 1, now)
        if isinstance(source, T.StructType)
        else fixture_like(source, [k for k in keys if k in source.columns], now)
        for name, source in sources.items()
    }
    actual = view(filled)
    if all(isinstance(source, T.StructType) for source in sources.values()):
        expected = fixture_rows(spark, actual.schema, 1, now)
    else:
        expected = fixture_like(actual, [k for k in keys if k in actual.columns], now)
    assert_same_rows(expected, actual)
    return actual.agg(*(F.count(c).alias(c) for c in actual.columns)).unpivot([], actual.columns, "column_name", "filled_rows")


def sample_users(spark: SparkSession, n: int = 50) -> DataFrame:
    return spark.range(1, n + 1).select(
        F.col("id").cast("int").alias("UserID"), F.concat(F.lit("User"), F.col("id").cast("string")).alias("Username")
    )


def sample_data(
    spark: SparkSession, n: int = 4_999_999, seed: int = 0, users: int = 50, now: Moment = dt.datetime(2015, 1, 1)
) -> DataFrame:
    """``n`` random rows, each belonging to a user, made in parallel where they are used.

    Values hang on the row's key and the seed alone, so they are the same on any cluster.
    """

    def uniform(which: int) -> Column:
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed).cast("bigint"), F.lit(which), "id"), 11) / F.lit(float(1 << 53))

    return spark.range(1, n + 1).select(
        F.col("id").alias("RowKey"),
        moment(now).alias("CreateDate"),
        (moment("2015-01-01") + F.make_dt_interval(days=F.floor(uniform(0) * 365).cast("int"))).alias("OtherDate"),
        F.concat(F.lit("TEST"), F.round(uniform(1) * 100).cast("int").cast("string")).alias("VarcharColumn"),
        F.round(uniform(2) * 100000).cast("int").alias("IntColumn"),
        F.round(uniform(3) * 10000, 2).alias("FloatColumn"),
        (F.round(uniform(4) * (users - 1)) + 1).cast("int").alias("UserID"),
    )
