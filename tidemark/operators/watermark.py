"""High-water marks: which column tells how far a table is loaded, its value, and what is newer."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.moments import Moment, moment

# Column names that tell when a row changed, names that only tell when it was
# made, the column of a full load, and the schemas left out.
MODIFIED_NAMES = (
    "LastModified",
    "LastModifiedDateTime",
    "LastModDate",
    "DateLastModified",
    "LastChange",
)
CREATED_NAMES = (
    "Created",
    "ActionDateTime",
    "LastViewDateTime",
    "LastViewed",
    "SECreatedDateTime",
    "CreatedDateTime",
    "LogDate",
    "DateCreated",
    "AssignmentModifiedDate",
)
FULL_LOAD_COLUMN = "DWLoadDate"
EXCEPTION_SCHEMAS = "zException%"

Name = tuple[str, str]


def columns_frame(spark: SparkSession, tables: Mapping[Name, DataFrame]) -> DataFrame:
    """The columns of tables named ``(schema, table)``, as ``schemaname, tablename, columnname``."""
    rows = [(schema, table, column) for (schema, table), df in tables.items() for column in df.columns]
    return spark.createDataFrame(rows, "schemaname STRING, tablename STRING, columnname STRING")


def _named(columns: DataFrame, names: Iterable[str]) -> DataFrame:
    return columns.where(F.lower("columnname").isin([n.lower() for n in names]))


def watermark_columns(
    columns: DataFrame,
    modified: Iterable[str] = MODIFIED_NAMES,
    created: Iterable[str] = CREATED_NAMES,
    default: str | None = None,
) -> DataFrame:
    """Per table its "modified" columns, else its "created" ones; a table may have several.

    Whether a table has a "modified" column is judged by table name alone, without its schema.
    With ``default``, tables without any are listed with that column: they are loaded in full.
    """
    kept = columns.where(~F.col("schemaname").like(EXCEPTION_SCHEMAS))
    changed = _named(kept, modified)
    made = _named(kept, created).join(changed.select("tablename").distinct(), "tablename", "left_anti")
    chosen = changed.unionByName(made).distinct()
    if default is not None:
        rest = kept.select("schemaname", "tablename").distinct().join(chosen, ["schemaname", "tablename"], "left_anti")
        chosen = chosen.unionByName(rest.withColumn("columnname", F.lit(default)))
    return chosen.orderBy("schemaname", "tablename", "columnname")


def max_watermarks(tables: Mapping[Name, DataFrame], choices: Iterable[tuple[str, str, str]]) -> DataFrame:
    """The highest value of each chosen column, all tables in one job.

    Each branch reads one column and aggregates map-side. A table that is empty or only holds
    NULLs gives no row, so it changes nothing.
    """
    parts = [
        tables[schema, table].agg(F.max(F.col(column)).cast("timestamp_ntz").alias("watermark")).select(
            F.lit(schema).alias("schemaname"),
            F.lit(table).alias("tablename"),
            F.lit(column).alias("columnname"),
            "watermark",
        )
        for schema, table, column in choices
    ]
    return reduce(DataFrame.unionByName, parts).where(F.col("watermark").isNotNull())


def update_watermarks(
    watermarks: DataFrame,
    tasks: DataFrame,
    instances: DataFrame,
    databases: DataFrame,
    task_name: str,
    instance: str,
    database: str,
    value: Moment | None,
) -> DataFrame:
    """The control table with ``value`` set for one task on one instance's database.

    ``value=None`` changes nothing. The control tables are small; no join here is hinted.
    """
    if value is None:
        return watermarks
    task_ids = tasks.where(F.col("TaskName") == task_name).select("TaskID")
    database_ids = (
        instances.where((F.col("InstanceName") == instance) & (F.col("DatabaseName") == database))
        .join(databases.select("DatabaseName"), "DatabaseName", "left_semi")
        .select("DatabaseID")
    )
    hits = (
        watermarks.select("TaskID", "DatabaseID")
        .join(task_ids, "TaskID", "left_semi")
        .join(database_ids, "DatabaseID", "left_semi")
        .distinct()
        .withColumn("_new", moment(value, watermarks.schema["LoadWatermark"].dataType))
    )
    return (
        watermarks.join(hits, ["TaskID", "DatabaseID"], "left")
        .withColumn("LoadWatermark", F.coalesce("_new", "LoadWatermark"))
        .select(*watermarks.columns)
    )


def since(df: DataFrame, column: str, watermark: Moment) -> DataFrame:
    """Rows at or after the watermark: a literal bound that reaches the scan and its partitions."""
    return df.where(F.col(column) >= moment(watermark, df.schema[column].dataType))


def incremental_slices(
    tables: Mapping[Name, DataFrame], control: Iterable[tuple[str, str, str | None]], watermark: Moment
) -> dict[tuple[str, str, str], DataFrame]:
    """The new rows by each (schema, table, column) that the control list names.

    A table with several watermark columns has a slice for each: a row may be new by one of them
    only. A control row without a column asks for nothing; one for an unknown table is refused.
    """
    named = list(dict.fromkeys((schema, table, column) for schema, table, column in control if column is not None))
    unknown = sorted({(schema, table) for schema, table, _ in named} - set(tables))
    if unknown:
        raise LookupError(f"the control list names tables that are not there: {unknown}")
    return {(schema, table, column): since(tables[schema, table], column, watermark) for schema, table, column in named}


def new_rows(
    df: DataFrame, columns: Iterable[str], watermark: Moment
) -> DataFrame:
    """Rows that are new by any of the columns, each once."""
    return df.where(reduce(lambda a, b: a | b, (F.col(c) >= moment(watermark, df.schema[c].dataType) for c in columns)))
