"""Ordered windows per key that survive a key holding a large share of all rows.

A plain window sends each key to one task. Here keys above ``hot_rows`` rows are cut into
slices along the order, the window runs per slice, and a small per-slice summary carries the
result across slice borders. Results equal the plain window's exactly. With no such key the
plan is the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import settle

HOT_ROWS = 10_000_000
_SLICE = "_slice"


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def _sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int) -> tuple[DataFrame, bool]:
    """``df`` with a slice number per row, and whether any key was cut.

    Slices come from range partitioning the hot rows and are settled, so a retried task cannot
    place a row differently. Rows that tie on the order share a slice.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    hot = settle(counts, "hot-keys")
    total = hot.agg(F.sum("_rows")).first()[0]
    if total is None:
        return df.withColumn(_SLICE, F.lit(0)), False
    hot_keys = hot.drop("_rows").alias("hot")
    rows = df.alias("rows")
    match = _same("rows", "hot", keys)
    parts = math.ceil(total / hot_rows) + 1
    placed = (
        rows.join(hot_keys, match, "left_semi")
        .repartitionByRange(parts, *keys, *order)
        .withColumn(_SLICE, F.spark_partition_id() + 1)
    )
    rest = rows.join(hot_keys, match, "left_anti").withColumn(_SLICE, F.lit(0))
    return rest.unionByName(settle(placed, "slices")), True


def _carried(sliced: DataFrame, keys: Sequence[str], summary: Column, carry: Column) -> DataFrame:
    """Join each row with what the other slices of its key contribute."""
    per_slice = sliced.where(F.col(_SLICE) > 0).groupBy(*keys, _SLICE).agg(summary.alias("_summary"))
    carries = settle(per_slice.select(*keys, _SLICE, carry.alias("_carry")), "carries")
    match = _same("rows", "carry", [*keys, _SLICE])
    return sliced.alias("rows").join(carries.alias("carry"), match, "left").select("rows.*", "carry._carry")


def running_max_before(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the largest ``value`` among the key's earlier rows."""
    sliced, cut = _sliced(df, keys, order, hot_rows)
    window = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    if not cut:
        return sliced.withColumn(out, F.max(value).over(before)).drop(_SLICE)
    slices = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = _carried(sliced, keys, F.max(value), F.max("_summary").over(slices))
    return carried.withColumn(out, F.greatest(F.max(value).over(before), F.col("_carry"))).drop(_SLICE, "_carry")


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the row's number within its key, from 1."""
    sliced, cut = _sliced(df, keys, order, hot_rows)
    window = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    number = F.row_number().over(window).cast("bigint")
    if not cut:
        return sliced.withColumn(out, number).drop(_SLICE)
    slices = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = _carried(sliced, keys, F.count(F.lit(1)), F.sum("_summary").over(slices))
    return carried.withColumn(out, number + F.coalesce("_carry", F.lit(0))).drop(_SLICE, "_carry")


def next_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the following row's ``value`` within the key, NULL for the last row."""
    sliced, cut = _sliced(df, keys, order, hot_rows)
    window = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    following = F.lead(value).over(window)
    if not cut:
        return sliced.withColumn(out, following).drop(_SLICE)
    slices = Window.partitionBy(*keys).orderBy(_SLICE)
    carried = _carried(sliced, keys, F.min_by(value, F.struct(*order)), F.lead("_summary").over(slices))
    is_last = F.lead(F.lit(True)).over(window).isNull()
    return carried.withColumn(out, F.when(is_last, F.col("_carry")).otherwise(following)).drop(_SLICE, "_carry")
