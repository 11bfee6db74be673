"""Dense surrogate ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import settle

_PART = "_part"


def assign_ids(
    df: DataFrame, order: Sequence[str], out: str, start: int = 1, partitions: int | None = None
) -> DataFrame:
    """Number all rows ``start``, ``start + 1``, ... along ``order``, without one global sort task.

    The rows are range partitioned and settled, numbered inside each part, and shifted by the
    sizes of the parts before. Rows that tie on ``order`` are spread by a hash of the whole row,
    then by their position, so a large tie does not fall into one part.
    """
    # Settled before it is shuffled: a row's position must not change when a task is retried.
    tied = settle(df.withColumns({"_tie": F.xxhash64(*df.columns), "_place": F.monotonically_increasing_id()}), "ids")
    by = [*order, "_tie", "_place"]
    ranged = tied.repartitionByRange(partitions, *by) if partitions else tied.repartitionByRange(*by)
    placed = settle(ranged.withColumn(_PART, F.spark_partition_id()), "ids")
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    # One row per part: this window sees as many rows as there were partitions.
    shifts = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("_rows"))
    shifts = settle(shifts.select(_PART, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift")), "shifts")
    number = F.row_number().over(Window.partitionBy(_PART).orderBy(*by))
    return (
        placed.withColumn("_number", number)
        .join(shifts, _PART)
        .withColumn(out, F.col("_shift") + F.col("_number") + F.lit(start - 1).cast("bigint"))
        .select(out, *df.columns)
    )
