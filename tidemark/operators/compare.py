"""Comparing tables as multisets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows that one side has more often: the row, ``side`` and by how many ``copies``.

    One aggregation over both sides, counting map-side first, so copies of one row collapse
    before the shuffle however many there are.
    """
    signed = expected.withColumn("_sign", F.lit(1)).unionByName(actual.withColumn("_sign", F.lit(-1)))
    surplus = signed.groupBy(*expected.columns).agg(F.sum("_sign").alias("_surplus"))
    return surplus.where(F.col("_surplus") != 0).select(
        *expected.columns,
        F.when(F.col("_surplus") > 0, "expected").otherwise("actual").alias("side"),
        F.abs("_surplus").alias("copies"),
    )


def assert_same_rows(expected: DataFrame, actual: DataFrame) -> None:
    if sorted(expected.columns) != sorted(actual.columns):
        raise AssertionError(f"columns differ: {expected.columns} and {actual.columns}")
    found = table_diff(expected, actual).limit(20).collect()
    if found:
        raise AssertionError("tables differ:\n" + "\n".join(str(row) for row in found))


def assert_empty(df: DataFrame) -> None:
    found = df.limit(20).collect()
    if found:
        raise AssertionError("expected no rows:\n" + "\n".join(str(row) for row in found))
