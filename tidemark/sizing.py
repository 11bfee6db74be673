"""What Spark itself estimates a DataFrame's size to be."""

from __future__ import annotations

from pyspark.sql import DataFrame


def planned_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate, or None where the session does not expose it."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def broadcast_limit(df: DataFrame) -> int:
    try:
        return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    except AttributeError:
        return -1


def fits_broadcast(df: DataFrame) -> bool:
    """True when Spark would broadcast ``df`` on its own, by its own threshold.

    Only used to pick the shape of a plan. No hint is ever given, so the final choice stays
    with the optimizer and with adaptive execution.
    """
    size = planned_bytes(df)
    return size is not None and size <= broadcast_limit(df)
