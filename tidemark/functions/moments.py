"""Points in time as columns, independent of the machine's own clock and zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the end of every open period, at Spark's microsecond precision.
OPEN_END = "9999-12-31 23:59:59.999999"

Moment = str | dt.date | dt.datetime | Column


def moment(value: Moment, data_type: T.DataType | str = "timestamp_ntz") -> Column:
    """``value`` as a column of ``data_type``; zoned types read it in the session's zone."""
    if isinstance(value, Column):
        return value.cast(data_type)
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(value).cast(data_type)


def open_end(data_type: T.DataType | str = "timestamp_ntz") -> Column:
    return moment(OPEN_END, data_type)
