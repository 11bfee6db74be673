"""A row's change hash."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _text(name: str, data_type: T.DataType) -> Column:
    """One column as text that differs whenever the value differs."""
    value = F.col(f"`{name}`")
    if isinstance(data_type, T.TimestampType):
        # Not the default text: it depends on the session's time zone.
        return F.unix_micros(value).cast("string")
    if isinstance(data_type, T.BinaryType):
        return F.hex(value)
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(
            value,
            {
                "ignoreNullFields": "false",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
            },
        )
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        # -0.0 equals 0.0 wherever values are compared, so it is written like it.
        return (value + F.lit(0.0).cast(data_type)).cast("string")
    return value.cast("string")


def row_hash(df: DataFrame, columns: Iterable[str]) -> Column:
    """SHA-256 of the given columns, never NULL.

    Each value is written as its length and its text, NULL as a mark no length can be, so
    that ``('a', NULL)``, ``('a', '')`` and ``('a')`` all hash apart. Everything stays inside
    generated code; no JSON is built for flat columns.
    """
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    parts = []
    for name in columns:
        text = _text(name, types[name.lower()])
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.sha2(F.concat(*parts) if parts else F.lit(""), 256)
