"""Column encryption for key holders, and masking.

Ciphertexts are AES-GCM with a random nonce per value. Keys are literals of the plan: set
``spark.sql.redaction.string.regex`` (see ``REDACT_KEYS``) to keep them out of printed plans.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HIDDEN = "XXXX"  # fixed value: what stands for any text
# Matches the hexadecimal form in which plans print a key of 16 to 32 bytes.
REDACT_KEYS = r"(0x|X')?[0-9A-Fa-f]{32,64}'?"


class KeyAccessError(PermissionError):
    """The user may not open the key, or the key cannot be opened at all."""


@dataclass(frozen=True)
class OpenKey:
    key_id: str
    secret: bytes = field(repr=False)


class KeyProvider(Protocol):
    def open(self, key_id: str, user: str) -> OpenKey:
        """The key, or ``KeyAccessError``, before any plan is built."""


@dataclass
class GrantedKeys:
    """A key provider with a list of users per key; ``available`` stands for the key store."""

    secrets: Mapping[str, bytes] = field(repr=False)
    grants: Mapping[str, Iterable[str]]
    available: bool = True

    def open(self, key_id: str, user: str) -> OpenKey:
        if not self.available:
            raise KeyAccessError("the key store is not available")
        if key_id not in self.secrets:
            raise KeyAccessError(f"no key {key_id}")
        if user.lower() not in {u.lower() for u in self.grants.get(key_id, ())}:
            raise KeyAccessError(f"{user} may not open {key_id}")
        return OpenKey(key_id, self.secrets[key_id])


def _encoded(value: Column, data_type: T.DataType) -> Column:
    """A value as text that means the same in every session."""
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(value).cast("string")  # an instant's default text hangs on the session's zone
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        raise TypeError(f"{data_type.simpleString()} has no text that it can be read back from")
    return value if isinstance(data_type, T.BinaryType) else value.cast("string")


def _decoded(plain: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_micros(plain.cast("string").try_cast("bigint"))
    return plain if isinstance(data_type, T.BinaryType) else plain.cast("string").try_cast(data_type)


def encrypt(df: DataFrame, column: str, out: str, key: OpenKey) -> DataFrame:
    """Add ``column`` encrypted as a binary column; the plain column stays.

    The key is a literal of the plan, which printed plans show unless ``REDACT_KEYS`` is set.
    """
    plain = _encoded(F.col(column), df.schema[column].dataType)
    return df.withColumn(out, F.aes_encrypt(plain, F.lit(key.secret), F.lit("GCM")))


def insert_encrypted(
    df: DataFrame, rows: DataFrame, columns: Mapping[str, str], key: OpenKey
) -> DataFrame:
    """Append rows, encrypting each plain column into its ciphertext column on the way in."""
    for plain, cipher in columns.items():
        rows = encrypt(rows, plain, cipher, key)
    return df.unionByName(rows)


def decrypt(df: DataFrame, column: str, out: str, data_type: T.DataType | str, key: OpenKey | None) -> DataFrame:
    """Add the plain value; NULL without a key, and NULL where the key does not fit."""
    if key is None:
        return df.withColumn(out, F.lit(None).cast(data_type))
    plain = F.try_aes_decrypt(F.col(column), F.lit(key.secret), F.lit("GCM"))
    kind = T._parse_datatype_string(data_type) if isinstance(data_type, str) else data_type
    return df.withColumn(out, _decoded(plain, kind))


def _default_mask(name: str, data_type: T.DataType) -> Column:
    value = F.col(name)
    if isinstance(data_type, T.StringType):
        constant = F.lit(HIDDEN)  # the same for every text: not even its length shows
    elif isinstance(data_type, T.NumericType):
        constant = F.lit(0)
    elif isinstance(data_type, T.BooleanType):
        constant = F.lit(False)
    elif isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        constant = F.lit("1900-01-01")
    elif isinstance(data_type, T.BinaryType):
        constant = F.unhex(F.lit("00"))
    else:
        raise TypeError(f"no default mask for {name}: {data_type.simpleString()}")
    return F.when(value.isNotNull(), constant.cast(data_type))


def mask_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Hide values behind a constant of their type; NULL stays NULL."""
    masked = {c.lower() for c in columns}
    missing = masked - {c.lower() for c in df.columns}
    if missing:
        raise ValueError(f"no columns {sorted(missing)}")
    return df.select(
        *(_default_mask(f.name, f.dataType).alias(f.name) if f.name.lower() in masked else F.col(f.name) for f in df.schema.fields)
    )
