"""Declared facts about a table: keys, foreign keys and load metadata columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

# Columns whose change alone never makes a new version.
NON_VERSIONED = (
    "Created",
    "CreatedBy",
    "Deleted",
    "LastModified",
    "LastModifiedBy",
    "ServerExecutionID",
    "DWLoadDate",
    "RowHash",
    "VersionStartTime",
    "VersionEndTime",
)

# Columns an exception row carries after the source columns.
ERROR_CODE = "ErrorCode"
ERROR_COLUMN = "ErrorColumn"
ERROR_DESCRIPTION = "ErrorDescription"
ERROR_COLUMNS = (ERROR_CODE, ERROR_COLUMN, ERROR_DESCRIPTION)


@dataclass(frozen=True)
class ForeignKey:
    """``column`` of the loaded table points at ``parent_column`` of a parent.

    ``parent=None`` means the loaded table itself. ``parent_name`` orders the checks:
    a row broken in several keys is reported for the first one only.
    """

    column: str
    parent: DataFrame | None
    parent_column: str
    parent_name: str


@dataclass(frozen=True)
class TableSpec:
    keys: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    non_versioned: tuple[str, ...] = NON_VERSIONED
    row_hash: str = "RowHash"
    load_date: str = "DWLoadDate"
    execution_id: str = "ServerExecutionID"
    start: str = "VersionStartTime"
    end: str = "VersionEndTime"
    #: Columns by which the stored current rows are partitioned.
    partition_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError("a table needs at least one key column")

    def is_generated(self, column: str) -> bool:
        """True for columns the load computes itself, which no stage provides."""
        return column.lower() in {self.row_hash.lower(), self.start.lower(), self.end.lower()}

    def source_columns(self, columns: list[str]) -> list[str]:
        return [c for c in columns if not self.is_generated(c)]

    def hash_scope(self, columns: list[str]) -> list[str]:
        """The columns whose change makes a new version, in their given order."""
        outside = {c.lower() for c in (*self.keys, *self.non_versioned)}
        return [c for c in self.source_columns(columns) if c.lower() not in outside]
