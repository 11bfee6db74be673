"""Warehouse loading and table governance as PySpark DataFrame operators."""

from tidemark.spec import ForeignKey, TableSpec

__all__ = ["ForeignKey", "TableSpec"]
