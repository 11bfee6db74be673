"""Foreign-key checks that set rows without a parent aside."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.durable import free, settle
from tidemark.spec import ERROR_CODE, ERROR_COLUMN, ERROR_DESCRIPTION, ForeignKey


@dataclass(frozen=True)
class Routed:
    clean: DataFrame
    exceptions: DataFrame | None


def orphan_values(stage: DataFrame, fk: ForeignKey) -> DataFrame:
    """The distinct child values without a parent.

    Values are made distinct before they meet the parent, on the map side first, so a value
    that a third of all rows carry crosses the network once per task and joins once.
    """
    if fk.parent is None:
        raise ValueError(f"foreign key {fk.column} refers to the loaded table: pass it as the parent")
    values = stage.select(F.col(fk.column).alias("_child")).where(F.col("_child").isNotNull()).distinct()
    parents = fk.parent.select(F.col(fk.parent_column).alias("_parent"))
    return values.join(parents, F.col("_child") == F.col("_parent"), "left_anti")


def orphans(stage: DataFrame, fk: ForeignKey) -> DataFrame:
    """The rows whose value has no parent. A NULL value is never an orphan."""
    return stage.join(orphan_values(stage, fk), F.col(fk.column) == F.col("_child"), "left_semi")


def all_orphan_values(stage: DataFrame, foreign_keys: Sequence[ForeignKey]) -> DataFrame:
    """The values without a parent of all keys: ``_fk``, the key's number, and ``_v0``, ``_v1``, ... with the
    value in the column of its key. Settled.

    The stage is read once: its values are stacked, made distinct on the map side, and settled; each
    key's share of them then meets its parent.
    """
    names = [f"_v{i}" for i in range(len(foreign_keys))]
    stacked = F.array(
        *(
            F.struct(
                F.lit(i).alias("_fk"),
                *(
                    (F.col(fk.column) if i == j else F.lit(None).cast(stage.schema[fk.column].dataType)).alias(names[j])
                    for j, fk in enumerate(foreign_keys)
                ),
            )
            for i in range(len(foreign_keys))
        )
    )
    values = stage.select(F.explode(stacked).alias("_x")).select("_x.*")
    values = settle(values.where(_any_known(names)).distinct(), "values")
    found = None
    for i, fk in enumerate(foreign_keys):
        if fk.parent is None:
            raise ValueError(f"foreign key {fk.column} refers to the loaded table: pass it as the parent")
        parents = fk.parent.select(F.col(fk.parent_column).alias("_parent"))
        own = values.where(F.col("_fk") == i).join(parents, F.col(names[i]) == F.col("_parent"), "left_anti")
        found = own if found is None else found.unionByName(own)
    settled = settle(found, "orphans")
    free(values)
    return settled


def _any_known(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(n).isNotNull() for n in names))


def route_orphans(
    stage: DataFrame,
    foreign_keys: Iterable[ForeignKey],
    exceptions: DataFrame | None = None,
    emit: bool = True,
    row_hash: str = "RowHash",
) -> Routed:
    """Split a stage into rows whose parents all exist and exception rows.

    Keys are checked in the order of their parents' names and a row is reported once, for the
    first key it breaks. ``emit=False`` only removes the rows, as a replay does: they already
    are exceptions. New exception rows are appended to ``exceptions`` when it is given.

    The orphan values of all keys are found in one pass over the stage and settled. They are
    usually few, and once their true size is known Spark broadcasts them, so the second and last
    pass marks the rows without a shuffle; a large set falls back to a shuffled join, where adaptive
    execution splits skewed values.
    """
    ordered = sorted(foreign_keys, key=lambda fk: fk.parent_name)
    marked = stage
    marks = []
    broken = []
    found_values = all_orphan_values(stage, ordered) if ordered else None
    for position, fk in enumerate(ordered):
        mark = f"_orphan_{position}"
        values = found_values.where(F.col("_fk") == position).select(
            F.col(f"_v{position}").alias(f"{mark}_value"), F.lit(True).alias(mark)
        )
        marked = marked.join(values, F.col(fk.column) == F.col(f"{mark}_value"), "left")
        marks.append(mark)
        broken.append(F.when(F.col(mark), F.lit(f"Orphan {fk.column}")))

    first_broken = F.coalesce(*broken) if broken else F.lit(None).cast("string")
    marked = marked.withColumn("_broken", first_broken).select(*stage.columns, "_broken")
    if emit:
        # Settled whatever its size: a row goes one way only, even if the stage is not the same when read again.
        marked = settle(marked, "stage")
    clean = marked.where(F.col("_broken").isNull()).select(*stage.columns)
    if not emit:
        return Routed(clean, exceptions)
    found = marked.where(F.col("_broken").isNotNull()).select(
        *(c for c in stage.columns if c != row_hash),
        F.lit(0).alias(ERROR_CODE),
        F.lit(0).alias(ERROR_COLUMN),
        F.col("_broken").alias(ERROR_DESCRIPTION),
    )
    return Routed(clean, found if exceptions is None else exceptions.unionByName(found))
