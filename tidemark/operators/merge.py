"""Keyed merge: update what changed, insert what is new, keep the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.guards import require, true
from tidemark.functions.hashing import row_hash
from tidemark.functions.moments import Moment, moment, open_end
from tidemark.sizing import fits_broadcast
from tidemark.spec import TableSpec

STAGED = "_staged_"
STAGED_HASH = "_hash_of_stage"
_IN_STAGE = "_in_stage"
_IN_TARGET = "_in_target"


@dataclass(frozen=True)
class MergeResult:
    """The merged table, the rows it replaced, and both in one pass as ``images``.

    ``images`` carries a ``kind``: writing it partitioned by that column stores current and
    history from a single join.
    """

    current: DataFrame
    history_delta: DataFrame
    images: DataFrame


@dataclass(frozen=True)
class Change:
    """How a staged row is told apart from the row it meets.

    A target that stores its change hash is compared by it, and its other columns are not read
    for that. A target without one is compared column by column, NULL equal to NULL, which
    gives the same answer and needs no hash at all.
    """

    scope: tuple[str, ...]
    hashed: bool
    row_hash: str

    @classmethod
    def of(cls, target: DataFrame, spec: TableSpec) -> Change:
        scope = spec.hash_scope(target.columns)
        incomparable = any(isinstance(target.schema[c].dataType, (T.MapType, T.VariantType)) for c in scope)
        return cls(tuple(scope), spec.row_hash in target.columns or incomparable, spec.row_hash)

    def with_hash(self, df: DataFrame, out: str) -> DataFrame:
        """Add the change hash where it is needed: the stored one if the rows carry it."""
        if not self.hashed:
            return df
        return df.withColumn(out, F.col(self.row_hash) if self.row_hash in df.columns else row_hash(df, self.scope))

    def columns(self, prefix: str, hash_column: str) -> list[str]:
        return [hash_column] if self.hashed else [prefix + c for c in self.scope]

    def differs(self, left: str, left_hash: str, right: str, right_hash: str) -> Column:
        """Whether two images differ. A NULL hash never does."""
        if self.hashed:
            return true(F.col(left_hash) != F.col(right_hash))
        unlike = F.lit(False)
        for c in self.scope:
            unlike = unlike | ~F.col(left + c).eqNullSafe(F.col(right + c))
        return unlike


def stamp(df: DataFrame, spec: TableSpec, execution_id: int, now: Moment) -> DataFrame:
    """Set the load metadata of the rows, keeping each column's type where it exists."""
    types = dict(zip(df.columns, (f.dataType for f in df.schema.fields)))
    return df.withColumns(
        {
            spec.execution_id: F.lit(execution_id).cast(types.get(spec.execution_id, "bigint")),
            spec.load_date: moment(now, types.get(spec.load_date, "timestamp_ntz")),
        }
    )


def aligned_stage(target: DataFrame, stage: DataFrame, spec: TableSpec, change: Change) -> DataFrame:
    """The stage in the target's types, renamed apart, and refused on a repeated key.

    The key check needs the rows grouped by key, which is what the join needs too: Spark
    shuffles the stage once for both.
    """
    columns = spec.source_columns(target.columns)
    given = {c.lower() for c in spec.source_columns(stage.columns)}
    if given != {c.lower() for c in columns}:
        raise ValueError(f"stage columns {sorted(given)} do not match target columns {sorted(columns)}")
    types = {f.name: f.dataType for f in target.schema.fields}
    typed = stage.select(
        *(F.col(c).cast(types[c]).alias(c) for c in columns),
        *([spec.row_hash] if spec.row_hash in stage.columns else []),
    )
    hashed = change.with_hash(typed, STAGED_HASH)
    renamed = hashed.select(
        *(F.col(c).alias(STAGED + c) for c in columns), *([STAGED_HASH] if change.hashed else [])
    )
    keys = [STAGED + k for k in spec.keys]
    copies = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    # One condition for both: the NULL check alone would be carried over the join to the target.
    message = F.when(known, F.lit("stage holds one key twice")).otherwise(F.lit("stage holds a key that is NULL"))
    unique = require(renamed.withColumn("_copy", copies), (F.col("_copy") == 1) & known, message)
    return unique.drop("_copy").withColumn(_IN_STAGE, F.lit(True))


def same_key(spec: TableSpec) -> list[Column]:
    return [F.col(k) == F.col(STAGED + k) for k in spec.keys]


def _new_values(target: DataFrame, spec: TableSpec, now: Column) -> dict[str, Column]:
    """A staged row's value for each column of the target."""
    types = {f.name: f.dataType for f in target.schema.fields}
    generated = {
        spec.row_hash: lambda t: F.col(STAGED_HASH),
        spec.start: lambda t: now.cast(t),
        spec.end: open_end,
    }
    return {c: generated[c](t) if c in generated else F.col(STAGED + c) for c, t in types.items()}


def new_image(target: DataFrame, spec: TableSpec, now: Column) -> list[Column]:
    """A staged row as a row of the target."""
    return [value.alias(c) for c, value in _new_values(target, spec, now).items()]


def _either_image(target: DataFrame, spec: TableSpec, now: Column, take: Column) -> list[Column]:
    return [
        F.when(take, value).otherwise(F.col(c)).alias(c) for c, value in _new_values(target, spec, now).items()
    ]


def ended_image(target: DataFrame, spec: TableSpec, end: Column) -> list[Column]:
    """A row of the target whose period is over."""
    types = {f.name: f.dataType for f in target.schema.fields}
    return [end.cast(types[c]).alias(c) if c == spec.end else F.col(c) for c in target.columns]


def both_images(target: DataFrame, joined: DataFrame, current: list[Column], ended: list[Column], replaced: Column) -> DataFrame:
    """Each joined row as its current image, and once more as its old one where it was replaced."""
    kinds = F.when(replaced, F.array(F.lit("current"), F.lit("history"))).otherwise(F.array(F.lit("current")))
    doubled = joined.withColumn("kind", F.explode(kinds))
    is_old = F.col("kind") == "history"
    return doubled.select(
        *(F.when(is_old, old).otherwise(new).alias(c) for c, old, new in zip(target.columns, ended, current)), "kind"
    )


def merge_load(
    target: DataFrame,
    stage: DataFrame,
    spec: TableSpec,
    now: Moment,
    small_stage: bool | None = None,
) -> MergeResult:
    """Merge ``stage`` into ``target`` on the key columns.

    A matched row is replaced when a versioned column differs, an unmatched stage row is
    inserted, an unmatched target row is kept. A NULL hash on either side never replaces. A key
    that occurs twice in the stage fails the plan. ``history_delta`` holds the replaced rows,
    ended at ``now``.

    Two shapes give the same rows. With a stage Spark can broadcast, the target is only scanned
    and never shuffled. Otherwise one full outer join shuffles each side once.
    """
    change = Change.of(target, spec)
    staged = aligned_stage(target, stage, spec, change)
    if small_stage is None:
        # Judged as it meets the target: with its casts, its hash and its key check.
        small_stage = fits_broadcast(staged)
    old = change.with_hash(target, "_hash_of_target")
    at = moment(now, "timestamp_ntz")
    on = same_key(spec)
    differs = change.differs(STAGED, STAGED_HASH, "", "_hash_of_target")
    in_stage = true(F.col(_IN_STAGE))
    staged_keys = [STAGED + k for k in spec.keys]

    if small_stage:
        joined = old.join(staged, on, "left")
        replaced = in_stage & differs
        taken = _either_image(target, spec, at, replaced)
        # The keys found in the target are no more than the stage has, so they broadcast back.
        found = target.select(*spec.keys).join(staged.select(*staged_keys), on, "left_semi")
        inserted = staged.join(found, on, "left_anti").select(*new_image(target, spec, at))
        current = joined.select(*taken).unionByName(inserted)
        images = both_images(target, joined, taken, ended_image(target, spec, at), replaced).unionByName(
            inserted.withColumn("kind", F.lit("current"))
        )
    else:
        joined = old.withColumn(_IN_TARGET, F.lit(True)).join(staged, on, "full_outer")
        in_target = F.col(_IN_TARGET).isNotNull()
        replaced = in_stage & in_target & differs
        taken = _either_image(target, spec, at, in_stage & (~in_target | differs))
        current = joined.select(*taken)
        images = both_images(target, joined, taken, ended_image(target, spec, at), replaced)

    compared = dict.fromkeys([*staged_keys, *change.columns(STAGED, STAGED_HASH)])
    history = old.join(staged.select(*compared), on, "inner").where(differs)
    return MergeResult(current, history.select(*ended_image(target, spec, at)), images)
