"""The whole load of one table: route orphans, merge the rest, or replay the exceptions."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.durable import free, settle
from tidemark.functions.guards import require, true
from tidemark.functions.moments import Moment
from tidemark.operators.merge import (
    STAGED,
    STAGED_HASH,
    Change,
    both_images,
    ended_image,
    merge_load,
    new_image,
    same_key,
    stamp,
)
from tidemark.operators.orphans import route_orphans
from tidemark.sizing import fits_broadcast
from tidemark.spec import ERROR_COLUMNS, ERROR_DESCRIPTION, ForeignKey, TableSpec

_KNOWN = "_known_"
_KNOWN_HASH = "_hash_of_known"
_LAST = "_last_"


@dataclass(frozen=True)
class LoadResult:
    """What a load leaves: ``images`` holds current and history rows together, as a merge's does."""

    current: DataFrame
    history_delta: DataFrame
    exceptions: DataFrame
    images: DataFrame


def run_load(
    target: DataFrame, stage: DataFrame, exceptions: DataFrame | None, spec: TableSpec, now: Moment
) -> LoadResult:
    """Route the stage's orphans to the exceptions, then merge what is left.

    The checked stage is settled whatever its size, so every output sees the same rows once, and
    the optimizer knows its true size when it meets the target.
    """
    keys = _bound(spec.foreign_keys, target)
    routed = route_orphans(stage, keys, exceptions, row_hash=spec.row_hash)
    merged = merge_load(target, routed.clean, spec, now)
    return LoadResult(merged.current, merged.history_delta, routed.exceptions, merged.images)


def clear_resolved(exceptions: DataFrame, loaded: DataFrame, spec: TableSpec) -> DataFrame:
    """Exceptions without those whose key and load date were loaded, whatever they describe."""
    done = loaded.select(*spec.keys, spec.load_date)
    return exceptions.join(done, [*spec.keys, spec.load_date], "left_anti")


def replay_exceptions(
    target: DataFrame,
    exceptions: DataFrame,
    spec: TableSpec,
    execution_id: int,
    now: dt.datetime,
    small: bool | None = None,
) -> LoadResult:
    """Load the orphan exceptions again, oldest load date first.

    Each date is a load of its own: rows still without a parent stay exceptions, the others are
    merged in date order, so the newest becomes current and the older ones history. Date number
    ``i`` is stamped ``now`` plus ``i`` microseconds.

    All dates are done in one pass: a key has at most one row per load date, equal neighbours
    collapse, and the order within a key gives every row its successor. Rows that Spark can
    broadcast leave the target unshuffled; more of them go through one shuffle together with the
    target, which ``small`` can ask for or refuse. The rows are the same. In a table that refers to
    its own keys one date's rows can be the next one's parents: since when each key exists is found
    first, from keys, parents and dates alone. Only a table that refers to another column of its own,
    whose values an update can take away again, is loaded date by date.
    """
    pending = exceptions.where(
        F.col(ERROR_DESCRIPTION).like("Orphan%") & F.col(spec.load_date).isNotNull()
    ).drop(*ERROR_COLUMNS)
    if spec.execution_id in pending.columns:
        pending = pending.drop(spec.execution_id)
    own = [fk for fk in spec.foreign_keys if fk.parent is None]
    if any(fk.parent_column not in spec.keys for fk in own):
        # One value per load run, not per row.
        date_type = pending.schema[spec.load_date].dataType
        days = pending.select(_date_key(spec.load_date, date_type).alias("date")).distinct().orderBy("date")
        return _replay_by_date(target, exceptions, pending, [r[0] for r in days.collect()], spec, execution_id, now)

    others = [fk for fk in spec.foreign_keys if fk.parent is not None]
    clean = route_orphans(pending, others, emit=False, row_hash=spec.row_hash).clean
    if own:
        clean = _with_parents_in_time(target, clean, own, spec)
    change = Change.of(target, spec)
    staged = _staged_versions(target, clean.distinct(), pending, spec, change, execution_id, now)
    loaded = staged.select(*(F.col(STAGED + k).alias(k) for k in spec.keys), spec.load_date)
    left = clear_resolved(exceptions, loaded, spec)
    if not (fits_broadcast(staged) if small is None else small):
        images = _images_in_one_shuffle(target, staged, spec, change)
        current, history = (images.where(F.col("kind") == kind).drop("kind") for kind in ("current", "history"))
        return LoadResult(current, history, left, images)

    survivors = _linked(staged, spec, change)
    changed = _changed_versions(target, survivors, spec, change)
    by_key = Window.partitionBy(*(STAGED + k for k in spec.keys)).orderBy("_at")
    ordered = changed.withColumns({"_from": F.first("_at").over(by_key), "_until": F.lead("_at").over(by_key)})
    # With its true size known it is broadcast to the target, which is only scanned.
    ordered = settle(ordered, "replay")
    last = ordered.where(F.col("_until").isNull())

    on = same_key(spec)
    keys = [STAGED + k for k in spec.keys]
    images = new_image(target, spec, F.col("_at"))
    newest = last.select(*keys, *(i.alias(_LAST + c) for c, i in zip(target.columns, images)), "_in_target", "_from")
    # The newest version of a key also tells since when the target's row is history.
    either = [
        F.when(F.col("_in_target").isNotNull(), F.col(_LAST + c)).otherwise(F.col(c)).alias(c) for c in target.columns
    ]
    ended = ended_image(target, spec, F.col("_from"))
    joined = target.join(newest.where("_in_target"), on, "left")
    inserted = last.where(~F.col("_in_target")).select(*images)
    current = joined.select(*either).unionByName(inserted)
    both = both_images(target, joined, either, ended, true(F.col("_in_target")))
    both = both.unionByName(inserted.withColumn("kind", F.lit("current")))
    superseded = ordered.where(F.col("_until").isNotNull()).select(*images, "_until")
    superseded = superseded.select(*ended_image(target, spec, F.col("_until")))
    history = target.join(newest.where("_in_target"), on, "inner").select(*ended).unionByName(superseded)
    both = both.unionByName(superseded.withColumn("kind", F.lit("history")))
    return LoadResult(current, history, left, both)


def _images_in_one_shuffle(target: DataFrame, staged: DataFrame, spec: TableSpec, change: Change) -> DataFrame:
    """Current and history images from the target's rows and all their later versions side by side.

    Both are dealt out by key once. Within a key the target's row comes first, then the versions by
    load date: each row's neighbours tell whether it changes anything and until when it lasts.
    """
    keys = [f"_key_{i}" for i in range(len(spec.keys))]
    compared = change.columns(_KNOWN, _KNOWN_HASH)
    types = {f.name: f.dataType for f in target.schema.fields}
    of_target = [_KNOWN_HASH] if change.hashed else [F.col(c).alias(_KNOWN + c) for c in change.scope]
    of_stage = (
        [F.col(STAGED_HASH).alias(_KNOWN_HASH)] if change.hashed else [F.col(STAGED + c).alias(_KNOWN + c) for c in change.scope]
    )
    known = change.with_hash(target, _KNOWN_HASH).select(
        *(F.col(k).alias(name) for k, name in zip(spec.keys, keys)),
        *of_target,
        F.lit(None).cast("timestamp_ntz").alias("_at"),
        *target.columns,
    )
    images = staged.select("*", *new_image_columns(target, spec))
    versions = images.select(
        *(F.col(STAGED + k).cast(types[k]).alias(name) for k, name in zip(spec.keys, keys)),
        *of_stage,
        "_at",
        *(F.col(_LAST + c).alias(c) for c in target.columns),
    )
    by_key = Window.partitionBy(*keys).orderBy(F.col("_at").asc_nulls_first())
    first = F.row_number().over(by_key) == 1
    is_old = F.col("_at").isNull()
    after_target = F.lag(is_old).over(by_key)
    same = F.lit(True)
    for c in compared:
        same = same & F.lag(c).over(by_key).eqNullSafe(F.col(c))
    no_hash = F.lit(False)
    if change.hashed:
        # Against a NULL hash nothing counts as changed, neither the first version nor a later one.
        no_hash = F.first(is_old).over(by_key) & F.first(F.col(_KNOWN_HASH).isNull()).over(by_key)
        same = same | (after_target & F.col(_KNOWN_HASH).isNull())
    twice = true(F.lag("_at").over(by_key) == F.col("_at"))
    marked = known.unionByName(versions).withColumns(
        {"_keeps": is_old | first | ~(no_hash | same), "_twice": twice}
    )
    checked = require(marked, ~F.col("_twice"), "one load date holds one key twice")
    kept = checked.where("_keeps").withColumn("_until", F.lead("_at").over(by_key))
    over = F.col("_until").isNotNull()
    ended = [
        F.when(over, F.col("_until").cast(types[c])).otherwise(F.col(c)).alias(c) if c == spec.end else F.col(c)
        for c in target.columns
    ]
    return kept.select(*ended, F.when(over, "history").otherwise("current").alias("kind"))


def _bound(foreign_keys: tuple[ForeignKey, ...], target: DataFrame) -> list[ForeignKey]:
    return [fk if fk.parent is not None else replace(fk, parent=target) for fk in foreign_keys]


def _date_key(column: str, data_type: T.DataType) -> Column:
    """A load date as a value that survives the driver: as text two instants of a zone could look alike."""
    return F.unix_micros(column) if isinstance(data_type, T.TimestampType) else F.col(column).cast("string")


def _date_value(key: Column, data_type: T.DataType) -> Column:
    return F.timestamp_micros(key) if isinstance(data_type, T.TimestampType) else key.cast(data_type)


def new_image_columns(target: DataFrame, spec: TableSpec) -> list[Column]:
    """A staged row as a row of the target, under names of its own."""
    return [image.alias(_LAST + c) for c, image in zip(target.columns, new_image(target, spec, F.col("_at")))]


def _staged_versions(
    target: DataFrame,
    rows: DataFrame,
    pending: DataFrame,
    spec: TableSpec,
    change: Change,
    execution_id: int,
    now: dt.datetime,
) -> DataFrame:
    """The rows to load in the target's types, with the stamp of their load date; settled."""
    # One row per load run: numbering them is no work for more than one task.
    number = F.row_number().over(Window.orderBy(spec.load_date)) - 1
    at = F.expr(f"timestampadd(MICROSECOND, _number, TIMESTAMP_NTZ'{now.isoformat(sep=' ')}')")
    times = pending.select(spec.load_date).distinct().withColumn("_number", number).select(spec.load_date, at.alias("_at"))
    columns = spec.source_columns(target.columns)
    types = {f.name: f.dataType for f in target.schema.fields}
    values = {spec.execution_id: F.lit(execution_id), spec.load_date: F.col("_at")}
    hashed = change.with_hash(rows.join(times, spec.load_date), STAGED_HASH)
    return settle(
        hashed.select(
            *(values.get(c, F.col(c)).cast(types[c]).alias(STAGED + c) for c in columns),
            *([STAGED_HASH] if change.hashed else []),
            "_at",
            spec.load_date,
        ),
        "replay",
    )


def _linked(staged: DataFrame, spec: TableSpec, change: Change) -> DataFrame:
    """Versions marked as first of their key or as a repetition of the one before."""
    by_key = Window.partitionBy(*(STAGED + k for k in spec.keys)).orderBy("_at")
    before = F.lag("_at").over(by_key)
    same = F.lit(True)
    for c in change.columns(STAGED, STAGED_HASH):
        same = same & F.lag(c).over(by_key).eqNullSafe(F.col(c))
    linked = staged.withColumns({"_before": before, "_repeats": before.isNotNull() & same})
    once = require(
        linked, F.coalesce(F.col("_before") != F.col("_at"), F.lit(True)), "one load date holds one key twice"
    )
    return once.withColumn("_is_first", F.col("_before").isNull()).drop("_before")


def _changed_versions(target: DataFrame, survivors: DataFrame, spec: TableSpec, change: Change) -> DataFrame:
    """Versions that differ from what they replace, with ``_in_target`` for known keys."""
    wanted = survivors.select(*(STAGED + k for k in spec.keys))
    found = change.with_hash(target, _KNOWN_HASH).join(wanted, same_key(spec), "left_semi")
    compared = [_KNOWN_HASH] if change.hashed else [F.col(c).alias(_KNOWN + c) for c in change.scope]
    known = found.select(*spec.keys, *compared, F.lit(True).alias("_in_target"))
    joined = survivors.join(known, same_key(spec), "left").drop(*spec.keys)
    differs = change.differs(STAGED, STAGED_HASH, _KNOWN, _KNOWN_HASH)
    # Against a NULL hash nothing ever counts as changed, neither the first version nor a later one.
    frozen = F.col(_KNOWN_HASH).isNull() if change.hashed else F.lit(False)
    marked = joined.withColumn("_in_target", true(F.col("_in_target")))
    no_update = F.col("_in_target") & (frozen | (F.col("_is_first") & ~differs))
    return marked.where(~F.col("_repeats") & ~no_update).drop(
        "_repeats", "_is_first", *change.columns(_KNOWN, _KNOWN_HASH)
    )


def _with_parents_in_time(target: DataFrame, rows: DataFrame, own: list[ForeignKey], spec: TableSpec) -> DataFrame:
    """The rows whose parents in the table itself are there before their load date.

    A key exists from the first load date of a row of it that is loaded, and a row is loaded once all
    its parents exist; keys never go, so both only grow. Each round loads all rows whose parents are
    known to be in time, whatever their dates, and so sees one more generation of them: there are
    no more rounds than a parent has generations, and no more than load dates. Rounds see keys,
    parents and dates only. Of the target just the key columns that are referred to are read.
    """
    columns = list(dict.fromkeys(fk.parent_column for fk in own))
    parents = [f"_parent_{i}" for i in range(len(own))]
    links = rows.select(
        *(F.col(c).alias(f"_own_{i}") for i, c in enumerate(columns)),
        *(F.col(fk.column).cast(target.schema[fk.parent_column].dataType).alias(p) for fk, p in zip(own, parents, strict=True)),
        F.col(spec.load_date).alias("_date"),
    ).distinct()
    waiting = settle(links, "links")
    asked, known = [], []
    for i, column in enumerate(columns):
        named = [p for fk, p in zip(own, parents, strict=True) if fk.parent_column == column]
        values = waiting.select(F.explode(F.array(*named)).alias("_value")).where("_value IS NOT NULL").distinct()
        values = settle(values, "asked")
        there = values.join(target.select(F.col(column).alias("_there")), F.col("_value") == F.col("_there"), "left_semi")
        asked.append(values)
        # A date that is NULL: there before the first load.
        known.append(settle(there.withColumn("_since", F.lit(None).cast(links.schema["_date"].dataType)), "known"))

    def in_time(df: DataFrame, date: Column) -> DataFrame:
        fits = F.lit(True)
        for n, (fk, parent) in enumerate(zip(own, parents, strict=True)):
            since = known[columns.index(fk.parent_column)].select(
                F.col("_value").alias(f"_value_{n}"), F.col("_since").alias(f"_since_{n}")
            )
            df = df.join(since, F.col(parent) == F.col(f"_value_{n}"), "left")
            early = F.col(f"_value_{n}").isNotNull() & true(F.col(f"_since_{n}").isNull() | (F.col(f"_since_{n}") < date))
            fits = fits & (F.col(parent).isNull() | early)
        return df.withColumn("_in_time", fits)

    while True:
        judged = settle(in_time(waiting, F.col("_date")).select(*waiting.columns, "_in_time"), "links")
        free(waiting)
        found = judged.where("_in_time")
        if found.isEmpty():
            free(judged)
            break
        for i in range(len(columns)):
            new = found.select(F.col(f"_own_{i}").alias("_value"), F.col("_date").alias("_since"))
            new = new.join(asked[i], "_value", "left_semi").groupBy("_value").agg(F.min("_since").alias("_since"))
            both = known[i].unionByName(new).groupBy("_value")
            first = F.when(F.count("*") == F.count("_since"), F.min("_since")).alias("_since")
            before, known[i] = known[i], settle(both.agg(first), "known")
            free(before)
        waiting = settle(judged.where("NOT _in_time").drop("_in_time"), "links")
        free(judged)
    free(*asked)
    named = rows.withColumns(
        {p: F.col(fk.column).cast(target.schema[fk.parent_column].dataType) for fk, p in zip(own, parents, strict=True)}
    )
    return in_time(named, F.col(spec.load_date)).where("_in_time").select(*rows.columns)


def _replay_by_date(
    target: DataFrame,
    exceptions: DataFrame,
    pending: DataFrame,
    dates: list[str] | list[int],
    spec: TableSpec,
    execution_id: int,
    now: dt.datetime,
) -> LoadResult:
    current, left = target, exceptions
    history = target.limit(0)
    for number, date in enumerate(dates):
        at = now + dt.timedelta(microseconds=number)
        due = pending.where(F.col(spec.load_date) == _date_value(F.lit(date), pending.schema[spec.load_date].dataType))
        due = due.distinct()
        clean = settle(
            route_orphans(due, _bound(spec.foreign_keys, current), emit=False, row_hash=spec.row_hash).clean,
            "replay",
        )
        stage = stamp(clean, spec, execution_id, at)
        stage = stage.select(*(c for c in stage.columns if c in target.columns))
        merged = merge_load(current, stage, spec, at)
        history = history.unionByName(settle(merged.history_delta, "replay"))
        current = settle(merged.current, "replay")
        left = clear_resolved(left, clean, spec)
    images = current.withColumn("kind", F.lit("current")).unionByName(history.withColumn("kind", F.lit("history")))
    return LoadResult(current, history, left, images)
