"""System-versioned tables: a current and a history DataFrame with ``[start, end)`` periods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import settle
from tidemark.functions.guards import require, true
from tidemark.functions.moments import OPEN_END, Moment, moment, open_end
from tidemark.functions.ordered import HOT_ROWS, running_max_before
from tidemark.operators.merge import merge_load
from tidemark.spec import ForeignKey, TableSpec

PERIOD_TYPE = "timestamp_ntz"
BEGINNING = "0001-01-01 00:00:00"


class VersioningError(RuntimeError):
    """An action the table's versioning state does not allow."""


class ConsistencyError(RuntimeError):
    """Current and history do not fit together."""


@dataclass(frozen=True)
class TemporalTable:
    """A pair of DataFrames; every change returns a new pair and leaves this one as it is.

    While ``versioned`` is on, history only grows through updates and deletes. Rows can be
    loaded by hand while it is off, and turning it on checks the pair first.
    """

    current: DataFrame
    history: DataFrame
    key: tuple[str, ...]
    start: str = "RowStartDate"
    end: str = "RowEndDate"
    versioned: bool = True
    history_constraints: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    #: A column of history with the day its rows ended, by which it is stored in partitions.
    ended: str | None = None

    @classmethod
    def create(
        cls,
        df: DataFrame,
        key: Sequence[str],
        start_at: Moment,
        start: str = "RowStartDate",
        end: str = "RowEndDate",
    ) -> TemporalTable:
        """Version an existing table from ``start_at``: one moment, or a column with each row's start."""
        taken = {start.lower(), end.lower()} & {c.lower() for c in df.columns}
        if taken:
            raise ValueError(f"the table already has {sorted(taken)}")
        current = df.withColumns({start: moment(start_at, PERIOD_TYPE), end: open_end(PERIOD_TYPE)})
        return cls(current, current.where(F.lit(False)), tuple(key), start, end)

    # Changes

    def constrained(self, not_null: Sequence[str] = (), foreign_keys: Sequence[ForeignKey] = ()) -> TemporalTable:
        """Add constraints on current rows: columns that are never NULL, and foreign keys.

        They hold with versioning on or off. A foreign key without a parent refers to this table.
        """
        unknown = {*not_null, *(fk.column for fk in foreign_keys)} - set(self.current.columns)
        if unknown:
            raise ValueError(f"there is no {sorted(unknown)}")
        return replace(
            self, not_null=(*self.not_null, *not_null), foreign_keys=(*self.foreign_keys, *foreign_keys)
        )

    def insert(self, rows: DataFrame, now: Moment) -> TemporalTable:
        """Add rows that start now. The period columns are generated and must not be given, all others must.

        Keys, columns that are never NULL and foreign keys are checked in the plan of the new rows: a
        row that breaks one fails the job that writes or reads them, and no job runs before it.
        """
        self._refuse_periods(rows.columns)
        wanted = [c for c in self.current.columns if c not in (self.start, self.end)]
        if {c.lower() for c in rows.columns} != {c.lower() for c in wanted}:
            raise ValueError(f"rows have {sorted(rows.columns)}, the table {sorted(wanted)}")
        typed = rows.select(*(F.col(c).cast(self._type(c)).alias(c) for c in wanted))
        stamped = self._checked_keys(self._checked(typed, rows)).withColumns(self._open_period(now))
        return replace(self, current=self.current.unionByName(stamped))

    def _checked(self, rows: DataFrame, added: DataFrame | None = None, where: Column | None = None) -> DataFrame:
        """``rows``, failing on a NULL that is not allowed or a value without a parent, among all rows or
        those ``where`` it holds. A row added may be the parent of another, or its own."""
        checks = [(F.col(c).isNotNull(), f"{c} is NULL") for c in dict.fromkeys((*self.key, *self.not_null))]
        marked, marks = rows, []
        for n, fk in enumerate(self.foreign_keys):
            parent = fk.parent
            if parent is None:
                parent = self.current.select(fk.parent_column)
                parent = parent if added is None else parent.unionByName(added.select(fk.parent_column))
            name = f"_parent_{n}"
            # Distinct on the parent's side, so that a row meets one parent at most and stays one row.
            parents = parent.select(F.col(fk.parent_column).alias(name)).where(F.col(name).isNotNull()).distinct()
            marked = marked.join(parents, F.col(fk.column) == F.col(name), "left")
            checks.append((F.col(fk.column).isNull() | F.col(name).isNotNull(), f"{fk.column} has no parent in {fk.parent_name}"))
            marks.append(name)
        broken = F.lit(None).cast("string")
        for holds, message in reversed(checks):
            broken = F.when(~holds, F.lit(message)).otherwise(broken)
        if where is not None:
            broken = F.when(where, broken)
        return require(marked, broken.isNull(), broken).drop(*marks) if checks else rows

    def _checked_keys(self, rows: DataFrame) -> DataFrame:
        """``rows``, failing on a key that is given twice or there already."""
        if not self.key:
            return rows
        there = self.current.select(*(F.col(k).alias(f"_there_{k}") for k in self.key)).withColumn("_there", F.lit(True))
        same = [F.col(k) == F.col(f"_there_{k}") for k in self.key]
        copy = F.row_number().over(Window.partitionBy(*self.key).orderBy(*self.key))
        met = rows.withColumn("_copy", copy).join(there, same, "left")
        message = F.when(F.col("_there"), F.lit("a key is there already")).otherwise(F.lit("a key is given twice"))
        return require(met, F.col("_there").isNull() & (F.col("_copy") == 1), message).select(*rows.columns)

    def update(self, condition: Column, assignments: Mapping[str, Column], now: Moment) -> TemporalTable:
        """Change matching rows; each gets a new version even when no value differs."""
        self._refuse_periods(assignments)
        hit = true(condition)
        new_values = {**assignments, self.start: moment(now, self._type(self.start))}
        current = self.current.select(
            *(
                F.when(hit, new_values[c]).otherwise(F.col(c)).cast(self._type(c)).alias(c)
                if c in new_values
                else F.col(c)
                for c in self.current.columns
            )
        )
        if set(assignments) & {*self.key, *self.not_null, *(fk.column for fk in self.foreign_keys)}:
            # The new image of a changed row starts now; what is not changed was checked before.
            current = self._checked(current, current, F.col(self.start) == moment(now, self._type(self.start)))
        return replace(self, current=current, history=self._with_ended(self.current.where(hit), now))

    def delete(self, condition: Column, now: Moment) -> TemporalTable:
        hit = true(condition)
        return replace(
            self, current=self.current.where(~hit), history=self._with_ended(self.current.where(hit), now)
        )

    def merge(self, stage: DataFrame, spec: TableSpec, now: Moment) -> TemporalTable:
        """Merge a stage: inserts leave history alone, a changed row puts its prior version there."""
        named = replace(spec, keys=self.key, start=self.start, end=self.end)
        merged = merge_load(self.current, stage, named, now)
        if not self.versioned:
            return replace(self, current=merged.current)
        return replace(self, current=merged.current, history=self._with_history(merged.history_delta))

    # Reads

    def visible(self) -> DataFrame:
        """Current rows without the period columns."""
        return self.current.drop(self.start, self.end)

    def all_versions(self) -> DataFrame:
        """Current rows and history, without versions that never were valid for a moment."""
        return self._versions()

    def as_of(self, at: Moment) -> DataFrame:
        """Versions valid at one instant."""
        t = moment(at, self._type(self.start))
        return self._versions(t).where((F.col(self.start) <= t) & (F.col(self.end) > t))

    def from_to(self, low: Moment, high: Moment) -> DataFrame:
        """Versions active between two instants, both ends left out."""
        a, b = (moment(m, self._type(self.start)) for m in (low, high))
        return self._versions(a).where((F.col(self.start) < b) & (F.col(self.end) > a))

    def between(self, low: Moment, high: Moment) -> DataFrame:
        """As ``from_to``, with versions that start at the upper instant."""
        a, b = (moment(m, self._type(self.start)) for m in (low, high))
        return self._versions(a).where((F.col(self.start) <= b) & (F.col(self.end) > a))

    def contained_in(self, low: Moment, high: Moment) -> DataFrame:
        """Versions that start and end inside the range, both ends included."""
        a, b = (moment(m, self._type(self.start)) for m in (low, high))
        return self._versions(a, b).where((F.col(self.start) >= a) & (F.col(self.end) <= b))

    def _versions(self, first: Column | None = None, last: Column | None = None) -> DataFrame:
        """Current rows and history; of a history stored by day, only days from ``first`` to ``last``."""
        lasted = self.history.where(F.col(self.start) < F.col(self.end))
        if self.ended is not None:
            if first is not None:
                lasted = lasted.where(F.col(self.ended) >= F.to_date(first))
            if last is not None:
                lasted = lasted.where(F.col(self.ended) <= F.to_date(last))
            lasted = lasted.drop(self.ended)
        return self.current.unionByName(lasted)

    def join_current(self, other: TemporalTable, on: Column, prefixes: tuple[str, str]) -> DataFrame:
        """Inner join of current versions; both sides' period columns stay, told apart by prefix."""
        left, right = (
            t.current.withColumnsRenamed({t.start: p + t.start, t.end: p + t.end})
            for t, p in zip((self, other), prefixes)
        )
        return left.join(right, on, "inner")

    # Versioning state

    def versioning_off(self) -> TemporalTable:
        return replace(self, versioned=False)

    def versioning_on(self) -> TemporalTable:
        """Check the pair and turn versioning on."""
        if self.history_constraints:
            raise VersioningError(f"history has constraints: {', '.join(self.history_constraints)}")
        self.check_schema()
        for problem, rows in (
            ("periods that end before they start", self.check_periods()),
            ("overlapping periods", self.check_overlaps()),
        ):
            found = rows.select(*self.key, self.start, self.end).limit(5).collect()
            if found:
                raise ConsistencyError(f"{problem}: {found}")
        return replace(self, versioned=True)

    def load_history(self, rows: DataFrame) -> TemporalTable:
        self._only_while_off("loading history rows by hand")
        return replace(self, history=self._with_history(rows))

    def load_current(self, rows: DataFrame) -> TemporalTable:
        """Add current rows with a start of their own; the end defaults to open."""
        self._only_while_off("loading current rows with an explicit start")
        if self.end not in rows.columns:
            rows = rows.withColumn(self.end, open_end(self._type(self.end)))
        return replace(self, current=self.current.unionByName(rows))

    def add_column(self, name: str, data_type: str) -> TemporalTable:
        """Add an empty column; while versioned, to both tables."""
        empty = F.lit(None).cast(data_type)
        history = self.history.withColumn(name, empty) if self.versioned else self.history
        return replace(self, current=self.current.withColumn(name, empty), history=history)

    def drop_column(self, name: str) -> TemporalTable:
        """Drop a column; while versioned its past values are lost too."""
        if name in (*self.key, self.start, self.end):
            raise VersioningError(f"{name} is part of the key or the period")
        history = self.history.drop(name) if self.versioned else self.history
        return replace(self, current=self.current.drop(name), history=history)

    def add_history_constraint(self, name: str) -> TemporalTable:
        self._only_while_off("a constraint on history")
        return replace(self, history_constraints=(*self.history_constraints, name))

    def drop_history_constraint(self, name: str) -> TemporalTable:
        return replace(self, history_constraints=tuple(c for c in self.history_constraints if c != name))

    def truncate(self) -> TemporalTable:
        self._only_while_off("truncating the table")
        return replace(self, current=self.current.where(F.lit(False)))

    def drop(self) -> DataFrame:
        """Drop the current table; history is a table of its own and is handed back."""
        self._only_while_off("dropping the table")
        return self.history

    # Checks

    def check_periods(self) -> DataFrame:
        return self._stored().where(F.col(self.start) > F.col(self.end))

    def check_overlaps(self, hot_rows: int = HOT_ROWS) -> DataFrame:
        """Versions that start before an earlier version of their key has ended.

        Touching periods and gaps are fine, and a period without an instant overlaps nothing.
        """
        filled = self.all_versions().where(F.col(self.start) < F.col(self.end))
        running = running_max_before(
            filled, self.key, [self.start, self.end], self.end, "_busy_until", hot_rows
        )
        return running.where(F.col("_busy_until") > F.col(self.start)).drop("_busy_until")

    def consistency(self, hot_rows: int = HOT_ROWS) -> DataFrame:
        """One row per rule that the pair must keep: ``rule``, and how many ``keys`` and ``rows`` break it.

        All rules are judged in one ordered pass per key. A column that is missing or of another type in
        history is found before, by ``check_schema``.
        """
        self.check_schema()
        start, end = F.col(self.start), F.col(self.end)
        stored = self.current.withColumn("_is_current", F.lit(True)).unionByName(
            self._own(self.history).withColumn("_is_current", F.lit(False))
        )
        narrow = stored.select(*self.key, self.start, self.end, "_is_current", F.when(start < end, end).alias("_until"))
        busy = running_max_before(narrow, self.key, [self.start, self.end], "_until", "_busy_until", hot_rows)
        broken = {
            "ends before it starts": start > end,
            "overlaps an earlier version": (start < end) & true(F.col("_busy_until") > start),
            "current row has ended": F.col("_is_current") & (end < open_end(self._type(self.end))),
        }
        of_key = busy.groupBy(*self.key).agg(
            *(F.count_if(condition).alias(rule) for rule, condition in broken.items()),
            F.greatest(F.count_if("_is_current") - 1, F.lit(0)).alias("several current rows"),
        )
        rules = [*broken, "several current rows"]
        found = F.array(*(F.struct(F.lit(r).alias("rule"), F.col(f"`{r}`").alias("n")) for r in rules))
        # Four rows a key, counted on the map side; a rule that no row breaks still has its row.
        counted = of_key.select(F.explode(found).alias("x")).select("x.*").groupBy("rule").agg(
            F.count_if(F.col("n") > 0).alias("keys"), F.sum("n").alias("rows")
        )
        every = self.current.sparkSession.createDataFrame([(r,) for r in rules], "rule string")
        zero = F.lit(0).cast("long")
        return every.join(counted, "rule", "left").select("rule", F.coalesce("keys", zero).alias("keys"), F.coalesce("rows", zero).alias("rows"))

    def check_schema(self) -> None:
        ours = {f.name.lower(): f.dataType for f in self.current.schema.fields}
        theirs = {f.name.lower(): f.dataType for f in self._own(self.history).schema.fields}
        if len(ours) != len(theirs):
            raise ConsistencyError(f"{len(ours)} current columns, {len(theirs)} in history")
        if ours.keys() != theirs.keys():
            raise ConsistencyError(f"column names differ: {sorted(ours.keys() ^ theirs.keys())}")
        differing = [c for c in ours if ours[c] != theirs[c]]
        if differing:
            raise ConsistencyError(f"column types differ: {differing}")

    # Helpers

    def _stored(self) -> DataFrame:
        """All rows there are, for the checks: also those that reads leave out."""
        return self.current.unionByName(self._own(self.history))

    def _own(self, history: DataFrame) -> DataFrame:
        return history if self.ended is None else history.drop(self.ended)

    def _type(self, column: str):
        return self.current.schema[column].dataType

    def _open_period(self, now: Moment) -> dict[str, Column]:
        return {
            self.start: moment(now, self._type(self.start)),
            self.end: open_end(self._type(self.end)),
        }

    def _with_ended(self, rows: DataFrame, now: Moment) -> DataFrame:
        if not self.versioned:
            return self.history
        return self._with_history(rows.withColumn(self.end, moment(now, self._type(self.end))))

    def _with_history(self, rows: DataFrame) -> DataFrame:
        """History and more rows, with their day where it is stored by day."""
        return self.history.unionByName(rows if self.ended is None else rows.withColumn(self.ended, F.to_date(self.end)))

    def _refuse_periods(self, columns) -> None:
        given = {self.start.lower(), self.end.lower()} & {c.lower() for c in columns}
        if given:
            raise VersioningError(f"{sorted(given)} are generated and cannot be given")

    def _only_while_off(self, action: str) -> None:
        if self.versioned:
            raise VersioningError(f"{action} is refused while the table is versioned")


def temporal_fk_gaps(
    child: TemporalTable,
    parent: TemporalTable,
    column: str,
    parent_column: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Child versions whose parent does not exist during all of their period.

    A report: nothing enforces this. The parent's versions are reduced to the gaps between
    them, then one ordered pass per key finds, for each child, the last gap that opens before
    the child ends. No child meets more than that one gap, so nothing is joined pairwise.
    """
    periods = parent.all_versions().select(
        F.col(parent_column).alias("_key"), F.col(parent.start).alias("_from"), F.col(parent.end).alias("_to")
    )
    periods = periods.where((F.col("_from") < F.col("_to")) & F.col("_key").isNotNull())
    running = running_max_before(periods, ["_key"], ["_from", "_to"], "_to", "_before", hot_rows)
    beginning = moment(BEGINNING, PERIOD_TYPE)
    opened = running.where(F.col("_before").isNull() | (F.col("_from") > F.col("_before"))).select(
        "_key", F.coalesce("_before", beginning).alias("_at"), F.col("_from").alias("_gap_end")
    )
    closing = (
        periods.groupBy("_key")
        .agg(F.max("_to").alias("_at"))
        .select("_key", "_at", moment(OPEN_END, PERIOD_TYPE).alias("_gap_end"))
    )
    gaps = settle(opened.unionByName(closing.where(F.col("_at") < F.col("_gap_end"))), "gaps")

    versions = child.all_versions().where(F.col(column).isNotNull())
    rows = versions.select(
        F.col(column).alias("_key"),
        F.col(child.end).alias("_at"),
        F.struct(*versions.columns).alias("_child"),
    )
    # At one instant children come first: a gap that opens as the child ends does not touch it.
    line = rows.withColumns({"_is_gap": F.lit(0), "_gap_end": F.lit(None).cast(PERIOD_TYPE)}).unionByName(
        gaps.withColumn("_is_gap", F.lit(1)), allowMissingColumns=True
    )
    seen = running_max_before(line, ["_key"], ["_at", "_is_gap"], "_gap_end", "_last_gap_end", hot_rows)
    uncovered = F.col("_last_gap_end").isNull() | (F.col("_last_gap_end") > F.col(f"_child.{child.start}"))
    return seen.where((F.col("_is_gap") == 0) & uncovered).select("_child.*")
