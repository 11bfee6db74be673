"""Row-level security: predicates bound to tables decide which rows a user reads and writes.

The caller says who the user is. Spark does not keep code that holds the raw DataFrame from
reading it; the guard is that readers are only given what ``SecurityRegistry.read`` returns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.guards import true

FILTER = "FILTER"
BLOCK = "BLOCK"
AFTER_INSERT = "AFTER INSERT"
AFTER_UPDATE = "AFTER UPDATE"
BEFORE_UPDATE = "BEFORE UPDATE"
BEFORE_DELETE = "BEFORE DELETE"
OPERATIONS = (AFTER_INSERT, AFTER_UPDATE, BEFORE_UPDATE, BEFORE_DELETE)

# A user's looked-up values become literals up to this many, and a join beyond it.
MAX_LITERALS = 10_000


# Types whose values are the same literal again after they have been read.
_BOUNDED = (T.IntegralType, T.StringType, T.DateType, T.DecimalType)


class PolicyError(RuntimeError):
    """A change to predicates or policies that is not allowed."""


class BlockedError(PermissionError):
    """A write that a block predicate refuses."""


@dataclass(frozen=True)
class User:
    """Who reads or writes. Names and roles compare without regard to case."""

    name: str
    roles: frozenset[str] = frozenset()

    @classmethod
    def of(cls, name: str, roles: Iterable[str] = ()) -> User:
        return cls(name.lower(), frozenset(r.lower() for r in roles))


@dataclass(frozen=True)
class Granted:
    """What one user may see: everything, some literal values, or values held in a DataFrame."""

    everything: bool = False
    literals: tuple = ()
    held: DataFrame | None = None

    def __or__(self, other: Granted) -> Granted:
        held = self.held if other.held is None else other.held
        if self.held is not None and other.held is not None:
            held = self.held.union(other.held)
        return Granted(self.everything or other.everything, self.literals + other.literals, held)


@dataclass(frozen=True)
class Access:
    """A predicate over one column. ``a | b`` lets through what either does."""

    grant: Callable[[User], Granted]

    def __or__(self, other: Access) -> Access:
        return Access(lambda user: self.grant(user) | other.grant(user))


def by_case(values: Mapping[str, object]) -> Access:
    """Each named user sees exactly one value."""
    return by_values({name: [value] for name, value in values.items()})


def by_values(values: Mapping[str, Iterable[object]]) -> Access:
    """Each named user sees several values."""
    known = {name.lower(): tuple(vs) for name, vs in values.items()}
    return Access(lambda user: Granted(literals=known.get(user.name, ())))


def allow_all(users: Iterable[str]) -> Access:
    """The named users see every row. Nobody does by default, administrators included."""
    known = {u.lower() for u in users}
    return Access(lambda user: Granted(everything=user.name in known))


def allow_roles(roles: Iterable[str]) -> Access:
    known = {r.lower() for r in roles}
    return Access(lambda user: Granted(everything=bool(known & user.roles)))


def by_lookup(access: DataFrame, user_column: str, value_column: str, max_literals: int = MAX_LITERALS) -> Access:
    """The user sees the values an access table lists for them.

    Up to ``max_literals`` distinct values are read once and become a plain filter. More stay a
    DataFrame, and the permitted rows come from a join.
    """

    def grant(user: User) -> Granted:
        mine = access.where(F.lower(F.col(user_column)) == user.name)
        values = mine.select(F.col(value_column).alias("value")).where(F.col("value").isNotNull())
        few = values.distinct().limit(max_literals + 1).collect()
        if len(few) <= max_literals:
            return Granted(literals=tuple(row[0] for row in few))
        return Granted(held=values)

    return Access(grant)


def by_join(users: DataFrame, name_column: str, key_column: str, admin_role: str, max_literals: int = MAX_LITERALS) -> Access:
    """Rows belong to a user key; a user sees their own rows, the admin role sees all."""
    return by_lookup(users, name_column, key_column, max_literals) | allow_roles([admin_role])


def _literal_condition(granted: Granted, column: str) -> Column:
    if granted.everything:
        return F.lit(True)
    if not granted.literals:
        return F.lit(False)
    return F.col(column).isin(list(granted.literals))


def _marked(df: DataFrame, granted: Granted, column: str, mark: str) -> DataFrame:
    """``df`` with a boolean ``mark`` for the rows the grant lets through."""
    condition = true(_literal_condition(granted, column))
    if granted.held is None or granted.everything:
        return df.withColumn(mark, condition)
    held = granted.held.distinct().select(F.col(granted.held.columns[0]).alias("_held"), F.lit(True).alias("_is_held"))
    joined = df.join(held, F.col(column) == F.col("_held"), "left")
    return joined.withColumn(mark, condition | true(F.col("_is_held"))).drop("_held", "_is_held")


def _bounded(df: DataFrame, granted: Granted, column: str) -> DataFrame:
    """``df`` without rows outside the smallest and the largest permitted value.

    The bounds are literals, so they reach the scan, below the barrier that keeps callers' conditions
    off it: row groups and files that hold no permitted value are not read.
    """
    held = granted.held.columns[0]
    kind = df.schema[column].dataType
    if granted.literals or granted.held.schema[held].dataType != kind or not isinstance(kind, _BOUNDED):
        return df
    low, high = granted.held.agg(F.min(held), F.max(held)).first()
    if low is None:
        return df.where(F.lit(False))
    return df.where((F.col(column) >= F.lit(low)) & (F.col(column) <= F.lit(high)))


def _is_one_scan(df: DataFrame) -> bool:
    """Whether the rows come from a single relation, so that no join can let a condition pass a filter."""
    try:
        return df._jdf.queryExecution().analyzed().collectLeaves().size() == 1
    except AttributeError:
        return False


def _barrier(df: DataFrame) -> DataFrame:
    """All rows of ``df``, behind a sample of all of them: no condition is moved below a sample."""
    return df.sample(withReplacement=False, fraction=1.0, seed=0)


def permitted(df: DataFrame, access: Access, column: str, user: User) -> DataFrame:
    """The rows a user may see; a caller's own condition is never evaluated on any other.

    Over a scan a literal filter is enough: conditions stay behind it and both reach the scan.
    Over a join, the caller's condition could be moved to one of its sides, below the filter, and
    reveal a hidden row by failing on it: there, and where the filter is a join itself, a barrier
    keeps it above.
    """
    granted = access.grant(user)
    if granted.everything:
        return df
    if granted.held is not None:
        return _barrier(_marked(_bounded(df, granted, column), granted, column, "_may").where("_may").drop("_may"))
    seen = df.where(_literal_condition(granted, column))
    return seen if _is_one_scan(df) else _barrier(seen)


@dataclass(frozen=True)
class Binding:
    policy: str
    predicate: str
    table: str
    column: str
    kind: str
    operation: str | None


@dataclass
class SecurityRegistry:
    """Named predicates, and policies that bind them to tables."""

    predicates: dict[str, Access] = field(default_factory=dict)
    policies: dict[str, bool] = field(default_factory=dict)
    bindings: list[Binding] = field(default_factory=list)

    # Predicates

    def define(self, name: str, access: Access) -> None:
        if name in self.predicates:
            raise PolicyError(f"predicate {name} exists")
        self.predicates[name] = access

    def alter(self, name: str, access: Access) -> None:
        """Change a predicate no policy refers to, not even one that is off."""
        if name not in self.predicates:
            raise PolicyError(f"no predicate {name}")
        users = {b.policy for b in self.bindings if b.predicate == name}
        if users:
            raise PolicyError(f"predicate {name} is used by {sorted(users)}")
        self.predicates[name] = access

    # Policies

    def create_policy(self, name: str, enabled: bool = True) -> None:
        if name in self.policies:
            raise PolicyError(f"policy {name} exists")
        self.policies[name] = enabled

    def drop_policy(self, name: str) -> None:
        """Allowed while the policy is on."""
        self._known(name)
        del self.policies[name]
        self.bindings = [b for b in self.bindings if b.policy != name]

    def set_enabled(self, name: str, enabled: bool) -> None:
        self._known(name)
        if enabled:
            for table in {b.table for b in self.bindings if b.policy == name}:
                self._refuse_second_policy(name, table)
        self.policies[name] = enabled

    def add_filter(self, policy: str, predicate: str, table: str, column: str) -> None:
        self._add(Binding(policy, predicate, table, column, FILTER, None))

    def add_block(self, policy: str, predicate: str, table: str, column: str, operation: str) -> None:
        if operation not in OPERATIONS:
            raise PolicyError(f"{operation} is none of {OPERATIONS}")
        self._add(Binding(policy, predicate, table, column, BLOCK, operation))

    def drop_filter(self, policy: str, table: str) -> None:
        self._drop(policy, table, FILTER, None)

    def drop_block(self, policy: str, table: str, operation: str) -> None:
        self._drop(policy, table, BLOCK, operation)

    def _known(self, policy: str) -> None:
        if policy not in self.policies:
            raise PolicyError(f"no policy {policy}")

    def _add(self, new: Binding) -> None:
        self._known(new.policy)
        if new.predicate not in self.predicates:
            raise PolicyError(f"no predicate {new.predicate}")
        if any(
            (b.policy, b.table, b.kind, b.operation) == (new.policy, new.table, new.kind, new.operation)
            for b in self.bindings
        ):
            raise PolicyError(f"{new.table} has a {new.kind} predicate {new.operation or ''} already".rstrip())
        if self.policies[new.policy]:
            self._refuse_second_policy(new.policy, new.table)
        self.bindings.append(new)

    def _refuse_second_policy(self, policy: str, table: str) -> None:
        others = {b.policy for b in self.bindings if b.table == table and b.policy != policy and self.policies[b.policy]}
        if others:
            raise PolicyError(f"{table} is under policy {sorted(others)} already")

    def _drop(self, policy: str, table: str, kind: str, operation: str | None) -> None:
        self._known(policy)
        kept = [b for b in self.bindings if (b.policy, b.table, b.kind, b.operation) != (policy, table, kind, operation)]
        if len(kept) == len(self.bindings):
            raise PolicyError(f"{policy} has no such predicate on {table}")
        self.bindings = kept

    def _binding(self, table: str, kind: str, operation: str | None = None) -> Binding | None:
        return next(
            (
                b
                for b in self.bindings
                if self.policies[b.policy] and (b.table, b.kind, b.operation) == (table, kind, operation)
            ),
            None,
        )

    # Reads and writes

    def read(self, table: str, df: DataFrame, user: User) -> DataFrame:
        """The rows the user may see: all of them where no enabled policy filters the table."""
        bound = self._binding(table, FILTER)
        return df if bound is None else permitted(df, self.predicates[bound.predicate], bound.column, user)

    def insert(self, table: str, df: DataFrame, rows: DataFrame, user: User) -> DataFrame:
        self._check(table, rows, AFTER_INSERT, user)
        return df.unionByName(rows)

    def update(
        self, table: str, df: DataFrame, condition: Column, assignments: Mapping[str, Column], user: User
    ) -> DataFrame:
        """Change the matching rows the user can see; hidden rows stay as they are, without an error."""
        marked = self._targets(table, df, condition, user)
        hit = marked.where("_target")
        self._check(table, hit, BEFORE_UPDATE, user)
        self._check(table, hit.withColumns(dict(assignments)), AFTER_UPDATE, user)
        return marked.select(
            *(
                F.when(F.col("_target"), assignments[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
                if c in assignments
                else F.col(c)
                for c in df.columns
            )
        )

    def delete(self, table: str, df: DataFrame, condition: Column, user: User) -> DataFrame:
        marked = self._targets(table, df, condition, user)
        self._check(table, marked.where("_target"), BEFORE_DELETE, user)
        return marked.where(~F.col("_target")).select(*df.columns)

    def _targets(self, table: str, df: DataFrame, condition: Column, user: User) -> DataFrame:
        bound = self._binding(table, FILTER)
        if bound is None:
            return df.withColumn("_target", true(condition))
        granted = self.predicates[bound.predicate].grant(user)
        visible = _marked(df, granted, bound.column, "_visible")
        # The user's condition is only looked at on rows they can see.
        return visible.withColumn("_target", F.when(F.col("_visible"), true(condition)).otherwise(False))

    def _check(self, table: str, rows: DataFrame, operation: str, user: User) -> None:
        bound = self._binding(table, BLOCK, operation)
        if bound is None:
            return
        granted = self.predicates[bound.predicate].grant(user)
        marked = _marked(rows.select(bound.column), granted, bound.column, "_may")
        if not marked.where(~F.col("_may")).isEmpty():
            raise BlockedError(f"{user.name} may not write these rows of {table} ({operation})")

    # Inventory

    def inventory(self, spark: SparkSession) -> DataFrame:
        rows = [
            (b.policy, self.policies[b.policy], b.predicate, b.column, b.kind, b.operation, b.table)
            for b in self.bindings
        ]
        return spark.createDataFrame(
            rows,
            "policy STRING, is_enabled BOOLEAN, predicate STRING, column STRING, "
            "predicate_type STRING, operation STRING, table STRING",
        )

    def visible_counts(self, table: str, df: DataFrame, users: Iterable[User]) -> DataFrame:
        """Rows each user sees, counted for all users in one pass over the table."""
        bound = self._binding(table, FILTER)
        counts = []
        for user in users:
            granted = Granted(everything=True) if bound is None else self.predicates[bound.predicate].grant(user)
            column = df.columns[0] if bound is None else bound.column
            if granted.held is not None and not granted.everything:
                df = _marked(df, granted, column, f"_sees_{len(counts)}")
                condition = F.col(f"_sees_{len(counts)}")
            else:
                condition = _literal_condition(granted, column)
            counts.append(F.count_if(true(condition)).alias(user.name))
        wide = df.agg(*counts)
        return wide.unpivot([], wide.columns, "user_name", "visible_rows")


def rows_per(df: DataFrame, owner: str) -> DataFrame:
    """Row count per owner, sorted by owner."""
    return df.groupBy(owner).agg(F.count(F.lit(1)).alias("total_rows")).orderBy(owner)
