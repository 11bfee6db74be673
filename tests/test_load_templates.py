"""The twenty load expectations: what one fixture row does to current, history and exceptions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import row_hash
from tidemark.functions.moments import moment, open_end
from tidemark.operators.compare import assert_empty, assert_same_rows
from tidemark.operators.fixtures import fixture_rows, parent_rows, perturb
from tidemark.operators.load import replay_exceptions, run_load
from tidemark.spec import ERROR_COLUMNS, ForeignKey, TableSpec

NOW = dt.datetime(2024, 6, 1, 12)
DAY = dt.timedelta(days=1)

STAGE = (
    T.StructType()
    .add("id", T.IntegerType())
    .add("parent_id", T.IntegerType())
    .add("other_id", T.IntegerType())
    .add("name", T.StringType())
    .add("amount", T.DecimalType(18, 10))
    .add("Created", T.TimestampNTZType())
    .add("LastModified", T.TimestampNTZType())
    .add("Deleted", T.BooleanType())
    .add("ServerExecutionID", T.LongType())
    .add("DWLoadDate", T.TimestampNTZType())
)
PARENTS = {
    "Parent": T.StructType().add("parent_id", T.IntegerType()).add("name", T.StringType()),
    "Other": T.StructType().add("other_id", T.IntegerType()).add("name", T.StringType()),
}
KEYS = (("parent_id", "Parent"), ("other_id", "Other"))


@pytest.fixture(params=[False, True], ids=["compared", "hashed"])
def hashed(request):
    return request.param


class Load:
    """A target, a stage and parents to load with."""

    def __init__(self, spark, hashed, leave_out=None):
        self.spark, self.hashed = spark, hashed
        self.base = fixture_rows(spark, STAGE, 1, NOW)
        keys = [ForeignKey(c, None, c, name) for c, name in KEYS]
        parents = parent_rows(self.base, keys, PARENTS, NOW, leave_out)
        self.spec = TableSpec(
            keys=("id",), foreign_keys=tuple(ForeignKey(c, parents[name], c, name) for c, name in KEYS)
        )

    def target(self, rows):
        out = rows
        if self.hashed:
            out = out.withColumn("RowHash", row_hash(out, self.spec.hash_scope(out.columns)))
        return out.withColumns({"VersionStartTime": moment("2020-01-01"), "VersionEndTime": open_end()})

    def empty(self):
        return self.target(self.base.where(F.lit(False)))

    def exceptions(self, rows, description="Orphan parent_id"):
        return rows.withColumns(dict(zip(ERROR_COLUMNS, (F.lit(0), F.lit(0), F.lit(description)))))

    def visible(self, df):
        return df.drop("RowHash", "VersionStartTime", "VersionEndTime")

    def run(self, target, stage):
        return run_load(target, stage, None, self.spec, NOW)

    def replay(self, target, exceptions):
        return replay_exceptions(target, exceptions, self.spec, 5, NOW)


def test_insert(spark, hashed):
    load = Load(spark, hashed)
    result = load.run(load.empty(), load.base)
    assert_same_rows(load.base, load.visible(result.current))
    assert_empty(result.history_delta)
    assert_empty(result.exceptions)


@pytest.mark.parametrize("column, parent", KEYS)
def test_missing_parent(spark, hashed, column, parent):
    load = Load(spark, hashed, leave_out=parent)
    result = load.run(load.empty(), load.base)
    assert_empty(result.current)
    assert_empty(result.history_delta)
    assert_same_rows(load.exceptions(load.base, f"Orphan {column}"), result.exceptions)


def test_changed_row(spark, hashed):
    load = Load(spark, hashed)
    before = load.target(load.base)
    # Parents are keyed by the unchanged values, so the changed column must be no foreign key.
    changed = load.base.withColumn("name", F.lit("B"))
    result = load.run(before, changed)
    assert_same_rows(changed, load.visible(result.current))
    assert result.current.first()["VersionStartTime"] == NOW
    assert_same_rows(load.base, load.visible(result.history_delta))
    assert result.history_delta.first()["VersionEndTime"] == NOW
    assert_empty(result.exceptions)
    if hashed:
        assert result.current.first()["RowHash"] != before.first()["RowHash"]


def test_perturbed_column_is_versioned(spark, hashed):
    spec = TableSpec(keys=("id", "parent_id", "other_id"))
    changed = perturb(fixture_rows(spark, STAGE, 1, NOW), spec, NOW)
    assert changed.first()["name"] == "B"


def test_only_unversioned_columns_changed(spark, hashed):
    load = Load(spark, hashed)
    changed = perturb(load.base, load.spec, NOW, versioned=False)
    assert changed.first()["Created"] == NOW + DAY
    result = load.run(load.target(load.base), changed)
    assert_same_rows(load.base, load.visible(result.current))
    assert_empty(result.history_delta)
    assert_empty(result.exceptions)


def test_replay_loads_and_clears(spark, hashed):
    load = Load(spark, hashed)
    result = load.replay(load.empty(), load.exceptions(load.base))
    loaded = load.visible(result.current).drop("ServerExecutionID", "DWLoadDate")
    assert_same_rows(load.base.drop("ServerExecutionID", "DWLoadDate"), loaded)
    assert result.current.first()["ServerExecutionID"] == 5
    assert result.current.first()["DWLoadDate"] == NOW
    assert_empty(result.exceptions)


def test_replay_of_two_dates(spark, hashed):
    load = Load(spark, hashed)
    older = load.exceptions(load.base)
    newer = load.exceptions(load.base.withColumns({"name": F.lit("B"), "DWLoadDate": moment(NOW + DAY)}))
    result = load.replay(load.empty(), newer.unionByName(older))
    assert [r["name"] for r in result.current.collect()] == ["B"]
    assert [r["name"] for r in result.history_delta.collect()] == ["A"]
    assert result.current.first()["VersionStartTime"] == result.history_delta.first()["VersionEndTime"]
    assert_empty(result.exceptions)


def test_replay_ignores_stage(spark, hashed):
    """Only exceptions are replayed; a row with another description is none of them."""
    load = Load(spark, hashed)
    staged = load.base.withColumn("id", F.lit(2))
    result = load.replay(load.empty(), load.exceptions(load.base).unionByName(load.exceptions(staged, "Bad value")))
    assert [r["id"] for r in result.current.collect()] == [1]
    assert [r["id"] for r in result.exceptions.collect()] == [2]


def test_still_an_orphan(spark, hashed):
    load = Load(spark, hashed, leave_out="Parent")
    exceptions = load.exceptions(load.base)
    result = load.replay(load.empty(), exceptions)
    assert_empty(result.current)
    assert_empty(result.history_delta)
    assert_same_rows(exceptions, result.exceptions)
