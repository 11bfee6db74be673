"""Merge, routing and replay beyond the templates."""

import datetime as dt
import random
import re

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.hashing import row_hash
from tidemark.functions.moments import moment, open_end
from tidemark.operators.compare import assert_empty, assert_same_rows, table_diff
from tidemark.operators import load
from tidemark.operators import orphans as orphans_module
from tidemark.operators.load import replay_exceptions
from tidemark.operators.merge import merge_load
from tidemark.operators.orphans import orphans, route_orphans
from tidemark.spec import ForeignKey, TableSpec

NOW = dt.datetime(2024, 6, 1)
SPEC = TableSpec(keys=("a", "b"))


def versioned(df):
    return df.withColumns({"VersionStartTime": moment("2020-01-01"), "VersionEndTime": open_end()})


def random_rows(spark, seed, n=200):
    rng = random.Random(seed)
    keys = sorted({(rng.randrange(20), rng.choice("xyz")) for _ in range(n)})
    rows = [(a, b, rng.choice([None, 0.5, 1.5]), rng.choice([None, "", "v"])) for a, b in keys]
    return spark.createDataFrame(rows, "a INT, b STRING, c DOUBLE, d STRING")


def expected_merge(target, stage):
    old = {(r["a"], r["b"]): (r["c"], r["d"]) for r in target.collect()}
    new = {(r["a"], r["b"]): (r["c"], r["d"]) for r in stage.collect()}
    replaced = {k for k in new.keys() & old.keys() if new[k] != old[k]}
    return {**old, **new}, replaced


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("hashed", [True, False])
def test_merge_agrees_with_dictionaries(spark, small, hashed):
    for seed in range(3):
        plain, stage = random_rows(spark, seed, 40), random_rows(spark, seed + 100, 40)
        target = plain.withColumn("RowHash", row_hash(plain, ["c", "d"])) if hashed else plain
        result = merge_load(versioned(target), stage, SPEC, NOW, small)
        merged, replaced = expected_merge(plain, stage)
        assert {(r["a"], r["b"]): (r["c"], r["d"]) for r in result.current.collect()} == merged
        assert {(r["a"], r["b"]) for r in result.history_delta.collect()} == replaced
        for kind, df in (("current", result.current), ("history", result.history_delta)):
            assert_same_rows(df, result.images.where(F.col("kind") == kind).drop("kind"))


def test_merging_twice_changes_nothing_more(spark):
    target, stage = versioned(random_rows(spark, 1)), random_rows(spark, 2)
    once = merge_load(target, stage, SPEC, NOW).current
    twice = merge_load(once, stage, SPEC, NOW + dt.timedelta(days=1))
    assert_same_rows(once, twice.current)
    assert_empty(twice.history_delta)


@pytest.mark.parametrize("small", [True, False])
def test_null_hash_never_replaces(spark, small):
    target = versioned(spark.createDataFrame([(1, "x", 1.0, None)], "a INT, b STRING, c DOUBLE, RowHash STRING"))
    stage = spark.createDataFrame([(1, "x", 2.0), (2, "x", 3.0)], "a INT, b STRING, c DOUBLE")
    result = merge_load(target, stage, SPEC, NOW, small)
    assert sorted(r["c"] for r in result.current.collect()) == [1.0, 3.0]
    assert_empty(result.history_delta)


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("rows", [[(1, "x", 1.0, "v"), (1, "x", 2.0, "v")], [(None, "x", 1.0, "v")]])
def test_bad_stage_keys_fail(spark, small, rows):
    stage = spark.createDataFrame(rows, "a INT, b STRING, c DOUBLE, d STRING")
    # Two parts of the plan that fail at once come back as one bare Java error.
    with pytest.raises((PySparkException, Py4JJavaError), match="stage holds"):
        merge_load(versioned(random_rows(spark, 1)), stage, SPEC, NOW, small).current.collect()


@pytest.mark.parametrize("small", [True, False])
def test_null_keys_in_the_target_are_left_alone(spark, small):
    target = versioned(spark.createDataFrame([(None, "x", 1.0), (1, "x", 1.0)], "a INT, b STRING, c DOUBLE"))
    stage = spark.createDataFrame([(1, "x", 2.0), (2, "y", 3.0)], "a INT, b STRING, c DOUBLE")
    result = merge_load(target, stage, SPEC, NOW, small)
    assert sorted((str(r["a"]), r["c"]) for r in result.current.collect()) == [("1", 2.0), ("2", 3.0), ("None", 1.0)]
    assert result.history_delta.count() == 1


def test_stage_columns_must_match(spark):
    with pytest.raises(ValueError, match="do not match"):
        merge_load(versioned(random_rows(spark, 1)), random_rows(spark, 2).drop("d"), SPEC, NOW)


def test_hash_tells_nulls_and_borders_apart(spark):
    rows = [("a", None), ("a", ""), (None, "a"), ("", "a"), ("a", "~"), ("1:", "a"), ("", "1:a"), (None, None)]
    df = spark.createDataFrame(rows, "x STRING, y STRING")
    assert df.select(row_hash(df, ["x", "y"]).alias("h")).distinct().count() == len(rows)


def test_hash_sees_microseconds_in_any_zone(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00.000001",), ("2024-01-01 00:00:00.000002",)], "t STRING"
    ).select(F.col("t").cast("timestamp").alias("t"), F.col("t").cast("timestamp_ntz").alias("n"))
    hashes = [r[0] for r in df.select(row_hash(df, ["t"])).collect()]
    assert len(set(hashes)) == 2
    assert df.select(row_hash(df, ["n"])).distinct().count() == 2
    nested = df.select(F.struct("t").alias("s"))
    assert nested.select(row_hash(nested, ["s"])).distinct().count() == 2


def test_first_broken_key_is_reported_and_null_is_fine(spark):
    stage = spark.createDataFrame([(1, 9, 9), (2, 1, 9), (3, None, 1), (4, 1, None)], "id INT, p INT, q INT")
    parent = spark.createDataFrame([(1,)], "k INT")
    keys = [ForeignKey("q", parent, "k", "B"), ForeignKey("p", parent, "k", "A")]
    routed = route_orphans(stage, keys)
    assert {r["id"] for r in routed.clean.collect()} == {3, 4}
    assert {r["id"]: r["ErrorDescription"] for r in routed.exceptions.collect()} == {1: "Orphan p", 2: "Orphan q"}
    assert {r["id"] for r in orphans(stage, keys[0]).collect()} == {1, 2}
    dropped = route_orphans(stage, keys, routed.exceptions, emit=False)
    assert_same_rows(routed.exceptions, dropped.exceptions)


def _random_exceptions(spark, seed):
    rng = random.Random(seed)
    rows = []
    for key in range(30):
        for day in range(1, 6):
            if rng.random() < 0.7:
                row = (key, rng.randrange(6), rng.choice(["x", "y", None]), 1, dt.datetime(2024, 1, day))
                rows += [(*row, "Orphan parent_id")] * rng.choice([1, 1, 2])
                if rng.random() < 0.2:
                    rows.append((*row, "Bad value"))
    schema = (
        "id INT, parent_id INT, name STRING, ServerExecutionID BIGINT, DWLoadDate TIMESTAMP_NTZ, ErrorDescription STRING"
    )
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({"ErrorCode": F.lit(0), "ErrorColumn": F.lit(0)})


@pytest.mark.parametrize("hashed, small", [(True, True), (False, True), (False, False)])
def test_replay_in_one_pass_equals_date_by_date(spark, monkeypatch, hashed, small):
    """A plain loop over dates and dictionaries gives the same current, history and leftovers."""
    monkeypatch.setattr("tidemark.operators.load.fits_broadcast", lambda df: small)
    for seed in range(2):
        exceptions = _random_exceptions(spark, seed)
        start = exceptions.where(F.col("id") < 15).dropDuplicates(["id"]).drop(
            "ErrorCode", "ErrorColumn", "ErrorDescription"
        )
        target = start.withColumn("RowHash", row_hash(start, ["parent_id", "name"])) if hashed else start
        parents = spark.createDataFrame([(k,) for k in range(4)], "k INT")
        spec = TableSpec(keys=("id",), foreign_keys=(ForeignKey("parent_id", parents, "k", "Parent"),))
        result = replay_exceptions(versioned(target), exceptions, spec, 7, NOW)

        rows = exceptions.collect()
        current = {r["id"]: (r["parent_id"], r["name"]) for r in start.collect()}
        history, left = [], list(rows)
        due = [r for r in rows if r["ErrorDescription"].startswith("Orphan")]
        for date in sorted({r["DWLoadDate"] for r in due}):
            loaded = {r["id"]: (r["parent_id"], r["name"]) for r in due if r["DWLoadDate"] == date and r["parent_id"] < 4}
            for key, new in loaded.items():
                if key in current and current[key] != new:
                    history.append((key, *current[key]))
                current[key] = new
            left = [r for r in left if not (r["DWLoadDate"] == date and r["id"] in loaded)]
        assert {r["id"]: (r["parent_id"], r["name"]) for r in result.current.collect()} == current
        for kind, df in (("current", result.current), ("history", result.history_delta)):
            assert_same_rows(df, result.images.where(F.col("kind") == kind).drop("kind"))
        found = [(r["id"], r["parent_id"], r["name"]) for r in result.history_delta.collect()]
        assert sorted(found, key=str) == sorted(history, key=str)
        assert sorted(map(str, result.exceptions.select(*exceptions.columns).collect())) == sorted(map(str, left))


def test_replay_of_a_table_that_refers_to_itself(spark):
    """The second date's parent is loaded by the first."""
    rows = [
        (1, None, dt.datetime(2024, 1, 1)),
        (2, 1, dt.datetime(2024, 1, 2)),
        (3, 4, dt.datetime(2024, 1, 1)),
    ]
    exceptions = spark.createDataFrame(rows, "id INT, boss INT, DWLoadDate TIMESTAMP_NTZ").withColumns(
        {
            "ServerExecutionID": F.lit(1).cast("bigint"),
            "ErrorCode": F.lit(0),
            "ErrorColumn": F.lit(0),
            "ErrorDescription": F.lit("Orphan boss"),
        }
    )
    spec = TableSpec(keys=("id",), foreign_keys=(ForeignKey("boss", None, "id", "Self"),))
    target = versioned(exceptions.drop("ErrorCode", "ErrorColumn", "ErrorDescription").where(F.lit(False)))
    result = replay_exceptions(target, exceptions, spec, 3, NOW)
    assert sorted((r["id"], r["boss"]) for r in result.current.collect()) == [(1, None), (2, 1)]
    assert [r["id"] for r in result.exceptions.collect()] == [3]


def test_all_foreign_keys_are_found_in_one_pass(spark):
    """Three keys of different types: the stage is read once for their values and once to mark its rows."""
    rng = random.Random(4)
    rows = [(i, rng.choice([None, *range(8)]), rng.choice([None, "x", "y", "z"]), rng.choice([None, 0.5, 1.5, -0.0])) for i in range(200)]
    stage = spark.createDataFrame(rows, "id INT, a INT, b STRING, c DOUBLE")
    parents = {"a": [(n,) for n in range(5)] * 2, "b": [("x",), ("z",), (None,)], "c": [(0.5,), (0.0,)]}
    kinds = {"a": "BIGINT", "b": "STRING", "c": "DOUBLE"}
    keys = [ForeignKey(c, spark.createDataFrame(parents[c], f"p {kinds[c]}"), "p", name) for c, name in (("a", "Z"), ("b", "M"), ("c", "A"))]
    plans = []
    settled = orphans_module.settle

    def keep(df, label="step"):
        plans.append((label, spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")))
        return settled(df, label)

    orphans_module.settle = keep
    try:
        routed = route_orphans(stage, keys)
    finally:
        orphans_module.settle = settled
    known = {c: {p[0] for p in parents[c]} for c in parents}

    def first_broken(row):
        broken = [c for c in ("c", "b", "a") if row[c] is not None and row[c] not in known[c]]
        return f"Orphan {broken[0]}" if broken else None

    expected = {r["id"]: first_broken(r) for r in stage.collect()}
    assert {r["id"] for r in routed.clean.collect()} == {i for i, d in expected.items() if d is None}
    assert {r["id"]: r["ErrorDescription"] for r in routed.exceptions.collect()} == {i: d for i, d in expected.items() if d}
    assert [label for label, _ in plans] == ["values", "orphans", "stage"]
    scans = {label: len(re.findall(r"Scan ExistingRDD\[id#\d+,a#|LocalTableScan \[.*a#\d+, b#\d+, c#", plan)) for label, plan in plans}
    assert scans["orphans"] == 0 and scans["values"] <= 1 and scans["stage"] <= 1
    values = next(plan for label, plan in plans if label == "values")
    assert values.count("Exchange") == 1 and "Join" not in values


def self_referring(spark, seed, dates=6):
    """Rows with a boss and a deputy in the same table, cycles, unknown and late parents, and an outer key."""
    rng = random.Random(seed)
    day = dt.datetime(2024, 1, 1)

    def person(i):
        return (i, rng.choice([None, *range(30)]), rng.choice([None, None, *range(30)]), rng.choice([1, 1, 1, 2, None]), rng.choice("xy"))

    known = [person(i) for i in rng.sample(range(30), 6)]
    late = {(r[0], r[5]): r for r in ((*person(rng.randrange(30)), day + dt.timedelta(days=rng.randrange(dates))) for _ in range(70))}
    late = list(late.values())
    columns = "id INT, boss INT, deputy INT, unit INT, name STRING"
    target = versioned(spark.createDataFrame([(*r, 0, day) for r in known], f"{columns}, ServerExecutionID BIGINT, DWLoadDate TIMESTAMP_NTZ"))
    exceptions = spark.createDataFrame(late + late[:5], f"{columns}, DWLoadDate TIMESTAMP_NTZ").withColumns(
        {
            "ServerExecutionID": F.lit(1).cast("bigint"),
            "ErrorCode": F.lit(0),
            "ErrorColumn": F.lit(0),
            "ErrorDescription": F.when(F.col("id") == 29, "Something else").otherwise("Orphan boss"),
        }
    )
    units = spark.createDataFrame([(1,)], "unit INT")
    keys = (
        ForeignKey("boss", None, "id", "Self"),
        ForeignKey("deputy", None, "id", "Self"),
        ForeignKey("unit", units, "unit", "Unit"),
    )
    return target, exceptions, TableSpec(keys=("id",), foreign_keys=keys)


@pytest.mark.parametrize("seed", range(3))
def test_replay_of_self_references_equals_one_load_per_date(spark, seed):
    target, exceptions, spec = self_referring(spark, seed)
    pending = exceptions.where("ErrorDescription LIKE 'Orphan%'").drop("ErrorCode", "ErrorColumn", "ErrorDescription", "ServerExecutionID")
    dates = [r[0] for r in pending.select(F.col("DWLoadDate").cast("string")).distinct().orderBy(F.col("DWLoadDate")).collect()]
    expected = load._replay_by_date(target, exceptions, pending, dates, spec, 5, NOW)
    for small in (True, False):
        result = replay_exceptions(target, exceptions, spec, 5, NOW, small)
        assert_same_rows(expected.current, result.current.select(expected.current.columns))
        assert_same_rows(expected.history_delta, result.history_delta.select(expected.history_delta.columns))
        assert_same_rows(expected.exceptions, result.exceptions.select(expected.exceptions.columns))
    assert result.current.count() > target.count()


def test_rounds_follow_generations_and_not_load_dates(spark, monkeypatch):
    """Two generations over forty load dates: the target's rows are joined once, whatever the dates."""
    day = dt.datetime(2024, 1, 1)
    rows = [(i, None if i < 40 else i - 40, day + dt.timedelta(days=i % 40 if i < 40 else 50)) for i in range(80)]
    exceptions = spark.createDataFrame(rows, "id INT, boss INT, DWLoadDate TIMESTAMP_NTZ").withColumns(
        {"ServerExecutionID": F.lit(1).cast("bigint"), "ErrorCode": F.lit(0), "ErrorColumn": F.lit(0), "ErrorDescription": F.lit("Orphan boss")}
    )
    target = versioned(exceptions.drop("ErrorCode", "ErrorColumn", "ErrorDescription").where("id < 0"))
    steps = []
    settled = load.settle
    monkeypatch.setattr(load, "settle", lambda df, label="step": steps.append(label) or settled(df, label))
    monkeypatch.setattr(load, "merge_load", None)
    spec = TableSpec(keys=("id",), foreign_keys=(ForeignKey("boss", None, "id", "Self"),))
    result = replay_exceptions(target, exceptions, spec, 3, NOW)
    assert result.current.count() == 80 and result.exceptions.count() == 0
    assert len(steps) <= 16


def test_load_dates_an_hour_apart_that_look_alike(spark):
    """Zoned load dates in the hour a clock is set back."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    exceptions = spark.createDataFrame([(1, "old", 1730007000), (1, "new", 1730010600)], "id INT, name STRING, s BIGINT")
    exceptions = exceptions.select(
        "id",
        "name",
        F.timestamp_seconds("s").alias("DWLoadDate"),
        F.lit(1).cast("bigint").alias("ServerExecutionID"),
        F.lit(0).alias("ErrorCode"),
        F.lit(0).alias("ErrorColumn"),
        F.lit("Orphan x").alias("ErrorDescription"),
    )
    target = versioned(exceptions.drop("ErrorCode", "ErrorColumn", "ErrorDescription").where(F.lit(False)))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        result = replay_exceptions(target, exceptions, TableSpec(keys=("id",)), 2, NOW)
        assert [r["name"] for r in result.current.collect()] == ["new"]
        assert [r["name"] for r in result.history_delta.collect()] == ["old"]
        assert_empty(result.exceptions)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_replay_refuses_two_rows_of_one_key_and_date(spark):
    exceptions = _random_exceptions(spark, 1).where(F.col("id") == 1).limit(1)
    double = exceptions.unionByName(exceptions.withColumn("name", F.lit("other")))
    parents = spark.createDataFrame([(k,) for k in range(6)], "k INT")
    spec = TableSpec(keys=("id",), foreign_keys=(ForeignKey("parent_id", parents, "k", "Parent"),))
    target = versioned(double.drop("ErrorCode", "ErrorColumn", "ErrorDescription").where(F.lit(False)))
    with pytest.raises(PySparkException, match="one load date holds one key twice"):
        replay_exceptions(target, double, spec, 1, NOW)


def test_table_diff_counts_copies(spark):
    expected = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a INT, b STRING")
    actual = spark.createDataFrame([(1, None), (3, "y")], "a INT, b STRING")
    found = {(r["a"], r["side"]): r["copies"] for r in table_diff(expected, actual).collect()}
    assert found == {(1, "expected"): 1, (2, "expected"): 1, (3, "actual"): 1}
    with pytest.raises(AssertionError, match="tables differ"):
        assert_same_rows(expected, actual)
