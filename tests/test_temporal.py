"""Versioned tables: changes, time travel, and what the versioning state refuses."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.moments import OPEN_END, moment, open_end
from tidemark.operators.compare import assert_empty, assert_same_rows
from tidemark.operators.temporal import ConsistencyError, TemporalTable, VersioningError, temporal_fk_gaps
from tidemark.spec import ForeignKey, TableSpec

OPEN = dt.datetime.fromisoformat(OPEN_END)


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def departments(spark):
    rows = [(1, "TestDepartment", 1), (2, "Sales", 2), (3, "Human Resources", 3)]
    df = spark.createDataFrame(rows, "DepartmentID INT, DepartmentName STRING, ManagerID INT")
    return TemporalTable.create(df, ["DepartmentID"], "2017-09-06")


def history_rows(spark, rows):
    return spark.createDataFrame(
        [(i, n, m, at(a), at(b)) for i, n, m, a, b in rows],
        "DepartmentID INT, DepartmentName STRING, ManagerID INT, RowStartDate TIMESTAMP_NTZ, RowEndDate TIMESTAMP_NTZ",
    )


def test_existing_rows_start_now(departments):
    rows = departments.current.collect()
    assert {(r["RowStartDate"], r["RowEndDate"]) for r in rows} == {(at("2017-09-06"), OPEN)}
    assert_empty(departments.history)
    assert departments.visible().columns == ["DepartmentID", "DepartmentName", "ManagerID"]


def test_start_from_a_column(spark):
    df = spark.createDataFrame([(1, at("2016-01-01"))], "id INT, since TIMESTAMP_NTZ")
    assert TemporalTable.create(df, ["id"], F.col("since")).current.first()["RowStartDate"] == at("2016-01-01")


SCHEMA = "DepartmentID INT, DepartmentName STRING, ManagerID INT"


def test_insert_refuses_keys_that_are_not_new(spark, departments):
    for keys, message in (([4, 4], "twice"), ([4, 1], "already"), ([4, None], "NULL")):
        rows = spark.createDataFrame([(k, "x", 1) for k in keys], SCHEMA)
        with pytest.raises(PySparkException, match=message):
            departments.insert(rows, "2018-01-01").current.collect()


def test_constraints_hold_while_rows_are_written(spark, departments, tmp_path):
    people = spark.createDataFrame([(1,), (2,), (2,), (3,)], "PersonID INT")
    keys = [ForeignKey("ManagerID", people, "PersonID", "Person"), ForeignKey("DepartmentID", None, "DepartmentID", "Department")]
    table = departments.constrained(["DepartmentName"], keys)
    for number, (row, message) in enumerate(
        [((4, "x", 9), "ManagerID has no parent in Person"), ((4, None, 1), "DepartmentName is NULL"), ((1, "x", 1), "already"), ((None, "x", 1), "DepartmentID is NULL")]
    ):
        new = table.insert(spark.createDataFrame([(5, "fine", 2), row], SCHEMA), "2018-01-01")
        with pytest.raises(PySparkException, match=message):
            new.current.write.parquet(f"{tmp_path}/{number}")
    grown = table.insert(spark.createDataFrame([(5, "fine", 2), (6, "no manager", None)], SCHEMA), "2018-01-01")
    assert grown.current.count() == 5
    # In force with versioning off too, and for changed values.
    with pytest.raises(PySparkException, match="no parent"):
        grown.versioning_off().update(F.col("DepartmentID") == 5, {"ManagerID": F.lit(77)}, "2018-02-01").current.collect()
    assert grown.update(F.col("DepartmentID") == 5, {"ManagerID": F.lit(3)}, "2018-02-01").current.where("ManagerID = 3").count() == 2
    with pytest.raises(ValueError, match="no \\['Colour'\\]"):
        table.constrained(["Colour"])


def test_insert_runs_no_job_and_takes_whole_rows(spark, departments):
    context = spark.sparkContext
    context.setJobGroup("insert", "insert")
    try:
        departments.insert(spark.createDataFrame([(4, "x", 1)], SCHEMA), "2018-01-01")
        assert list(context.statusTracker().getJobIdsForGroup("insert")) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    with pytest.raises(ValueError, match="the table"):
        departments.insert(spark.createDataFrame([(4, "x")], "DepartmentID INT, DepartmentName STRING"), "2018-01-01")


def test_a_new_row_may_be_the_parent_of_another(spark):
    df = spark.createDataFrame([(1, None)], "id INT, boss INT")
    table = TemporalTable.create(df, ["id"], "2020-01-01").constrained(foreign_keys=[ForeignKey("boss", None, "id", "Staff")])
    assert table.insert(spark.createDataFrame([(2, 3), (3, 1), (4, 4)], "id INT, boss INT"), "2021-01-01").current.count() == 4
    with pytest.raises(PySparkException, match="boss has no parent"):
        table.insert(spark.createDataFrame([(2, 3)], "id INT, boss INT"), "2021-01-01").current.collect()


def test_consistency_counts_keys_and_rows(spark, departments):
    rows = [(1, "a", 1, "2019-01-01", "2018-01-01"), (1, "b", 1, "2016-01-01", "2017-09-07"), (2, "c", 1, "2016-01-01", "2017-01-01"), (2, "d", 1, "2016-06-01", "2016-07-01")]
    current = departments.current.unionByName(departments.current.where("DepartmentID = 3"))
    current = current.withColumn("RowEndDate", F.when(F.col("DepartmentID") == 2, moment("2030-01-01")).otherwise(F.col("RowEndDate")))
    table = TemporalTable(current, history_rows(spark, rows), ("DepartmentID",), versioned=False)
    found = {r["rule"]: (r["keys"], r["rows"]) for r in table.consistency().collect()}
    assert found == {
        "ends before it starts": (1, 1),
        "overlaps an earlier version": (3, 3),
        "current row has ended": (1, 1),
        "several current rows": (1, 1),
    }
    clean = {r["keys"] for r in departments.consistency().collect()}
    assert clean == {0}


def test_reads_leave_out_versions_without_duration(spark, departments):
    now = "2018-01-01"
    rows = spark.createDataFrame([(4, "Paint Shop", 2)], "DepartmentID INT, DepartmentName STRING, ManagerID INT")
    table = departments.insert(rows, now).update(F.col("DepartmentID") == 4, {"ManagerID": F.lit(3)}, now)
    mine = F.col("DepartmentID") == 4
    assert table.all_versions().where(mine).count() == 1
    assert table.between("2017-01-01", "2019-01-01").where(mine).count() == 1
    assert table.contained_in("2017-01-01", "9999-12-31 23:59:59.999999").where(mine).count() == 1


def test_insert_generates_periods_and_refuses_given_ones(spark, departments):
    rows = spark.createDataFrame([(4, "Paint Shop", 2)], "DepartmentID INT, DepartmentName STRING, ManagerID INT")
    new = departments.insert(rows, "2018-01-01").current.where(F.col("DepartmentID") == 4).first()
    assert (new["RowStartDate"], new["RowEndDate"]) == (at("2018-01-01"), OPEN)
    with pytest.raises(VersioningError):
        departments.insert(rows.withColumn("RowStartDate", moment("1900-01-01")), "2018-01-01")
    with pytest.raises(VersioningError):
        departments.update(F.lit(True), {"RowEndDate": open_end()}, "2018-01-01")


def test_update_makes_a_version_even_without_a_difference(departments):
    same = departments.update(F.col("DepartmentID") == 2, {"DepartmentName": F.lit("Sales")}, "2018-01-01")
    versions = sorted((r["RowStartDate"], r["RowEndDate"]) for r in same.all_versions().where("DepartmentID = 2").collect())
    assert versions == [(at("2017-09-06"), at("2018-01-01")), (at("2018-01-01"), OPEN)]
    assert departments.current.count() == same.current.count() == 3


def test_condition_is_read_before_the_change(departments):
    new = departments.update(F.col("DepartmentName") == "Sales", {"DepartmentName": F.lit("Trade")}, "2018-01-01")
    assert [r["DepartmentName"] for r in new.history.collect()] == ["Sales"]
    assert new.current.where("DepartmentName = 'Trade'").count() == 1


def test_delete_moves_to_history(departments):
    gone = departments.delete(F.col("DepartmentID") == 1, "2018-01-01")
    assert gone.current.count() == 2
    assert gone.history.first()["RowEndDate"] == at("2018-01-01")
    assert gone.all_versions().count() == 3


def test_merge_fills_history_only_for_changed_rows(spark, departments):
    stage = spark.createDataFrame(
        [(1, "DepartmentTest", 1), (2, "Sales", 2), (9, "New", 9)], "DepartmentID INT, DepartmentName STRING, ManagerID INT"
    )
    merged = departments.merge(stage, TableSpec(keys=("DepartmentID",)), "2018-01-01")
    assert [r["DepartmentName"] for r in merged.history.collect()] == ["TestDepartment"]
    assert merged.current.count() == 4
    assert_empty(merged.check_overlaps())


def test_boundaries(spark, departments):
    table = TemporalTable(
        departments.current.where("DepartmentID = 2"),
        history_rows(spark, [(2, "Sales", 2, "2005-01-01", "2010-01-01"), (2, "Sales", 3, "2010-01-01", "2017-09-06")]),
        ("DepartmentID",),
    )

    def managers(df):
        return sorted((r["ManagerID"], r["RowStartDate"].year) for r in df.collect())

    assert managers(table.as_of("2010-01-01")) == [(3, 2010)]
    assert managers(table.as_of("2004-12-31")) == []
    assert managers(table.from_to("2010-01-01", "2017-09-06")) == [(3, 2010)]
    assert managers(table.between("2010-01-01", "2017-09-06")) == [(2, 2017), (3, 2010)]
    assert managers(table.contained_in("2005-01-01", "2010-01-01")) == [(2, 2005)]
    assert managers(table.contained_in("2005-01-02", "2017-09-06")) == [(3, 2010)]


def test_versioning_refuses_manual_loads_and_destruction(spark, departments):
    rows = history_rows(spark, [(1, "Sales", 2, "2005-01-01", "2017-09-06")])
    for action in (
        lambda: departments.load_history(rows),
        lambda: departments.load_current(rows),
        departments.truncate,
        departments.drop,
        lambda: departments.add_history_constraint("ck_RowStartDate"),
        lambda: departments.drop_column("DepartmentID"),
    ):
        with pytest.raises(VersioningError):
            action()
    off = departments.versioning_off()
    assert_empty(off.truncate().current)
    assert_same_rows(off.history, off.drop())
    constrained = off.add_history_constraint("ck_RowStartDate")
    with pytest.raises(VersioningError):
        constrained.versioning_on()
    assert constrained.drop_history_constraint("ck_RowStartDate").versioning_on().versioned


def test_back_dated_current_row(spark, departments):
    row = history_rows(spark, [(4, "Information Technology", 5, "2006-01-01", "2006-01-02")]).drop("RowEndDate")
    table = departments.versioning_off().load_current(row).versioning_on()
    new = table.current.where("DepartmentID = 4").first()
    assert (new["RowStartDate"], new["RowEndDate"]) == (at("2006-01-01"), OPEN)


@pytest.mark.parametrize(
    "rows, fits",
    [
        ([(1, "Sales", 2, "2017-09-05", "2017-01-05")], False),
        ([(2, "Sales", 2, "2005-01-01", "2017-09-05")], True),
        ([(2, "Sales", 2, "2005-01-01", "2017-09-06")], True),
        ([(3, "Maintenance", 20, "2005-01-01", "2012-12-31")], True),
        ([(4, "IT", 5, "2001-01-01", "2006-01-01"), (4, "IT", 10, "2005-12-31", "2008-10-01")], False),
        ([(4, "IT", 5, "2001-01-01", "2009-01-01"), (4, "IT", 10, "2002-12-31", "2003-10-01")], False),
        ([(1, "Maintenance", 5, "2017-09-05", "2017-09-26 14:57:49.605747")], False),
    ],
)
def test_consistency_of_history(spark, departments, rows, fits):
    table = departments.versioning_off().load_history(history_rows(spark, rows))
    if fits:
        assert table.versioning_on().versioned
    else:
        with pytest.raises(ConsistencyError):
            table.versioning_on()


def test_schema_of_the_pair(departments):
    added = departments.add_column("PayrollID", "int")
    assert "PayrollID" in added.current.columns and "PayrollID" in added.history.columns
    assert added.drop_column("PayrollID").history.columns == departments.history.columns
    off = departments.versioning_off()
    with pytest.raises(ConsistencyError, match="columns"):
        off.add_column("PayrollID", "int").versioning_on()
    for other in (F.lit(None).cast("int").alias("PayID"), F.lit(None).cast("string").alias("PayrollID")):
        pair = TemporalTable(
            off.current.withColumn("PayrollID", F.lit(None).cast("int")), off.history.select("*", other), off.key, versioned=False
        )
        with pytest.raises(ConsistencyError, match="column (names|types) differ"):
            pair.versioning_on()


def test_join_of_current_versions(spark, departments):
    employees = TemporalTable.create(
        spark.createDataFrame([(1, "Roger", 1)], "EmployeeID INT, FirstName STRING, Dept INT"), ["EmployeeID"], "2016-01-01"
    )
    row = employees.join_current(departments, F.col("Dept") == F.col("DepartmentID"), ("e_", "d_")).first()
    assert (row["e_RowStartDate"], row["d_RowStartDate"]) == (at("2016-01-01"), at("2017-09-06"))


@pytest.mark.parametrize("hot_rows", [10_000, 5])
def test_foreign_key_gaps_against_brute_force(spark, hot_rows):
    rng = random.Random(4)
    day = dt.timedelta(days=1)
    zero = at("2020-01-01")
    parents, children = [], []
    for key in range(4):
        t = zero + rng.randrange(5) * day
        for _ in range(rng.randrange(1, 8)):
            end = t + rng.randrange(1, 6) * day
            parents.append((key, t, end))
            t = end + rng.choice([0, 0, 2]) * day
    for number in range(150):
        start = zero + rng.randrange(30) * day
        children.append((number, rng.choice([0, 1, 2, 3, 9, None]), start, start + rng.randrange(1, 9) * day))
    p = spark.createDataFrame(parents, "pk INT, RowStartDate TIMESTAMP_NTZ, RowEndDate TIMESTAMP_NTZ")
    c = spark.createDataFrame(children, "id INT, fk INT, RowStartDate TIMESTAMP_NTZ, RowEndDate TIMESTAMP_NTZ")
    nothing = F.lit(False)
    parent = TemporalTable(p.where(nothing), p, ("pk",))
    child = TemporalTable(c, c.where(nothing), ("id",))
    found = {r["id"] for r in temporal_fk_gaps(child, parent, "fk", "pk", hot_rows).collect()}

    def covered(key, start, end):
        moments = [start + n * day for n in range((end - start).days)]
        return all(any(k == key and s <= m < e for k, s, e in parents) for m in moments)

    assert found == {i for i, key, s, e in children if key is not None and not covered(key, s, e)}


def test_versions_never_overlap_after_random_changes(spark):
    rng = random.Random(7)
    table = TemporalTable.create(spark.createDataFrame([(i, 0) for i in range(5)], "id INT, v INT"), ["id"], "2020-01-01")
    for step in range(6):
        now = at("2021-01-01") + dt.timedelta(days=step)
        chosen = F.col("id") == rng.randrange(5)
        kind = rng.choice(["update", "delete", "merge"])
        if kind == "update":
            table = table.update(chosen, {"v": F.col("v") + 1}, now)
        elif kind == "delete":
            table = table.delete(chosen, now)
        else:
            table = table.merge(spark.createDataFrame([(rng.randrange(5), step)], "id INT, v INT"), TableSpec(keys=("id",)), now)
    assert_empty(table.check_overlaps())
    assert_empty(table.check_periods())
    assert table.current.select("id").distinct().count() == table.current.count()
