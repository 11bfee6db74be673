"""Stored tables: partitions that loads touch, loads that died, and time travel that reads only some days."""

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions.moments import moment, open_end
from tidemark.operators.compare import assert_same_rows
from tidemark.operators.merge import merge_load
from tidemark.sources.stored import StoredTable
from tidemark.spec import TableSpec

NOW = dt.datetime(2024, 6, 1)
DAY = dt.timedelta(days=1)


def rows_of(spark, seed, n=120):
    rng = random.Random(seed)
    rows = [(k, rng.choice(["a", "b", "c", None]), rng.choice([None, 1.5, 2.5])) for k in sorted({rng.randrange(150) for _ in range(n)})]
    return spark.createDataFrame(rows, "id INT, area STRING, value DOUBLE")


def versioned(df):
    return df.withColumns({"VersionStartTime": moment("2020-01-01"), "VersionEndTime": open_end()})


def files_of(root):
    return {
        os.path.relpath(os.path.join(d, f), root): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(root)
        for f in names
        if f.endswith(".parquet")
    }


@pytest.mark.parametrize("partition_by", [(), ("area",), ("area", "value")])
def test_loads_equal_merges_in_memory(spark, tmp_path, partition_by):
    """Rows move between partitions, NULL is one of them, and partitions that all rows leave go."""
    spec = TableSpec(keys=("id",), partition_by=partition_by)
    current = versioned(rows_of(spark, 1))
    table = StoredTable.create(current, f"{tmp_path}/t", spec)
    history = current.where(F.lit(False))
    for load in range(1, 4):
        stage, now = rows_of(spark, 10 + load, 40), NOW + load * DAY
        merged = merge_load(current, stage, spec, now)
        history = history.unionByName(merged.history_delta)
        current = merged.current
        table.merge(stage, now, load)
        assert_same_rows(current, table.current())
        assert_same_rows(history, table.history().drop("load", "ended"))
    table.merge(rows_of(spark, 77), NOW, 3)  # a load that is done already
    assert_same_rows(current, table.current())
    gone = table.current().select("id", F.lit("elsewhere").alias("area"), F.lit(9.5).alias("value"))
    table.merge(gone, NOW + 9 * DAY, 9)
    assert {r["area"] for r in table.current().select("area").distinct().collect()} == {"elsewhere"}
    assert table.current().count() == current.count()
    assert not os.listdir(f"{tmp_path}/t/incoming")


def test_untouched_partitions_are_neither_read_nor_written(spark, tmp_path):
    spec = TableSpec(keys=("id", "area"), partition_by=("area",))
    df = spark.range(300).select(F.col("id").cast("int"), F.concat(F.lit("p"), F.col("id") % 6).alias("area"), F.lit(1.0).alias("value"))
    table = StoredTable.create(versioned(df), f"{tmp_path}/t", spec)
    before = files_of(f"{tmp_path}/t/current")
    stage = df.where("area = 'p2' AND id < 100").withColumn("value", F.lit(2.0))
    touched = table.touched(stage)
    plan = spark._jvm.PythonSQLUtils.explainString(table.current().where(touched)._jdf.queryExecution(), "formatted")
    assert re.search(r"PartitionFilters: \[.*area#\d+ = p2|PartitionFilters: \[.*area#\d+ IN \(p2\)", plan)
    table.merge(stage, NOW, 1)
    after = files_of(f"{tmp_path}/t/current")
    kept = {f: t for f, t in before.items() if "area=p2" not in f}
    assert kept and all(after[f] == t for f, t in kept.items())
    assert not {f for f in before if "area=p2" in f} & set(after)
    assert table.current().where("value = 2").count() == stage.count() == table.history().count()


@pytest.mark.parametrize("dies", ["before", "between"])
def test_a_load_that_died_goes_on(spark, tmp_path, monkeypatch, dies):
    spec = TableSpec(keys=("id",), partition_by=("area",))
    current, stage = versioned(rows_of(spark, 1)), rows_of(spark, 2)
    table = StoredTable.create(current, f"{tmp_path}/t", spec)
    merged = merge_load(current, stage, spec, NOW)
    expected = [sorted(map(str, df.collect())) for df in (merged.current, merged.history_delta)]
    with monkeypatch.context() as patch:
        if dies == "before":  # history is not complete
            patch.setattr(StoredTable, "_incoming", lambda *_: 1 / 0)
        else:  # nor is current
            patch.setattr(StoredTable, "_drop_empty", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.merge(stage, NOW, 1)
    again = StoredTable(spark, table.root, spec, table.schema)
    again.merge(stage, NOW, 1)
    assert [sorted(map(str, df.collect())) for df in (again.current(), again.history().drop("load", "ended"))] == expected


def test_time_travel_reads_only_days_that_matter(spark, tmp_path):
    spec = TableSpec(keys=("id",), partition_by=("area",))
    rows = rows_of(spark, 5)
    table = StoredTable.create(versioned(rows), f"{tmp_path}/t", spec)
    for load in range(1, 6):
        table.merge(rows.where(F.col("id") % load == 0).withColumn("value", F.lit(10.0 * load)), NOW + load * DAY, load)
    versions = table.versions()
    everything = versions.all_versions().collect()
    low, high = NOW + 2 * DAY, NOW + dt.timedelta(days=3, hours=7)
    start, end = "VersionStartTime", "VersionEndTime"
    for df, holds in (
        (versions.as_of(high), lambda r: r[start] <= high < r[end]),
        (versions.from_to(low, high), lambda r: r[start] < high and r[end] > low),
        (versions.between(low, high), lambda r: r[start] <= high and r[end] > low),
        (versions.contained_in(low, high), lambda r: r[start] >= low and r[end] <= high),
    ):
        assert sorted(map(str, df.collect())) == sorted(str(r) for r in everything if holds(r))
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        assert re.search(r"PartitionFilters: \[.*ended#\d+ >= ", plan)
