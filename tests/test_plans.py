"""What the plans must look like at any size: what is shuffled, pushed down and read."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.durable import new_run_folder, scratch, settle
from tidemark.functions.moments import moment, open_end
from tidemark.operators import security as sec
from tidemark.operators.compare import assert_same_rows
from tidemark.operators.load import run_load
from tidemark.operators.merge import merge_load
from tidemark.operators.orphans import route_orphans
from tidemark.operators.temporal import TemporalTable
from tidemark.operators.watermark import since
from tidemark.sources.tables import read_table
from tidemark.sizing import fits_broadcast, planned_bytes
from tidemark.spec import ForeignKey, TableSpec


def plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def exchanges(text):
    return re.findall(r"^\(\d+\) Exchange", text, flags=re.M)


@pytest.fixture()
def orders(spark, folder):
    return read_table(spark, folder, "orders")


def target_of(orders):
    return orders.withColumns({"VersionStartTime": moment("2020-01-01"), "VersionEndTime": open_end()})


def test_small_stage_does_not_shuffle_the_target(orders):
    stage = orders.where(F.col("o_orderstatus") == "F")
    text = plan(merge_load(target_of(orders), stage, TableSpec(keys=("o_orderkey",)), "2024-01-01", True).current)
    assert "SortMergeJoin" not in text
    # Only the stage itself, once per use, for its key check.
    hashed = re.findall(r"^\(\d+\) Exchange.*?\n\n", text, flags=re.M | re.S)
    assert hashed and all("_staged_o_orderkey" in e for e in hashed)


def test_the_shape_follows_the_estimated_size(spark, orders):
    assert planned_bytes(spark.range(5)) == 40
    assert fits_broadcast(orders)
    spec = TableSpec(keys=("o_orderkey",))
    assert "FullOuter" not in plan(merge_load(target_of(orders), orders, spec, "2024-01-01").current)
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "FullOuter" in plan(merge_load(target_of(orders), orders, spec, "2024-01-01").current)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def test_a_checked_small_stage_is_still_small(spark, folder, orders):
    """After the joins that look for orphans, the rest of a small stage is broadcast to the target."""
    customer = ForeignKey("o_custkey", read_table(spark, folder, "customer"), "c_custkey", "customer")
    spec = TableSpec(keys=("o_orderkey",), foreign_keys=(customer,))
    text = plan(run_load(target_of(orders), orders, None, spec, "2024-01-01").current)
    assert "FullOuter" not in text and "SortMergeJoin" not in text


def test_large_stage_shuffles_each_side_once(orders):
    text = plan(merge_load(target_of(orders), orders, TableSpec(keys=("o_orderkey",)), "2024-01-01", False).current)
    assert len(exchanges(text)) == 2
    assert "FullOuter" in text


def test_stored_hash_is_not_computed_again(spark, orders):
    target = target_of(orders).withColumn("RowHash", F.lit("x"))
    text = plan(merge_load(target, orders, TableSpec(keys=("o_orderkey",)), "2024-01-01", False).current)
    assert text.count("sha2") == 1 or len(set(re.findall(r"sha2\([^#]*#\d+", text))) == 1
    assert "sha2" not in plan(merge_load(target_of(orders), orders, TableSpec(keys=("o_orderkey",)), "2024-01-01").current)


def test_policy_reaches_the_scan(orders):
    seen = sec.permitted(orders, sec.by_case({"u": "1-URGENT"}), "o_orderpriority", sec.User.of("U"))
    text = plan(seen.select("o_orderkey"))
    assert "EqualTo(o_orderpriority,1-URGENT)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in text
    assert not exchanges(text)
    hidden = plan(sec.permitted(orders, sec.by_case({"u": "1-URGENT"}), "o_orderpriority", sec.User.of("v")))
    assert "Scan parquet" not in hidden


def test_time_travel_and_slices_reach_the_scan(spark, orders):
    rows = orders.select("o_orderkey", F.col("o_orderdate").alias("RowStartDate"), open_end().alias("RowEndDate"))
    table = TemporalTable(rows, rows, ("o_orderkey",))
    text = plan(table.as_of("1998-01-01"))
    assert text.count("LessThanOrEqual(o_orderdate,1998-01-01T00:00)") == 2
    assert not exchanges(text)
    assert "GreaterThanOrEqual(o_orderdate,2000-06-01T00:00)" in plan(since(orders, "o_orderdate", "2000-06-01"))


def test_versioned_changes_do_not_shuffle(orders):
    table = TemporalTable.create(orders, ["o_orderkey"], "2020-01-01")
    table = table.update(F.col("o_orderstatus") == "F", {"o_totalprice": F.lit(0.0)}, "2021-01-01")
    table = table.delete(F.col("o_orderstatus") == "P", "2022-01-01")
    assert not exchanges(plan(table.all_versions()))


def test_hot_values_of_a_shuffled_check_are_split(spark):
    """With too many orphan values to broadcast, one value on half of all rows, and NULL on a quarter."""
    number = F.col("id")
    value = F.when(number % 2 == 0, 7).when(number % 4 == 1, F.lit(None)).otherwise(number)
    stage = settle(spark.range(400_000).select(number, value.cast("bigint").alias("fk"), F.sha2(number.cast("string"), 256).alias("text")))
    parents = spark.range(1000).select(number.alias("p"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, setting in settings.items():
        spark.conf.set(name, setting)
    try:
        clean = route_orphans(stage, [ForeignKey("fk", parents, "p", "Parent")], emit=False).clean
        assert len(clean.select("id", "text").collect()) == 300_000 + 250
        clean = clean.select("id", "text", "fk")
        clean.collect()
        assert "skew=true" in clean._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, setting in before.items():
            spark.conf.unset(name) if setting is None else spark.conf.set(name, setting)


def test_a_large_replay_shuffles_the_target_once(spark, folder):
    from tidemark.plans.loads import replay_orders

    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(replay_orders(spark, folder).images)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    # The target is one scan of orders, the versions one of what was settled.
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, flags=re.M)) == 2
    assert len(exchanges(text)) == 1 and "SortMergeJoin" not in text


def test_scratch_folders_go_with_their_scope(spark, tmp_path):
    kept = settle(spark.range(3))
    with scratch(spark):
        settled = settle(spark.range(5))
        settled.write.parquet(f"{tmp_path}/wanted")
        folder = new_run_folder(spark, "more")
        spark.range(2).write.parquet(folder)
    assert spark.read.parquet(f"{tmp_path}/wanted").count() == 5 and kept.count() == 3
    for gone in (folder, settled.inputFiles()[0] if settled.inputFiles() else folder):
        with pytest.raises(Exception, match="(?i)path|file"):
            spark.read.parquet(gone).count()


def test_a_held_lookup_prunes_by_the_bounds_of_its_values(spark, orders):
    """More values than literals: the smallest and the largest reach the scan, the caller's condition does not."""
    access = spark.range(40, 60).select(F.lit("ann").alias("who"), F.col("id").alias("customer"))
    seen = sec.permitted(orders, sec.by_lookup(access, "who", "customer", max_literals=3), "o_custkey", sec.User.of("Ann"))
    asked = seen.where("1 / (o_totalprice - 1) > 0")
    plan = spark._jvm.PythonSQLUtils.explainString(asked._jdf.queryExecution(), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan)[1]
    assert "GreaterThanOrEqual(o_custkey,40)" in pushed and "LessThanOrEqual(o_custkey,59)" in pushed
    assert "o_totalprice" not in pushed
    assert_same_rows(orders.where("o_custkey BETWEEN 40 AND 59"), seen)
    nobody = sec.permitted(orders, sec.by_lookup(access, "who", "customer", max_literals=3), "o_custkey", sec.User.of("Bob"))
    assert nobody.count() == 0
