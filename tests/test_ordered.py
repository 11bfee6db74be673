"""Windows over keys that hold most rows give the plain window's answer."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.ordered import next_value, numbered, running_max_before
from tidemark.operators.compare import assert_same_rows
from tidemark.operators.identity import assign_ids


@pytest.fixture(scope="module")
def skewed(spark):
    """One key has two thirds of all rows, one is NULL, and values may be NULL."""
    rng = random.Random(2)
    keys = [1] * 200 + [None] * 40 + [rng.randrange(2, 9) for _ in range(60)]
    rows = [(k, n, rng.choice([None, *range(50)])) for n, k in enumerate(rng.sample(keys, len(keys)))]
    return spark.createDataFrame(rows, "k INT, t INT, v INT")


def plain():
    return Window.partitionBy("k").orderBy("t")


@pytest.mark.parametrize("hot_rows", [1000, 50, 7])
def test_running_max_before(skewed, hot_rows):
    expected = skewed.withColumn("o", F.max("v").over(plain().rowsBetween(Window.unboundedPreceding, -1)))
    assert_same_rows(expected, running_max_before(skewed, ["k"], ["t"], "v", "o", hot_rows))


@pytest.mark.parametrize("hot_rows", [1000, 50, 7])
def test_numbered(skewed, hot_rows):
    expected = skewed.withColumn("o", F.row_number().over(plain()).cast("bigint"))
    assert_same_rows(expected, numbered(skewed, ["k"], ["t"], "o", hot_rows))


@pytest.mark.parametrize("hot_rows", [1000, 50, 7])
def test_next_value(skewed, hot_rows):
    expected = skewed.withColumn("o", F.lead("v").over(plain()))
    assert_same_rows(expected, next_value(skewed, ["k"], ["t"], "v", "o", hot_rows))


def test_dense_ids(spark, skewed):
    ids = assign_ids(skewed, ["v", "t"], "id", start=10, partitions=5)
    expected = skewed.withColumn("id", F.row_number().over(Window.orderBy("v", "t")).cast("bigint") + 9)
    assert_same_rows(expected, ids)


def test_dense_ids_of_equal_rows(spark):
    copies = spark.range(100).select(F.lit("same").alias("a"))
    ids = [r["id"] for r in assign_ids(copies, ["a"], "id", partitions=4).collect()]
    assert sorted(ids) == list(range(1, 101))
