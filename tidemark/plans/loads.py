"""Merge loads, orphan routing and exception replay over the order tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.durable import new_run_folder
from tidemark.functions.hashing import row_hash
from tidemark.functions.moments import moment, open_end
from tidemark.operators.compare import table_diff
from tidemark.operators.identity import assign_ids
from tidemark.operators.load import LoadResult, replay_exceptions, run_load
from tidemark.operators.merge import MergeResult, merge_load, stamp
from tidemark.operators.orphans import orphans, route_orphans
from tidemark.plans.query import Query, sql_time, times_as_text
from tidemark.sources.stored import StoredTable
from tidemark.sources.tables import read_table
from tidemark.spec import ForeignKey, TableSpec

CREATED = "2020-01-01"
NOW = dt.datetime(2024, 6, 1)


def _versioned(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"VersionStartTime": moment(CREATED), "VersionEndTime": open_end()}
    )


# Orders: urgent ones cost more, and every pending one is ordered again under a new key.

_ORDERS_STAGE_SQL = """
stage AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders
  UNION ALL
  SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus = 'P'
)"""


def orders_stage(orders: DataFrame) -> DataFrame:
    repriced = orders.withColumn(
        "o_totalprice",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 10).otherwise(F.col("o_totalprice")),
    )
    again = orders.where(F.col("o_orderstatus") == "P").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return repriced.unionByName(again)


def merge_orders(spark: SparkSession, folder: str) -> MergeResult:
    orders = read_table(spark, folder, "orders")
    return merge_load(_versioned(orders), orders_stage(orders), TableSpec(keys=("o_orderkey",)), NOW)


def _merge_orders_current(spark: SparkSession, folder: str) -> DataFrame:
    return times_as_text(
        merge_orders(spark, folder).current, "o_orderdate", "VersionStartTime", "VersionEndTime"
    )


def _merge_orders_history(spark: SparkSession, folder: str) -> DataFrame:
    return times_as_text(
        merge_orders(spark, folder).history_delta, "o_orderdate", "VersionStartTime", "VersionEndTime"
    )


_MERGE_ORDERS_CURRENT = f"""
WITH {_ORDERS_STAGE_SQL}
SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice,
       {sql_time('s.o_orderdate', 'o_orderdate')}, s.o_orderpriority,
       CASE WHEN t.o_orderkey IS NOT NULL AND t.o_totalprice = s.o_totalprice
            THEN '2020-01-01 00:00:00.000000' ELSE '2024-06-01 00:00:00.000000' END AS VersionStartTime,
       '9999-12-31 23:59:59.999999' AS VersionEndTime
FROM stage s LEFT JOIN orders t ON t.o_orderkey = s.o_orderkey
"""

_MERGE_ORDERS_HISTORY = f"""
WITH {_ORDERS_STAGE_SQL}
SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, t.o_totalprice,
       {sql_time('t.o_orderdate', 'o_orderdate')}, t.o_orderpriority,
       '2020-01-01 00:00:00.000000' AS VersionStartTime, '2024-06-01 00:00:00.000000' AS VersionEndTime
FROM stage s JOIN orders t ON t.o_orderkey = s.o_orderkey WHERE t.o_totalprice <> s.o_totalprice
"""


def _stored_orders(spark: SparkSession, folder: str, *partition_by: str) -> StoredTable:
    spec = TableSpec(keys=("o_orderkey",), partition_by=partition_by)
    return StoredTable.create(_versioned(read_table(spark, folder, "orders")), new_run_folder(spark, "orders"), spec)


def _kinds(table: StoredTable) -> DataFrame:
    parts = {"current": table.current(), "history": table.history().drop("load", "ended")}
    named = (df.withColumn("kind", F.lit(kind)) for kind, df in parts.items())
    return times_as_text(reduce(DataFrame.unionByName, named), "o_orderdate", "VersionStartTime", "VersionEndTime")


def _merge_orders_published(spark: SparkSession, folder: str) -> DataFrame:
    """Current rows and history of a merge written from one pass, and read back."""
    table = _stored_orders(spark, folder)
    table.publish(merge_orders(spark, folder).images, load=1)
    return _kinds(table)


_MERGE_ORDERS_PUBLISHED = f"""
SELECT *, 'current' AS kind FROM ({_MERGE_ORDERS_CURRENT})
UNION ALL SELECT *, 'history' FROM ({_MERGE_ORDERS_HISTORY})
"""


LATER = "2024-07-01"


def _publish_two_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads stored one after the other: the newest current rows, all history, and both as of the first."""
    table = _stored_orders(spark, folder)
    table.merge(orders_stage(read_table(spark, folder, "orders")), NOW, load=1)
    stage = table.current().where(F.col("o_orderkey") % 5 == 0).drop("VersionStartTime", "VersionEndTime")
    table.merge(stage.withColumn("o_totalprice", F.col("o_totalprice") + 1), LATER, load=2)
    states = {
        "current": table.current(),
        "history": table.history(),
        "current1": table.versions().as_of(NOW).withColumn("VersionEndTime", open_end()),
        "history1": table.history().where(F.col("VersionEndTime") <= moment(NOW)),
    }
    parts = [
        df.select("o_orderkey", "VersionStartTime", "VersionEndTime", F.lit(state).alias("state")) for state, df in states.items()
    ]
    return times_as_text(reduce(DataFrame.unionByName, parts), "VersionStartTime", "VersionEndTime")


_PUBLISH_TWO_LOADS = f"""
WITH first_current AS (SELECT o_orderkey, VersionStartTime, VersionEndTime FROM ({_MERGE_ORDERS_CURRENT})),
first_history AS (SELECT o_orderkey, VersionStartTime, VersionEndTime FROM ({_MERGE_ORDERS_HISTORY})),
changed AS (SELECT * FROM first_current WHERE o_orderkey % 5 = 0)
SELECT *, 'current1' AS state FROM first_current
UNION ALL SELECT *, 'history1' FROM first_history
UNION ALL SELECT *, 'history' FROM first_history
UNION ALL SELECT o_orderkey, VersionStartTime, '2024-07-01 00:00:00.000000', 'history' FROM changed
UNION ALL SELECT *, 'current' FROM first_current WHERE o_orderkey % 5 <> 0
UNION ALL SELECT o_orderkey, '2024-07-01 00:00:00.000000', VersionEndTime, 'current' FROM changed
"""


# Orders stored by priority: of the urgent ones some cost more, some are only high from now on, and new
# ones come. The three lower priorities are neither read whole nor written.


def priority_stage(orders: DataFrame) -> DataFrame:
    urgent, third = orders.where(F.col("o_orderpriority") == "1-URGENT"), F.col("o_orderkey") % 3
    changed = urgent.where(third < 2).withColumns(
        {
            "o_totalprice": F.col("o_totalprice") + F.when(third == 0, 1).otherwise(10),
            "o_orderpriority": F.when(third == 0, "2-HIGH").otherwise("1-URGENT"),
        }
    )
    return changed.unionByName(urgent.where(third == 2).withColumn("o_orderkey", -1 - F.col("o_orderkey")))


def _merge_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    table = _stored_orders(spark, folder, "o_orderpriority")
    table.merge(priority_stage(read_table(spark, folder, "orders")), NOW, load=1)
    return _kinds(table)


_MERGE_PARTITIONED = f"""
WITH marked AS (SELECT *, o_orderpriority = '1-URGENT' AS urgent, o_orderkey % 3 AS third FROM orders)
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN urgent AND third = 0 THEN o_totalprice + 1 WHEN urgent AND third = 1 THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice,
       {sql_time('o_orderdate', 'o_orderdate')}, CASE WHEN urgent AND third = 0 THEN '2-HIGH' ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN urgent AND third < 2 THEN '2024-06-01 00:00:00.000000' ELSE '2020-01-01 00:00:00.000000' END AS VersionStartTime,
       '9999-12-31 23:59:59.999999' AS VersionEndTime, 'current' AS kind
FROM marked
UNION ALL
SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, {sql_time('o_orderdate')}, o_orderpriority,
       '2024-06-01 00:00:00.000000', '9999-12-31 23:59:59.999999', 'current'
FROM marked WHERE urgent AND third = 2
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {sql_time('o_orderdate')}, o_orderpriority,
       '2020-01-01 00:00:00.000000', '2024-06-01 00:00:00.000000', 'history'
FROM marked WHERE urgent AND third < 2
"""


# Events: a stage too large to broadcast, so one full outer join.


def _merge_events(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    errors = events.where(F.col("event_type") == "error").withColumn("value", F.col("value") + 1)
    fresh = events.where(F.col("event_type") == "signup").withColumn("event_id", -1 - F.col("event_id"))
    merged = merge_load(events, errors.unionByName(fresh), TableSpec(keys=("event_id",)), NOW, small_stage=False)
    return times_as_text(merged.current, "ts")


_MERGE_EVENTS = f"""
SELECT event_id, {sql_time('ts', 'ts')}, user_id, event_type,
       CASE WHEN event_type = 'error' THEN value + 1 ELSE value END AS value, props
FROM events
UNION ALL
SELECT -1 - event_id, {sql_time('ts')}, user_id, event_type, value, props
FROM events WHERE event_type = 'signup'
"""


def _change_hash(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer")
    scope = TableSpec(keys=("c_custkey",)).hash_scope(customer.columns)
    return customer.select("c_custkey", row_hash(customer, scope).alias("row_hash"))


_CHANGE_HASH = """
SELECT c_custkey, sha256(
  coalesce(length(c_name) || ':' || c_name, '~') ||
  coalesce(length(c_nationkey::VARCHAR) || ':' || c_nationkey::VARCHAR, '~') ||
  coalesce(length(c_acctbal::VARCHAR) || ':' || c_acctbal::VARCHAR, '~') ||
  coalesce(length(c_mktsegment) || ':' || c_mktsegment, '~')) AS row_hash
FROM customer
"""


# Line items: returned ones name an unknown part, open ones an unknown supplier.

_LINES_SQL = """
lines AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_returnflag = 'R' THEN -1 - l_partkey ELSE l_partkey END AS l_partkey,
         CASE WHEN l_linestatus = 'O' THEN NULL
              WHEN l_returnflag = 'A' THEN -1 - l_suppkey ELSE l_suppkey END AS l_suppkey,
         l_quantity, l_extendedprice
  FROM lineitem
)"""


def lines_stage(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") == "R", -1 - F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("l_partkey"),
        F.when(F.col("l_linestatus") == "O", F.lit(None))
        .when(F.col("l_returnflag") == "A", -1 - F.col("l_suppkey"))
        .otherwise(F.col("l_suppkey"))
        .alias("l_suppkey"),
        "l_quantity",
        "l_extendedprice",
    )


def _line_keys(spark: SparkSession, folder: str) -> tuple[ForeignKey, ...]:
    return (
        ForeignKey("l_suppkey", read_table(spark, folder, "supplier"), "s_suppkey", "supplier"),
        ForeignKey("l_partkey", read_table(spark, folder, "part"), "p_partkey", "part"),
    )


def _orphan_lines(spark: SparkSession, folder: str) -> DataFrame:
    return orphans(lines_stage(read_table(spark, folder, "lineitem")), _line_keys(spark, folder)[1])


def _routed_clean(spark: SparkSession, folder: str) -> DataFrame:
    return route_orphans(lines_stage(read_table(spark, folder, "lineitem")), _line_keys(spark, folder)).clean


def _routed_exceptions(spark: SparkSession, folder: str) -> DataFrame:
    return route_orphans(lines_stage(read_table(spark, folder, "lineitem")), _line_keys(spark, folder)).exceptions


def _dropped_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """The replay form of the check: rows leave the stage, nothing is reported again."""
    stage = lines_stage(read_table(spark, folder, "lineitem"))
    clean = route_orphans(stage, _line_keys(spark, folder), emit=False).clean
    return clean.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("l_quantity").alias("total_quantity")
    )


_ORPHAN_LINES = f"""
WITH {_LINES_SQL}
SELECT * FROM lines WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part)
"""
_KEPT_LINES_SQL = """
kept AS (
  SELECT l.* FROM lines l
  LEFT JOIN part p ON p.p_partkey = l.l_partkey LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
  WHERE (l.l_partkey IS NULL OR p.p_partkey IS NOT NULL) AND (l.l_suppkey IS NULL OR s.s_suppkey IS NOT NULL)
)"""
_ROUTED_CLEAN = f"WITH {_LINES_SQL}, {_KEPT_LINES_SQL} SELECT * FROM kept"
_DROPPED_ORPHANS = f"""
WITH {_LINES_SQL}, {_KEPT_LINES_SQL}
SELECT l_suppkey, count(*) AS line_count, sum(l_quantity) AS total_quantity FROM kept GROUP BY l_suppkey
"""
_ROUTED_EXCEPTIONS = f"""
WITH {_LINES_SQL}, checked AS (
  SELECT l.*, CASE WHEN l.l_partkey IS NOT NULL AND p.p_partkey IS NULL THEN 'Orphan l_partkey'
                   WHEN l.l_suppkey IS NOT NULL AND s.s_suppkey IS NULL THEN 'Orphan l_suppkey' END AS d
  FROM lines l LEFT JOIN part p ON p.p_partkey = l.l_partkey LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       0 AS ErrorCode, 0 AS ErrorColumn, d AS ErrorDescription
FROM checked WHERE d IS NOT NULL
"""


def _whole_load(spark: SparkSession, folder: str) -> DataFrame:
    """Route and merge in one go: low-priority orders of the stage name an unknown customer."""
    orders = read_table(spark, folder, "orders")
    stage = orders_stage(orders).withColumn(
        "o_custkey",
        F.when(F.col("o_orderpriority") == "5-LOW", -1 - F.col("o_custkey")).otherwise(F.col("o_custkey")),
    )
    customers = ForeignKey("o_custkey", read_table(spark, folder, "customer"), "c_custkey", "customer")
    spec = TableSpec(keys=("o_orderkey",), foreign_keys=(customers,))
    result = run_load(_versioned(orders), stage, None, spec, NOW)
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    return (
        result.current.select(*columns, F.lit("current").alias("held_in"))
        .unionByName(result.history_delta.select(*columns, F.lit("history").alias("held_in")))
        .unionByName(result.exceptions.select(*columns, F.col("ErrorDescription").alias("held_in")))
    )


_WHOLE_LOAD = f"""
WITH {_ORDERS_STAGE_SQL}, clean AS (SELECT * FROM stage WHERE o_orderpriority <> '5-LOW')
SELECT coalesce(c.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(c.o_custkey, t.o_custkey) AS o_custkey,
       coalesce(c.o_totalprice, t.o_totalprice) AS o_totalprice, 'current' AS held_in
FROM orders t FULL JOIN clean c ON c.o_orderkey = t.o_orderkey
UNION ALL
SELECT t.o_orderkey, t.o_custkey, t.o_totalprice, 'history'
FROM orders t JOIN clean c ON c.o_orderkey = t.o_orderkey WHERE c.o_totalprice <> t.o_totalprice
UNION ALL
SELECT o_orderkey, -1 - o_custkey, o_totalprice, 'Orphan o_custkey' FROM stage WHERE o_orderpriority = '5-LOW'
"""


# Replay: every order was set aside on three days. The second day repeats the first for open
# orders; on the third, low-priority orders still name an unknown customer.

_REPLAY_SQL = """
days AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderpriority,
         TIMESTAMP '2024-01-01' AS load_date, 0 AS n FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice + 2 END, o_orderpriority,
         TIMESTAMP '2024-01-02', 1 FROM orders
  UNION ALL
  SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN -1 - o_custkey ELSE o_custkey END, o_orderstatus,
         o_totalprice + 3, o_orderpriority, TIMESTAMP '2024-01-03', 2 FROM orders
),
target AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderpriority
  FROM orders WHERE o_orderpriority <> '2-HIGH'
),
survivors AS (SELECT d.* FROM days d JOIN customer c ON c.c_custkey = d.o_custkey),
linked AS (
  SELECT *, lag(o_totalprice) OVER (PARTITION BY o_orderkey ORDER BY n) AS before FROM survivors
),
kept AS (
  SELECT l.*, t.o_orderkey IS NOT NULL AS known, TIMESTAMP '2024-06-01' + l.n * INTERVAL 1 MICROSECOND AS loaded_at
  FROM linked l LEFT JOIN target t ON t.o_orderkey = l.o_orderkey
  WHERE l.o_totalprice IS DISTINCT FROM coalesce(l.before, t.o_totalprice)
),
ordered AS (
  SELECT *, lead(loaded_at) OVER (PARTITION BY o_orderkey ORDER BY n) AS until,
         row_number() OVER (PARTITION BY o_orderkey ORDER BY n) AS nth
  FROM kept
)"""


def replay_orders(spark: SparkSession, folder: str, small: bool | None = None) -> LoadResult:
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    orders = read_table(spark, folder, "orders").select(*columns)
    price = F.col("o_totalprice")
    days = (
        ("2024-01-01", {"o_totalprice": price + 1}),
        ("2024-01-01", {"o_totalprice": price + 1}),
        ("2024-01-02", {"o_totalprice": F.when(F.col("o_orderstatus") == "O", price + 1).otherwise(price + 2)}),
        (
            "2024-01-03",
            {
                "o_totalprice": price + 3,
                "o_custkey": F.when(F.col("o_orderpriority") == "5-LOW", -1 - F.col("o_custkey")).otherwise(
                    F.col("o_custkey")
                ),
            },
        ),
    )
    exceptions = None
    for number, (date, changes) in enumerate(days):
        part = orders.withColumns(changes).withColumns(
            {
                "ServerExecutionID": F.lit(number).cast("bigint"),
                "DWLoadDate": moment(date),
                "ErrorCode": F.lit(0),
                "ErrorColumn": F.lit(0),
                "ErrorDescription": F.lit("Orphan o_custkey"),
            }
        )
        exceptions = part if exceptions is None else exceptions.unionByName(part)
    other = exceptions.where((F.col("ServerExecutionID") == 3) | (F.col("o_orderstatus") == "P")).withColumn(
        "ErrorDescription", F.lit("Value out of range")
    )
    target = orders.where(F.col("o_orderpriority") != "2-HIGH").withColumn(
        "o_totalprice", F.when(F.col("o_orderpriority") == "3-MEDIUM", price + 1).otherwise(price)
    )
    spec = TableSpec(
        keys=("o_orderkey",),
        foreign_keys=(ForeignKey("o_custkey", read_table(spark, folder, "customer"), "c_custkey", "customer"),),
    )
    target = _versioned(stamp(target, spec, 0, CREATED))
    return replay_exceptions(target, exceptions.unionByName(other), spec, 9, NOW, small)


_REPLAY_TIMES = ("DWLoadDate", "VersionStartTime", "VersionEndTime")


def _replay_current(spark: SparkSession, folder: str) -> DataFrame:
    return times_as_text(replay_orders(spark, folder).current, *_REPLAY_TIMES)


def _replay_history(spark: SparkSession, folder: str) -> DataFrame:
    return times_as_text(replay_orders(spark, folder).history_delta, *_REPLAY_TIMES)


def _replay_large(spark: SparkSession, folder: str) -> DataFrame:
    """Both images of a replay too large to broadcast: one shuffle of target and exceptions together."""
    return times_as_text(replay_orders(spark, folder, small=False).images, *_REPLAY_TIMES)


def _replay_left(spark: SparkSession, folder: str) -> DataFrame:
    return times_as_text(replay_orders(spark, folder).exceptions, "DWLoadDate")


_REPLAY_CURRENT = f"""
WITH {_REPLAY_SQL}, last AS (SELECT * FROM ordered WHERE until IS NULL)
SELECT coalesce(l.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(l.o_custkey, t.o_custkey) AS o_custkey,
       coalesce(l.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
       coalesce(l.o_totalprice, t.o_totalprice) AS o_totalprice,
       coalesce(l.o_orderpriority, t.o_orderpriority) AS o_orderpriority,
       CASE WHEN l.n IS NULL THEN 0 ELSE 9 END::BIGINT AS ServerExecutionID,
       {sql_time("coalesce(l.loaded_at, TIMESTAMP '2020-01-01')", 'DWLoadDate')},
       {sql_time("coalesce(l.loaded_at, TIMESTAMP '2020-01-01')", 'VersionStartTime')},
       '9999-12-31 23:59:59.999999' AS VersionEndTime
FROM target t FULL JOIN last l ON l.o_orderkey = t.o_orderkey
"""
_REPLAY_HISTORY = f"""
WITH {_REPLAY_SQL}
SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, t.o_totalprice, t.o_orderpriority,
       0::BIGINT AS ServerExecutionID, '2020-01-01 00:00:00.000000' AS DWLoadDate,
       '2020-01-01 00:00:00.000000' AS VersionStartTime, {sql_time('o.loaded_at', 'VersionEndTime')}
FROM target t JOIN ordered o ON o.o_orderkey = t.o_orderkey AND o.nth = 1
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 9,
       {sql_time('loaded_at')}, {sql_time('loaded_at')}, {sql_time('until')}
FROM ordered WHERE until IS NOT NULL
"""
_REPLAY_LEFT = f"""
WITH {_REPLAY_SQL}, copies AS (
  SELECT *, 0 AS exec_id FROM days WHERE n = 0 UNION ALL SELECT *, 1 FROM days WHERE n = 0
  UNION ALL SELECT *, 2 FROM days WHERE n = 1 UNION ALL SELECT *, 3 FROM days WHERE n = 2
), exceptions AS (
  SELECT *, 'Orphan o_custkey' AS d FROM copies
  UNION ALL SELECT *, 'Value out of range' FROM copies WHERE exec_id = 3 OR o_orderstatus = 'P'
)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, exec_id::BIGINT AS ServerExecutionID,
       {sql_time('load_date', 'DWLoadDate')}, 0 AS ErrorCode, 0 AS ErrorColumn, d AS ErrorDescription
FROM exceptions e
WHERE NOT EXISTS (SELECT 1 FROM survivors s WHERE s.o_orderkey = e.o_orderkey AND s.load_date = e.load_date)
"""


# A table that refers to itself: customers below the one with a fourth of their number. A third of them
# are there already, the others were set aside over a week, and every fifth once more later on.

_CUSTOMER_DAYS = """
days AS (
  SELECT c_custkey AS id, CASE WHEN c_custkey = 0 THEN NULL ELSE c_custkey // 4 END AS parent_id, c_acctbal,
         DATE '2024-01-01' + (c_custkey * 5 % 7)::INTEGER AS load_date
  FROM customer WHERE c_custkey % 3 <> 0
  UNION ALL
  SELECT c_custkey, (c_custkey + 1) // 4, c_acctbal + 1, DATE '2024-01-20' FROM customer WHERE c_custkey % 5 = 0
)"""


def replay_customers(spark: SparkSession, folder: str, small: bool | None = None) -> LoadResult:
    customer, key = read_table(spark, folder, "customer"), F.col("c_custkey")
    parent = F.when(key != 0, F.floor(key / 4).cast("bigint"))
    rows = customer.select(key.alias("id"), parent.alias("parent_id"), "c_acctbal")
    first = customer.where(key % 3 != 0).select(
        key.alias("id"), parent.alias("parent_id"), "c_acctbal",
        F.date_add(F.lit("2024-01-01").cast("date"), (key * 5 % 7).cast("int")).cast("timestamp_ntz").alias("DWLoadDate"),
    )
    again = customer.where(key % 5 == 0).select(
        key.alias("id"), F.floor((key + 1) / 4).cast("bigint").alias("parent_id"), (F.col("c_acctbal") + 1).alias("c_acctbal"),
        moment("2024-01-20").alias("DWLoadDate"),
    )
    exceptions = first.unionByName(again).withColumns(
        {
            "ServerExecutionID": F.lit(1).cast("bigint"),
            "ErrorCode": F.lit(0),
            "ErrorColumn": F.lit(0),
            "ErrorDescription": F.lit("Orphan parent_id"),
        }
    )
    spec = TableSpec(keys=("id",), foreign_keys=(ForeignKey("parent_id", None, "id", "customer"),))
    target = _versioned(stamp(rows.where(F.col("id") % 3 == 0), spec, 0, CREATED))
    return replay_exceptions(target, exceptions, spec, 9, NOW, small)


def _replay_self(spark: SparkSession, folder: str) -> DataFrame:
    """Current and history rows, and what still has no parent in time."""
    result = replay_customers(spark, folder)
    columns = ["id", "parent_id", "c_acctbal", "ServerExecutionID"]
    times = ["VersionStartTime", "VersionEndTime"]
    images = times_as_text(result.images.select(*columns, *times, F.col("kind").alias("held_in")), *times)
    left = times_as_text(
        result.exceptions.select(*columns, F.col("DWLoadDate").alias(times[0]), F.lit(None).cast("timestamp_ntz").alias(times[1]), F.lit("left").alias("held_in")),
        *times,
    )
    return images.unionByName(left)


_REPLAY_SELF = f"""
WITH RECURSIVE {_CUSTOMER_DAYS}, target AS (
  SELECT c_custkey AS id, CASE WHEN c_custkey = 0 THEN NULL ELSE c_custkey // 4 END AS parent_id, c_acctbal
  FROM customer WHERE c_custkey % 3 = 0
), loaded AS (
  SELECT d.* FROM days d WHERE parent_id IS NULL OR parent_id IN (SELECT id FROM target)
  UNION
  SELECT d.* FROM loaded l JOIN days d ON d.parent_id = l.id AND d.load_date > l.load_date
), stamps AS (
  SELECT load_date, TIMESTAMP '2024-06-01' + (row_number() OVER (ORDER BY load_date) - 1) * INTERVAL 1 MICROSECOND AS loaded_at
  FROM (SELECT DISTINCT load_date FROM days)
), versions AS (
  SELECT id, parent_id, c_acctbal, 0::BIGINT AS exec_id, TIMESTAMP '2020-01-01' AS s FROM target
  UNION ALL SELECT id, parent_id, c_acctbal, 9, loaded_at FROM loaded JOIN stamps USING (load_date)
), ordered AS (SELECT *, lead(s) OVER (PARTITION BY id ORDER BY s) AS e FROM versions)
SELECT id, parent_id, c_acctbal, exec_id AS ServerExecutionID, {sql_time('s', 'VersionStartTime')},
       coalesce({sql_time('e')}, '9999-12-31 23:59:59.999999') AS VersionEndTime,
       CASE WHEN e IS NULL THEN 'current' ELSE 'history' END AS held_in
FROM ordered
UNION ALL
SELECT id, parent_id, c_acctbal, 1, {sql_time('load_date::TIMESTAMP')}, NULL, 'left' FROM days d
WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.id = d.id AND l.load_date = d.load_date)
"""


def _dense_ids(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer")
    return assign_ids(customer, ["c_mktsegment", "c_name"], "customer_id").select(
        "customer_id", "c_custkey", "c_mktsegment", "c_name"
    )


_DENSE_IDS = """
SELECT row_number() OVER (ORDER BY c_mktsegment, c_name) AS customer_id, c_custkey, c_mktsegment, c_name FROM customer
"""


def _multiset_diff(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag")
    moved = lines.withColumn(
        "l_linenumber", F.when(F.col("l_returnflag") == "R", F.lit(1)).otherwise(F.col("l_linenumber"))
    )
    return table_diff(lines, moved)


_MULTISET_DIFF = """
WITH lines AS (SELECT l_suppkey, l_linenumber, l_returnflag FROM lineitem),
both_sides AS (
  SELECT *, 1 AS sign FROM lines
  UNION ALL SELECT l_suppkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE l_linenumber END, l_returnflag, -1 FROM lines
), sums AS (
  SELECT l_suppkey, l_linenumber, l_returnflag, sum(sign)::BIGINT AS n FROM both_sides GROUP BY ALL
)
SELECT l_suppkey, l_linenumber, l_returnflag, CASE WHEN n > 0 THEN 'expected' ELSE 'actual' END AS side, abs(n) AS copies
FROM sums WHERE n <> 0
"""

QUERIES = {
    "merge_orders_current": Query(_merge_orders_current, _MERGE_ORDERS_CURRENT),
    "merge_orders_history": Query(_merge_orders_history, _MERGE_ORDERS_HISTORY),
    "publish_two_loads": Query(_publish_two_loads, _PUBLISH_TWO_LOADS),
    "merge_orders_published": Query(_merge_orders_published, _MERGE_ORDERS_PUBLISHED),
    "merge_partitioned": Query(_merge_partitioned, _MERGE_PARTITIONED),
    "merge_events_outer": Query(_merge_events, _MERGE_EVENTS),
    "row_change_hash": Query(_change_hash, _CHANGE_HASH),
    "orphan_rows": Query(_orphan_lines, _ORPHAN_LINES),
    "orphan_routing_clean": Query(_routed_clean, _ROUTED_CLEAN),
    "orphan_routing_exceptions": Query(_routed_exceptions, _ROUTED_EXCEPTIONS),
    "orphan_drop_only": Query(_dropped_orphans, _DROPPED_ORPHANS),
    "whole_load": Query(_whole_load, _WHOLE_LOAD),
    "replay_current": Query(_replay_current, _REPLAY_CURRENT),
    "replay_history": Query(_replay_history, _REPLAY_HISTORY),
    "replay_large": Query(
        _replay_large,
        f"SELECT *, 'current' AS kind FROM ({_REPLAY_CURRENT}) UNION ALL SELECT *, 'history' FROM ({_REPLAY_HISTORY})",
    ),
    "replay_exceptions_left": Query(_replay_left, _REPLAY_LEFT),
    "replay_self_reference": Query(_replay_self, _REPLAY_SELF),
    "dense_ids": Query(_dense_ids, _DENSE_IDS),
    "multiset_diff": Query(_multiset_diff, _MULTISET_DIFF),
}
