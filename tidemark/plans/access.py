"""Row-level security over orders, customers and line items."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import security as sec
from tidemark.plans.query import Query, time_text
from tidemark.sources.tables import read_table

_POLICY = "order_access"


def _priority_access() -> sec.Access:
    """Two desks see one priority each, one sees two, the lead sees all; nobody else sees any."""
    return (
        sec.by_case({"UrgentDesk": "1-URGENT", "HighDesk": "2-HIGH"})
        | sec.by_values({"SlowDesk": ["4-NOT SPECIFIED", "5-LOW"]})
        | sec.allow_all(["Lead", "dbo"])
    )


def _registry(access: sec.Access, table: str, column: str) -> sec.SecurityRegistry:
    registry = sec.SecurityRegistry()
    registry.define("order_rows", access)
    registry.create_policy(_POLICY)
    registry.add_filter(_POLICY, "order_rows", table, column)
    return registry


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").drop("o_orderdate")


def _seen_by(*names: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        registry = _registry(_priority_access(), "orders", "o_orderpriority")
        parts = [
            registry.read("orders", _orders(spark, folder), sec.User.of(name)).withColumn("reader", F.lit(name))
            for name in names
        ]
        return reduce(DataFrame.unionByName, parts)

    return run


_ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


def _nation_access(spark: SparkSession, folder: str, max_literals: int) -> sec.Access:
    access = read_table(spark, folder, "nation").select(
        F.concat(F.lit("Region"), F.col("n_regionkey").cast("string")).alias("UserName"),
        F.col("n_nationkey").alias("NationID"),
    )
    return sec.by_lookup(access, "UserName", "NationID", max_literals) | sec.allow_all(["dbo"])


def _by_lookup(max_literals: int):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        registry = _registry(_nation_access(spark, folder, max_literals), "customer", "c_nationkey")
        customer = read_table(spark, folder, "customer")
        # Upper case on purpose: names compare without regard to it.
        return registry.read("customer", customer, sec.User.of("REGION2"))

    return run


_BY_LOOKUP = """
SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)
"""


def _by_owner(spark: SparkSession, folder: str) -> DataFrame:
    users = read_table(spark, folder, "customer").select("c_custkey", "c_name")
    registry = _registry(sec.by_join(users, "c_name", "c_custkey", "sysadmin"), "orders", "o_custkey")
    orders = _orders(spark, folder)
    mine = registry.read("orders", orders, sec.User.of("Customer#000000010"))
    all_rows = registry.read("orders", orders, sec.User.of("test_sa", roles=["SysAdmin"]))
    return mine.withColumn("reader", F.lit("owner")).unionByName(all_rows.withColumn("reader", F.lit("admin")))


_BY_OWNER = f"""
SELECT {_ORDER_COLUMNS}, 'owner' AS reader FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_name = 'Customer#000000010')
UNION ALL SELECT {_ORDER_COLUMNS}, 'admin' FROM orders
"""


def _joins(spark: SparkSession, folder: str) -> DataFrame:
    """Inner and left joins of a protected with an open table, then with both protected."""
    access = sec.by_case({"FinalDesk": "F"})
    registry = _registry(access, "orders", "o_orderstatus")
    user = sec.User.of("FinalDesk")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linestatus", "l_quantity")
    on = F.col("l_orderkey") == F.col("o_orderkey")

    def joined(how: str, kind: str) -> DataFrame:
        left = registry.read("lineitem", lines, user)
        both = left.join(registry.read("orders", orders, user), on, how)
        return both.groupBy("o_orderstatus", "l_linestatus").agg(
            F.count(F.lit(1)).alias("line_count"), F.sum("l_quantity").alias("total_quantity")
        ).withColumn("kind", F.lit(kind))

    parts = [joined("inner", "inner, one protected"), joined("left", "left, one protected")]
    registry.add_filter(_POLICY, "order_rows", "lineitem", "l_linestatus")
    parts += [joined("inner", "inner, both protected"), joined("left", "left, both protected")]
    return reduce(DataFrame.unionByName, parts)


_JOINS = """
WITH o AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'),
l AS (SELECT * FROM lineitem), lf AS (SELECT * FROM l WHERE l_linestatus = 'F')
SELECT o_orderstatus, l_linestatus, count(*) AS line_count, sum(l_quantity) AS total_quantity,
       'inner, one protected' AS kind FROM l JOIN o ON l_orderkey = o_orderkey GROUP BY 1, 2
UNION ALL SELECT o_orderstatus, l_linestatus, count(*), sum(l_quantity), 'left, one protected'
FROM l LEFT JOIN o ON l_orderkey = o_orderkey GROUP BY 1, 2
UNION ALL SELECT o_orderstatus, l_linestatus, count(*), sum(l_quantity), 'inner, both protected'
FROM lf JOIN o ON l_orderkey = o_orderkey GROUP BY 1, 2
UNION ALL SELECT o_orderstatus, l_linestatus, count(*), sum(l_quantity), 'left, both protected'
FROM lf LEFT JOIN o ON l_orderkey = o_orderkey GROUP BY 1, 2
"""


def _writes(spark: SparkSession, folder: str) -> DataFrame:
    """With a filter alone a user changes and deletes only what they see, and may write rows out of view."""
    registry = _registry(_priority_access(), "orders", "o_orderpriority")
    orders = _orders(spark, folder)
    user = sec.User.of("UrgentDesk")
    hidden = orders.where(F.col("o_orderpriority") == "3-MEDIUM").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    after = registry.insert("orders", orders, hidden, user)
    after = registry.update("orders", after, F.col("o_orderstatus") == "O", {"o_orderpriority": F.lit("2-HIGH")}, user)
    return registry.delete("orders", after, F.col("o_orderstatus") == "P", user)


_WRITES = f"""
WITH after_insert AS (
  SELECT {_ORDER_COLUMNS} FROM orders
  UNION ALL SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
  FROM orders WHERE o_orderpriority = '3-MEDIUM'
)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN '2-HIGH' ELSE o_orderpriority END
       AS o_orderpriority
FROM after_insert WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')
"""


def _blocked_writes(spark: SparkSession, folder: str) -> DataFrame:
    """Writes that pass all four block predicates; a refused one changes nothing."""
    registry = _registry(_priority_access(), "orders", "o_orderpriority")
    registry.define("order_writes", _priority_access())
    for operation in sec.OPERATIONS:
        registry.add_block(_POLICY, "order_writes", "orders", "o_orderpriority", operation)
    user = sec.User.of("SlowDesk")
    orders = _orders(spark, folder)
    copies = orders.where(F.col("o_orderpriority") == "5-LOW").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    after = registry.insert("orders", orders, copies, user)
    low = F.col("o_orderpriority") == "5-LOW"
    try:
        after = registry.update("orders", after, low, {"o_orderpriority": F.lit("1-URGENT")}, user)
    except sec.BlockedError:
        after = registry.update("orders", after, low, {"o_orderpriority": F.lit("4-NOT SPECIFIED")}, user)
    return registry.delete("orders", after, F.col("o_orderstatus") == "F", user)


_BLOCKED_WRITES = f"""
WITH after_insert AS (
  SELECT {_ORDER_COLUMNS} FROM orders
  UNION ALL SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
  FROM orders WHERE o_orderpriority = '5-LOW'
)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN o_orderpriority = '5-LOW' THEN '4-NOT SPECIFIED' ELSE o_orderpriority END AS o_orderpriority
FROM after_insert
WHERE NOT (o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') AND o_orderstatus = 'F')
"""


def _policy_off(spark: SparkSession, folder: str) -> DataFrame:
    """Visible rows with the policy on, off, without its predicate, and dropped."""
    registry = _registry(_priority_access(), "orders", "o_orderpriority")
    orders = _orders(spark, folder)
    user = sec.User.of("HighDesk")

    def seen(state: str) -> DataFrame:
        rows = registry.read("orders", orders, user)
        return rows.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("order_count")).withColumn("state", F.lit(state))

    parts = [seen("on")]
    registry.set_enabled(_POLICY, False)
    parts.append(seen("off"))
    registry.set_enabled(_POLICY, True)
    registry.drop_filter(_POLICY, "orders")
    parts.append(seen("no predicate"))
    registry.add_filter(_POLICY, "order_rows", "orders", "o_orderpriority")
    parts.append(seen("on again"))
    registry.drop_policy(_POLICY)
    parts.append(seen("dropped"))
    return reduce(DataFrame.unionByName, parts)


_POLICY_OFF = """
WITH c AS (SELECT o_orderpriority, count(*) AS order_count FROM orders GROUP BY 1)
SELECT c.*, state FROM c, (VALUES ('off'), ('no predicate'), ('dropped')) v(state)
UNION ALL SELECT c.*, state FROM c, (VALUES ('on'), ('on again')) v(state) WHERE o_orderpriority = '2-HIGH'
"""


def _inventory(spark: SparkSession, folder: str) -> DataFrame:
    """What is bound where, with the rows each user sees."""
    registry = _registry(_priority_access(), "orders", "o_orderpriority")
    registry.add_block(_POLICY, "order_rows", "orders", "o_orderpriority", sec.AFTER_INSERT)
    users = [sec.User.of(n) for n in ("UrgentDesk", "HighDesk", "SlowDesk", "Lead", "Stranger")]
    counts = registry.visible_counts("orders", _orders(spark, folder), users)
    bound = registry.inventory(spark).select("policy", "is_enabled", "predicate_type", "operation", F.col("table").alias("target"))
    return bound.where(F.col("predicate_type") == sec.FILTER).join(
        counts.withColumn("target", F.lit("orders")), "target"
    ).drop("operation")


_INVENTORY = """
SELECT 'order_access' AS policy, true AS is_enabled, 'FILTER' AS predicate_type, 'orders' AS target,
       u.n AS user_name, count(o_orderkey) AS visible_rows
FROM (VALUES ('urgentdesk'), ('highdesk'), ('slowdesk'), ('lead'), ('stranger')) u(n)
LEFT JOIN orders ON n = 'lead' OR (n = 'urgentdesk' AND o_orderpriority = '1-URGENT')
  OR (n = 'highdesk' AND o_orderpriority = '2-HIGH')
  OR (n = 'slowdesk' AND o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW'))
GROUP BY u.n
"""


def _per_owner(spark: SparkSession, folder: str) -> DataFrame:
    return sec.rows_per(read_table(spark, folder, "orders"), "o_custkey")


def _probe(spark: SparkSession, folder: str) -> DataFrame:
    """A condition that fails on a hidden row: it must not be looked at there.

    The user may see the line items of their nation's suppliers, and divides by zero on those
    of a supplier they may not see.
    """
    supplier = read_table(spark, folder, "supplier")
    access = supplier.select(
        F.concat(F.lit("Nation"), F.col("s_nationkey").cast("string")).alias("UserName"), "s_suppkey"
    )
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    own = sec.by_lookup(access, "UserName", "s_suppkey", max_literals=0)
    registry = _registry(own, "lineitem", "l_suppkey")
    hidden = supplier.where(F.col("s_nationkey") != 20).agg(F.min("s_suppkey")).first()[0]
    seen = registry.read("lineitem", lines, sec.User.of("Nation20"))
    return seen.where(F.abs(1 / (F.col("l_suppkey") - hidden)) > 0).select(
        "l_orderkey", "l_linenumber", "l_suppkey", time_text("l_shipdate").alias("l_shipdate")
    )


_PROBE = """
SELECT l_orderkey, l_linenumber, l_suppkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_nationkey = 20
"""

def _view_probe(spark: SparkSession, folder: str) -> DataFrame:
    """The same over a protected view, a join whose policy column is on the other side.

    The condition only needs the line items, so it could be moved below the join, to rows of
    orders the user may not see.
    """
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    view = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    registry = _registry(_priority_access(), "order_lines", "o_orderpriority")
    hidden = orders.where(F.col("o_orderpriority") != "1-URGENT").agg(F.min("o_orderkey")).first()[0]
    seen = registry.read("order_lines", view, sec.User.of("UrgentDesk"))
    return seen.where(F.abs(1 / (F.col("l_orderkey") - hidden)) > 0).select("l_orderkey", "l_linenumber", "o_orderpriority")


_VIEW_PROBE = """
SELECT l_orderkey, l_linenumber, o_orderpriority FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE o_orderpriority = '1-URGENT'
"""

QUERIES = {
    "policy_one_value_each": Query(
        _seen_by("UrgentDesk", "HighDesk"),
        f"""SELECT {_ORDER_COLUMNS}, CASE o_orderpriority WHEN '1-URGENT' THEN 'UrgentDesk' ELSE 'HighDesk' END AS reader
        FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    ),
    "policy_all_rows": Query(_seen_by("lead", "DBO", "Stranger"), f"""
        SELECT {_ORDER_COLUMNS}, reader FROM orders, (VALUES ('lead'), ('DBO')) v(reader)"""),
    "policy_several_values": Query(
        _seen_by("SlowDesk"),
        f"""SELECT {_ORDER_COLUMNS}, 'SlowDesk' AS reader FROM orders
        WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')""",
    ),
    "policy_lookup": Query(_by_lookup(sec.MAX_LITERALS), _BY_LOOKUP),
    "policy_lookup_beyond_literals": Query(_by_lookup(2), _BY_LOOKUP),
    "policy_lookup_probe": Query(_probe, _PROBE),
    "policy_view_probe": Query(_view_probe, _VIEW_PROBE),
    "policy_by_owner": Query(_by_owner, _BY_OWNER),
    "policy_joins": Query(_joins, _JOINS),
    "policy_filtered_writes": Query(_writes, _WRITES),
    "policy_blocked_writes": Query(_blocked_writes, _BLOCKED_WRITES),
    "policy_states": Query(_policy_off, _POLICY_OFF),
    "policy_inventory": Query(_inventory, _INVENTORY),
    "rows_per_owner": Query(
        _per_owner, "SELECT o_custkey, count(*) AS total_rows FROM orders GROUP BY o_custkey"
    ),
}
