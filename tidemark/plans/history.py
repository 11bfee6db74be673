"""Versioned tables and time travel over events, customers and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.durable import new_run_folder
from tidemark.functions.moments import moment, open_end
from tidemark.functions.ordered import next_value
from tidemark.operators.orphans import orphans
from tidemark.operators.temporal import TemporalTable, temporal_fk_gaps
from tidemark.plans.loads import orders_stage
from tidemark.plans.query import Query, sql_time, times_as_text
from tidemark.sources.stored import StoredTable
from tidemark.sources.tables import read_table
from tidemark.spec import ForeignKey, TableSpec

CREATED = "2020-01-01"
NOW = "2024-06-01"
LOW = "2024-01-10 00:00:00"
HIGH = "2024-01-20 00:00:00"
OPEN = "9999-12-31 23:59:59.999999"

_PERIOD = ("RowStartDate", "RowEndDate")


# Each user's events are the versions of that user: one ends where the next begins.


def user_states(spark: SparkSession, folder: str) -> TemporalTable:
    events = read_table(spark, folder, "events").select(
        "user_id", "event_id", "event_type", "value", F.col("ts").alias("RowStartDate")
    )
    versions = next_value(events, ["user_id"], ["RowStartDate"], "RowStartDate", "_next")
    ended = versions.withColumn("RowEndDate", F.coalesce("_next", open_end()))
    return TemporalTable(
        current=ended.where(F.col("_next").isNull()).drop("_next"),
        history=ended.where(F.col("_next").isNotNull()).drop("_next"),
        key=("user_id",),
    )


_STATES = f"""
states AS (
  SELECT user_id, event_id, event_type, value, ts AS s,
         coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), TIMESTAMP '{OPEN}') AS e
  FROM events
)"""
_STATE_COLUMNS = (
    f"user_id, event_id, event_type, value, {sql_time('s', 'RowStartDate')}, {sql_time('e', 'RowEndDate')}"
)


def _states_sql(condition: str) -> str:
    return f"WITH {_STATES} SELECT {_STATE_COLUMNS} FROM states WHERE {condition}"


def _all_versions(spark: SparkSession, folder: str) -> DataFrame:
    return times_as_text(user_states(spark, folder).all_versions(), *_PERIOD)


def _as_of(spark: SparkSession, folder: str) -> DataFrame:
    return times_as_text(user_states(spark, folder).as_of(HIGH), *_PERIOD)


# The same table stored, and changed by a load a month: each load ends rows on another day.

MONTHS = ("2024-02-01", "2024-03-01", "2024-04-01", "2024-05-01")


def stored_accounts(spark: SparkSession, folder: str) -> StoredTable:
    """Customers by segment; month by month those of one remainder get another balance."""
    customer = read_table(spark, folder, "customer")
    spec = TableSpec(keys=("c_custkey",), start="RowStartDate", end="RowEndDate", partition_by=("c_mktsegment",))
    created = TemporalTable.create(customer, ["c_custkey"], CREATED).current
    table = StoredTable.create(created, new_run_folder(spark, "accounts"), spec)
    for load, month in enumerate(MONTHS, 1):
        stage = customer.where(F.col("c_custkey") % (load + 1) == 0).withColumn("c_acctbal", F.col("c_acctbal") + load)
        table.merge(stage, month, load)
    return table


def _as_of_pruned(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as they were between two loads: history that ended before is not read."""
    return times_as_text(stored_accounts(spark, folder).versions().as_of("2024-03-15"), *_PERIOD)


_AS_OF_PRUNED = f"""
WITH moments AS (SELECT * FROM (VALUES (0, TIMESTAMP '2020-01-01'), (1, TIMESTAMP '2024-02-01'), (2, TIMESTAMP '2024-03-01'),
  (3, TIMESTAMP '2024-04-01'), (4, TIMESTAMP '2024-05-01')) v(load, s)),
versions AS (
  SELECT c.*, load, s, coalesce(lead(s) OVER (PARTITION BY c_custkey ORDER BY s), TIMESTAMP '{OPEN}') AS e
  FROM customer c JOIN moments ON load = 0 OR c_custkey % (load + 1) = 0
)
SELECT c_custkey, c_name, c_nationkey, c_acctbal + load AS c_acctbal, c_mktsegment,
       {sql_time('s', 'RowStartDate')}, {sql_time('e', 'RowEndDate')}
FROM versions WHERE s <= TIMESTAMP '2024-03-15' AND e > TIMESTAMP '2024-03-15'
"""


def _from_to(spark: SparkSession, folder: str) -> DataFrame:
    return times_as_text(user_states(spark, folder).from_to(LOW, HIGH), *_PERIOD)


def _between(spark: SparkSession, folder: str) -> DataFrame:
    return times_as_text(user_states(spark, folder).between(LOW, HIGH), *_PERIOD)


def _contained_in(spark: SparkSession, folder: str) -> DataFrame:
    return times_as_text(user_states(spark, folder).contained_in(LOW, HIGH), *_PERIOD)


# Periods of whole days, so that versions begin and end exactly on the asked instants.


def _order_periods(spark: SparkSession, folder: str) -> TemporalTable:
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("RowStartDate")
    )
    closed = orders.where(F.col("o_orderstatus") == "F").withColumn(
        "RowEndDate", F.col("RowStartDate") + F.make_dt_interval(days=F.lit(30))
    )
    still = orders.where(F.col("o_orderstatus") != "F").withColumn("RowEndDate", open_end())
    return TemporalTable(current=still, history=closed, key=("o_orderkey",))


def _boundaries(spark: SparkSession, folder: str) -> DataFrame:
    """How many versions each kind of time travel returns per status, on exact boundaries."""
    table = _order_periods(spark, folder)
    low, high = "1998-03-01", "1998-04-30"
    kinds = {
        "all": table.all_versions(),
        "as_of": table.as_of(low),
        "from_to": table.from_to(low, high),
        "between": table.between(low, high),
        "contained_in": table.contained_in(low, high),
    }
    parts = [
        df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("version_count")).withColumn("kind", F.lit(kind))
        for kind, df in kinds.items()
    ]
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.unionByName(part)
    return counted


_BOUNDARIES = f"""
WITH periods AS (
  SELECT o_orderstatus, o_orderdate AS s,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY ELSE TIMESTAMP '{OPEN}' END AS e
  FROM orders
), b AS (SELECT TIMESTAMP '1998-03-01' AS lo, TIMESTAMP '1998-04-30' AS hi)
SELECT o_orderstatus, count(*) AS version_count, 'all' AS kind FROM periods GROUP BY 1
UNION ALL SELECT o_orderstatus, count(*), 'as_of' FROM periods, b WHERE s <= lo AND e > lo GROUP BY 1
UNION ALL SELECT o_orderstatus, count(*), 'from_to' FROM periods, b WHERE s < hi AND e > lo GROUP BY 1
UNION ALL SELECT o_orderstatus, count(*), 'between' FROM periods, b WHERE s <= hi AND e > lo GROUP BY 1
UNION ALL SELECT o_orderstatus, count(*), 'contained_in' FROM periods, b WHERE s >= lo AND e <= hi GROUP BY 1
"""


# Changes


def _customers(spark: SparkSession, folder: str) -> TemporalTable:
    return TemporalTable.create(read_table(spark, folder, "customer"), ["c_custkey"], CREATED)


def _changed(spark: SparkSession, folder: str) -> DataFrame:
    """Insert, update (also without a difference), delete, then every version there is."""
    table = _customers(spark, folder)
    twins = table.visible().where(F.col("c_mktsegment") == "FURNITURE").withColumn("c_custkey", -1 - F.col("c_custkey"))
    table = table.insert(twins, "2024-02-01")
    table = table.update(F.col("c_mktsegment") == "BUILDING", {"c_acctbal": F.col("c_acctbal") + 1}, "2024-03-01")
    table = table.update(F.col("c_mktsegment") == "MACHINERY", {"c_name": F.col("c_name")}, "2024-04-01")
    table = table.delete(F.col("c_acctbal") < 0, "2024-05-01")
    return times_as_text(table.all_versions(), *_PERIOD)


_CHANGED = f"""
WITH rows_at AS (
  SELECT *, TIMESTAMP '2020-01-01' AS s FROM customer
  UNION ALL SELECT -1 - c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, TIMESTAMP '2024-02-01'
  FROM customer WHERE c_mktsegment = 'FURNITURE'
), versions AS (
  SELECT *, NULL::TIMESTAMP AS e FROM rows_at WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
  UNION ALL SELECT *, TIMESTAMP '2024-03-01' FROM rows_at WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1, c_mktsegment, TIMESTAMP '2024-03-01', NULL
  FROM rows_at WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT *, TIMESTAMP '2024-04-01' FROM rows_at WHERE c_mktsegment = 'MACHINERY'
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, TIMESTAMP '2024-04-01', NULL
  FROM rows_at WHERE c_mktsegment = 'MACHINERY'
)
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, {sql_time('s', 'RowStartDate')},
       {sql_time(f"coalesce(e, CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2024-05-01' ELSE TIMESTAMP '{OPEN}' END)", 'RowEndDate')}
FROM versions
"""


def _back_dated(spark: SparkSession, folder: str) -> DataFrame:
    """Versioning an existing table with each row's own start."""
    orders = read_table(spark, folder, "orders")
    table = TemporalTable.create(orders, ["o_orderkey"], F.col("o_orderdate"))
    return times_as_text(table.as_of("1998-01-01").drop("o_orderdate"), *_PERIOD)


_BACK_DATED = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
       {sql_time('o_orderdate', 'RowStartDate')}, '{OPEN}' AS RowEndDate
FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01'
"""


def _merged(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    table = TemporalTable.create(orders, ["o_orderkey"], CREATED)
    merged = table.merge(orders_stage(orders), TableSpec(keys=("o_orderkey",)), NOW)
    return times_as_text(merged.all_versions().select("o_orderkey", "o_totalprice", *_PERIOD), *_PERIOD)


_MERGED = f"""
SELECT o_orderkey, o_totalprice, '2020-01-01 00:00:00.000000' AS RowStartDate,
       CASE WHEN o_orderpriority = '1-URGENT' THEN '2024-06-01 00:00:00.000000' ELSE '{OPEN}' END AS RowEndDate
FROM orders
UNION ALL SELECT o_orderkey, o_totalprice + 10, '2024-06-01 00:00:00.000000', '{OPEN}'
FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT -1 - o_orderkey, o_totalprice, '2024-06-01 00:00:00.000000', '{OPEN}'
FROM orders WHERE o_orderstatus = 'P'
"""


def _columns_changed(spark: SparkSession, folder: str) -> DataFrame:
    """A column added to and one dropped from current and history alike."""
    table = user_states(spark, folder).add_column("payroll_id", "int").drop_column("value")
    return times_as_text(table.all_versions(), *_PERIOD)


_COLUMNS_CHANGED = f"""
WITH {_STATES}
SELECT user_id, event_id, event_type, NULL::INTEGER AS payroll_id,
       {sql_time('s', 'RowStartDate')}, {sql_time('e', 'RowEndDate')} FROM states
"""


def _loaded_by_hand(spark: SparkSession, folder: str) -> DataFrame:
    """History from before the first known state, with a gap, checked when versioning returns."""
    table = user_states(spark, folder)
    first = table.all_versions().groupBy("user_id").agg(F.min("RowStartDate").alias("first_seen"))
    older = first.select(
        "user_id",
        F.lit(-1).cast("bigint").alias("event_id"),
        F.lit("imported").alias("event_type"),
        F.lit(0.0).alias("value"),
        moment("2023-01-01").alias("RowStartDate"),
        (F.col("first_seen") - F.make_dt_interval(hours=F.lit(1))).alias("RowEndDate"),
    )
    table = table.versioning_off().load_history(older).versioning_on()
    return times_as_text(table.all_versions(), *_PERIOD)


_LOADED_BY_HAND = f"""
WITH {_STATES}
SELECT {_STATE_COLUMNS} FROM states
UNION ALL
SELECT user_id, -1, 'imported', 0.0, '2023-01-01 00:00:00.000000', {sql_time('min(s) - INTERVAL 1 HOUR')}
FROM states GROUP BY user_id
"""


# Checks


def _reversed_periods(spark: SparkSession, folder: str) -> DataFrame:
    table = user_states(spark, folder)
    wrong = table.history.withColumn(
        "RowEndDate",
        F.when(F.col("event_type") == "error", F.col("RowStartDate") - F.make_dt_interval(days=F.lit(1))).otherwise(
            F.col("RowEndDate")
        ),
    )
    table = TemporalTable(table.current, wrong, table.key, versioned=False)
    return times_as_text(table.check_periods(), *_PERIOD)


_REVERSED = f"""
WITH {_STATES}
SELECT user_id, event_id, event_type, value, {sql_time('s', 'RowStartDate')},
       {sql_time('s - INTERVAL 1 DAY', 'RowEndDate')}
FROM states WHERE event_type = 'error' AND e <> TIMESTAMP '{OPEN}'
"""


def _overlapping(spark: SparkSession, folder: str) -> TemporalTable:
    table = user_states(spark, folder)
    longer = table.history.withColumn(
        "RowEndDate",
        F.when(F.col("event_type") == "click", F.col("RowEndDate") + F.make_dt_interval(days=F.lit(1))).otherwise(
            F.col("RowEndDate")
        ),
    )
    return TemporalTable(table.current, longer, table.key, versioned=False)


def _overlaps(spark: SparkSession, folder: str) -> DataFrame:
    return times_as_text(_overlapping(spark, folder).check_overlaps(), *_PERIOD)


def _overlaps_hot(spark: SparkSession, folder: str) -> DataFrame:
    """The same check, with users above half a percent of all rows cut into slices."""
    hot_rows = max(read_table(spark, folder, "events").count() // 200, 1)
    return times_as_text(_overlapping(spark, folder).check_overlaps(hot_rows), *_PERIOD)


_OVERLAPS = f"""
WITH {_STATES}, longer AS (
  SELECT user_id, event_id, event_type, value, s,
         CASE WHEN event_type = 'click' AND e <> TIMESTAMP '{OPEN}' THEN e + INTERVAL 1 DAY ELSE e END AS e
  FROM states
), running AS (
  SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS busy
  FROM longer
)
SELECT {_STATE_COLUMNS} FROM running WHERE busy > s
"""


def _current_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Current orders whose customer is not current any more."""
    customers = _customers(spark, folder).delete(F.col("c_mktsegment") == "HOUSEHOLD", NOW)
    orders = TemporalTable.create(read_table(spark, folder, "orders"), ["o_orderkey"], CREATED)
    key = ForeignKey("o_custkey", customers.current, "c_custkey", "customer")
    return orphans(orders.visible(), key).select("o_orderkey", "o_custkey", "o_totalprice")


_CURRENT_ORPHANS = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')
"""


def _customer_periods(spark: SparkSession, folder: str) -> TemporalTable:
    """Furniture customers pause in 1998, machinery ones change without a pause, household ones left."""
    rows = read_table(spark, folder, "customer").select("c_custkey", "c_mktsegment")

    def period(segments: list[str], start: str, end: str) -> DataFrame:
        return rows.where(F.col("c_mktsegment").isin(segments)).withColumns(
            {"RowStartDate": moment(start), "RowEndDate": moment(end)}
        )

    history = (
        period(["FURNITURE"], "1994-01-01", "1998-01-01")
        .unionByName(period(["MACHINERY"], "1994-01-01", "1997-01-01"))
        .unionByName(period(["HOUSEHOLD"], "1994-01-01", "2000-01-01"))
    )
    current = (
        period(["FURNITURE"], "1999-01-01", OPEN)
        .unionByName(period(["MACHINERY"], "1997-01-01", OPEN))
        .unionByName(period(["BUILDING"], "1996-01-01", OPEN))
    )
    return TemporalTable(current, history, ("c_custkey",))


def _order_year(spark: SparkSession, folder: str) -> TemporalTable:
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").alias("RowStartDate"),
        (F.col("o_orderdate") + F.make_dt_interval(days=F.lit(60))).alias("RowEndDate"),
    )
    return TemporalTable(orders.where(F.lit(False)), orders, ("o_orderkey",))


def _fk_gaps(spark: SparkSession, folder: str) -> DataFrame:
    gaps = temporal_fk_gaps(_order_year(spark, folder), _customer_periods(spark, folder), "o_custkey", "c_custkey")
    return times_as_text(gaps, *_PERIOD)


_FK_GAPS = f"""
WITH life AS (
  SELECT c_custkey, unnest(CASE c_mktsegment
      WHEN 'FURNITURE' THEN [TIMESTAMP '1994-01-01', TIMESTAMP '1999-01-01']
      WHEN 'MACHINERY' THEN [TIMESTAMP '1994-01-01']
      WHEN 'HOUSEHOLD' THEN [TIMESTAMP '1994-01-01']
      WHEN 'BUILDING' THEN [TIMESTAMP '1996-01-01'] END) AS s,
    unnest(CASE c_mktsegment
      WHEN 'FURNITURE' THEN [TIMESTAMP '1998-01-01', TIMESTAMP '{OPEN}']
      WHEN 'MACHINERY' THEN [TIMESTAMP '{OPEN}']
      WHEN 'HOUSEHOLD' THEN [TIMESTAMP '2000-01-01']
      WHEN 'BUILDING' THEN [TIMESTAMP '{OPEN}'] END) AS e
  FROM customer
)
SELECT o_orderkey, o_custkey, {sql_time('o_orderdate', 'RowStartDate')},
       {sql_time('o_orderdate + INTERVAL 60 DAY', 'RowEndDate')}
FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM life WHERE c_custkey = o_custkey AND s <= o_orderdate
                  AND e >= o_orderdate + INTERVAL 60 DAY)
"""


def _fk_gaps_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Customers against their nations, with nations above half a percent of all rows cut into slices.

    Nations of region 0 pause in 1996, those of region 1 end in 1999, the others start in 1995.
    """
    nation = read_table(spark, folder, "nation").select("n_nationkey", "n_regionkey")

    def period(regions: Column, start: str, end: str) -> DataFrame:
        return nation.where(regions).withColumns({"RowStartDate": moment(start), "RowEndDate": moment(end)})

    region = F.col("n_regionkey")
    history = period(region == 0, "1990-01-01", "1996-01-01").unionByName(
        period(region == 1, "1990-01-01", "1999-01-01")
    )
    current = period(region == 0, "1997-01-01", OPEN).unionByName(period(region > 1, "1995-03-01", OPEN))
    nations = TemporalTable(current, history, ("n_nationkey",))
    rows = read_table(spark, folder, "customer").select(
        "c_custkey",
        "c_nationkey",
        (moment("1995-01-01") + F.make_dt_interval(days=F.floor(F.abs("c_acctbal")).cast("int"))).alias("RowStartDate"),
    )
    rows = rows.withColumn("RowEndDate", F.col("RowStartDate") + F.make_dt_interval(days=F.lit(90)))
    customers = TemporalTable(rows, rows.where(F.lit(False)), ("c_custkey",))
    hot_rows = max(rows.count() // 200, 1)
    gaps = temporal_fk_gaps(customers, nations, "c_nationkey", "n_nationkey", hot_rows)
    return times_as_text(gaps, *_PERIOD)


_FK_GAPS_HOT = f"""
WITH life AS (
  SELECT n_nationkey, TIMESTAMP '1990-01-01' AS s, TIMESTAMP '1996-01-01' AS e FROM nation WHERE n_regionkey = 0
  UNION ALL SELECT n_nationkey, TIMESTAMP '1997-01-01', TIMESTAMP '{OPEN}' FROM nation WHERE n_regionkey = 0
  UNION ALL SELECT n_nationkey, TIMESTAMP '1990-01-01', TIMESTAMP '1999-01-01' FROM nation WHERE n_regionkey = 1
  UNION ALL SELECT n_nationkey, TIMESTAMP '1995-03-01', TIMESTAMP '{OPEN}' FROM nation WHERE n_regionkey > 1
), rows_at AS (
  SELECT c_custkey, c_nationkey, TIMESTAMP '1995-01-01' + floor(abs(c_acctbal))::INTEGER * INTERVAL 1 DAY AS s
  FROM customer
)
SELECT c_custkey, c_nationkey, {sql_time('s', 'RowStartDate')}, {sql_time('s + INTERVAL 90 DAY', 'RowEndDate')}
FROM rows_at r
WHERE NOT EXISTS (SELECT 1 FROM life l WHERE l.n_nationkey = r.c_nationkey AND l.s <= r.s
                  AND l.e >= r.s + INTERVAL 90 DAY)
"""


def _visible(spark: SparkSession, folder: str) -> DataFrame:
    return user_states(spark, folder).visible()


_VISIBLE = f"WITH {_STATES} SELECT user_id, event_id, event_type, value FROM states WHERE e = TIMESTAMP '{OPEN}'"


def _joined(spark: SparkSession, folder: str) -> DataFrame:
    """Current orders with their current customer, both starts side by side."""
    orders = TemporalTable.create(
        read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_orderkey"], F.col("o_orderdate")
    )
    joined = _customers(spark, folder).join_current(
        orders, F.col("c_custkey") == F.col("o_custkey"), ("customer_", "order_")
    )
    picked = joined.select("o_orderkey", "c_name", "customer_RowStartDate", "order_RowStartDate")
    return times_as_text(picked, "customer_RowStartDate", "order_RowStartDate")


_JOINED = f"""
SELECT o_orderkey, c_name, '2020-01-01 00:00:00.000000' AS "customer_RowStartDate",
       {sql_time('o_orderdate', '"order_RowStartDate"')}
FROM orders JOIN customer ON c_custkey = o_custkey
"""

# A pair put together by hand: errors end before they start, purchases begin an hour early, users who
# signed up last have that row twice, and users who clicked last have a current row that has ended.


def _faulty(spark: SparkSession, folder: str) -> TemporalTable:
    table = user_states(spark, folder)
    kind, hour = F.col("event_type"), F.make_dt_interval(hours=F.lit(1))
    begun = F.col("RowStartDate")
    history = table.history.withColumns(
        {
            "RowEndDate": F.when(kind == "error", begun - hour).otherwise(F.col("RowEndDate")),
            "RowStartDate": F.when(kind == "purchase", begun - hour).otherwise(begun),
        }
    )
    current = table.current.withColumn("RowEndDate", F.when(kind == "click", moment("2030-01-01")).otherwise(F.col("RowEndDate")))
    twice = current.unionByName(current.where(kind == "signup"))
    return TemporalTable(twice, history, table.key, versioned=False)


def _consistency(spark: SparkSession, folder: str) -> DataFrame:
    return _faulty(spark, folder).consistency()


_CONSISTENCY = f"""
WITH {_STATES}, stored AS (
  SELECT user_id, e = TIMESTAMP '{OPEN}' AS is_current,
         CASE WHEN e < TIMESTAMP '{OPEN}' AND event_type = 'purchase' THEN s - INTERVAL 1 HOUR ELSE s END AS s,
         CASE WHEN e < TIMESTAMP '{OPEN}' AND event_type = 'error' THEN s - INTERVAL 1 HOUR
              WHEN e = TIMESTAMP '{OPEN}' AND event_type = 'click' THEN TIMESTAMP '2030-01-01' ELSE e END AS e
  FROM states
  UNION ALL SELECT user_id, true, s, e FROM states WHERE e = TIMESTAMP '{OPEN}' AND event_type = 'signup'
), busy AS (
  SELECT *, max(CASE WHEN s < e THEN e END)
    OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until
  FROM stored
), marked AS (
  SELECT user_id, is_current, s > e AS is_reversed, coalesce(s < e AND until > s, false) AS has_overlap,
         is_current AND e < TIMESTAMP '{OPEN}' AS has_ended
  FROM busy
), counts AS (
  SELECT user_id, count_if(is_reversed) AS n_reversed, count_if(has_overlap) AS n_overlaps, count_if(has_ended) AS n_ended,
         greatest(count_if(is_current) - 1, 0) AS n_repeated
  FROM marked GROUP BY user_id
)
SELECT 'ends before it starts' AS rule, count_if(n_reversed > 0)::BIGINT AS keys, coalesce(sum(n_reversed), 0)::BIGINT AS rows FROM counts
UNION ALL SELECT 'overlaps an earlier version', count_if(n_overlaps > 0)::BIGINT, coalesce(sum(n_overlaps), 0)::BIGINT FROM counts
UNION ALL SELECT 'current row has ended', count_if(n_ended > 0)::BIGINT, coalesce(sum(n_ended), 0)::BIGINT FROM counts
UNION ALL SELECT 'several current rows', count_if(n_repeated > 0)::BIGINT, coalesce(sum(n_repeated), 0)::BIGINT FROM counts
"""

QUERIES = {
    "temporal_all_versions": Query(_all_versions, _states_sql("true")),
    "temporal_as_of": Query(_as_of, _states_sql(f"s <= TIMESTAMP '{HIGH}' AND e > TIMESTAMP '{HIGH}'")),
    "temporal_from_to": Query(_from_to, _states_sql(f"s < TIMESTAMP '{HIGH}' AND e > TIMESTAMP '{LOW}'")),
    "temporal_between": Query(_between, _states_sql(f"s <= TIMESTAMP '{HIGH}' AND e > TIMESTAMP '{LOW}'")),
    "temporal_contained_in": Query(
        _contained_in, _states_sql(f"s >= TIMESTAMP '{LOW}' AND e <= TIMESTAMP '{HIGH}'")
    ),
    "temporal_boundaries": Query(_boundaries, _BOUNDARIES),
    "temporal_changes": Query(_changed, _CHANGED),
    "temporal_back_dated": Query(_back_dated, _BACK_DATED),
    "temporal_merge": Query(_merged, _MERGED),
    "temporal_column_changes": Query(_columns_changed, _COLUMNS_CHANGED),
    "temporal_manual_history": Query(_loaded_by_hand, _LOADED_BY_HAND),
    "temporal_reversed_periods": Query(_reversed_periods, _REVERSED),
    "temporal_overlaps": Query(_overlaps, _OVERLAPS),
    "temporal_overlaps_hot_keys": Query(_overlaps_hot, _OVERLAPS),
    "temporal_current_orphans": Query(_current_orphans, _CURRENT_ORPHANS),
    "temporal_foreign_key_gaps": Query(_fk_gaps, _FK_GAPS),
    "temporal_foreign_key_gaps_hot_keys": Query(_fk_gaps_hot, _FK_GAPS_HOT),
    "temporal_hidden_periods": Query(_visible, _VISIBLE),
    "temporal_current_join": Query(_joined, _JOINED),
    "temporal_as_of_pruned": Query(_as_of_pruned, _AS_OF_PRUNED),
    "temporal_consistency": Query(_consistency, _CONSISTENCY),
}
