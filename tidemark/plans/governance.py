"""Encryption, masking, watermarks, profiles, files and fixtures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.durable import settle
from tidemark.functions.moments import moment
from tidemark.operators import fixtures, profile, protection, watermark
from tidemark.operators.compare import table_diff
from tidemark.plans.query import Query, sql_time, time_text, times_as_text
from tidemark.sources.files import PIECE, load_files
from tidemark.sources.tables import TABLES, read_table, read_tables
from tidemark.spec import ForeignKey, TableSpec

# Protection. The keys below protect sample data in checks and nothing else.


def _provider() -> protection.GrantedKeys:
    return protection.GrantedKeys(
        secrets={"sample": b"0123456789abcdef", "other": b"fedcba9876543210"},
        grants={"sample": ["clerk"], "other": ["clerk"]},
    )


def _encrypted(spark: SparkSession, folder: str) -> DataFrame:
    key = _provider().open("sample", "clerk")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    old = protection.encrypt(orders, "o_orderdate", "date_cipher", key)
    new = orders.withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return protection.insert_encrypted(old, new, {"o_orderdate": "date_cipher"}, key)


def _decrypted(spark: SparkSession, folder: str) -> DataFrame:
    key = _provider().open("sample", "clerk")
    plain = protection.decrypt(_encrypted(spark, folder), "date_cipher", "order_date", "timestamp_ntz", key)
    return plain.select(
        "o_orderkey", time_text("order_date").alias("order_date"), F.octet_length("date_cipher").alias("cipher_bytes")
    )


# 12 bytes of nonce, 19 of text and 16 of authentication tag.
_DECRYPTED = f"""
SELECT o_orderkey, {sql_time('o_orderdate', 'order_date')}, 12 + 19 + 16 AS cipher_bytes FROM orders
UNION ALL SELECT -1 - o_orderkey, {sql_time('o_orderdate')}, 12 + 19 + 16 FROM orders
"""


def _no_key(spark: SparkSession, folder: str) -> DataFrame:
    """Without the key, and with one that does not fit, the value is NULL and nothing fails."""
    rows = _encrypted(spark, folder)
    rows = protection.decrypt(rows, "date_cipher", "closed", "timestamp_ntz", None)
    rows = protection.decrypt(rows, "date_cipher", "unfit", "timestamp_ntz", _provider().open("other", "clerk"))
    return rows.select("o_orderkey", F.col("closed").isNull().alias("closed_is_null"), F.col("unfit").isNull().alias("unfit_is_null"))


_NO_KEY = """
SELECT o_orderkey, true AS closed_is_null, true AS unfit_is_null FROM orders
UNION ALL SELECT -1 - o_orderkey, true, true FROM orders
"""


def _masked(spark: SparkSession, folder: str) -> DataFrame:
    return protection.mask_columns(read_table(spark, folder, "customer"), ["c_name", "c_acctbal"])


_MASKED = """
SELECT c_custkey, CASE WHEN c_name IS NOT NULL THEN 'XXXX' END AS c_name, c_nationkey,
       CASE WHEN c_acctbal IS NOT NULL THEN 0.0::DOUBLE END AS c_acctbal, c_mktsegment FROM customer
"""


def _masked_any_script(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of letters without case, of digits and of signs are hidden like any other."""
    suppliers = read_table(spark, folder, "supplier").select(
        "s_suppkey",
        F.when(F.col("s_suppkey") % 3 == 0, F.lit("漢字"))
        .when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("#"), F.col("s_suppkey").cast("string")))
        .alias("note"),
    )
    return protection.mask_columns(suppliers, ["note"])


_MASKED_ANY = "SELECT s_suppkey, CASE WHEN s_suppkey % 3 < 2 THEN 'XXXX' END AS note FROM supplier"


def _encrypted_instants(spark: SparkSession, folder: str) -> DataFrame:
    """Instants written under one zone's clock and read under another's stay the same instants."""
    key = _provider().open("sample", "clerk")
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", F.timestamp_micros(F.col("o_orderkey") * 3_600_000_123).alias("at")
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        cipher = settle(protection.encrypt(orders, "at", "cipher", key).drop("at"), "cipher")
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        plain = settle(protection.decrypt(cipher, "cipher", "at", "timestamp", key), "plain")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return plain.select("o_orderkey", F.unix_micros("at").alias("micros"))


_ENCRYPTED_INSTANTS = "SELECT o_orderkey, o_orderkey * 3600000123 AS micros FROM orders"

# Watermarks. Our tables have no modification columns by the usual names, so some are given them.


def _loaded_tables(spark: SparkSession, folder: str) -> dict[watermark.Name, DataFrame]:
    return {
        ("sales", "orders"): read_table(spark, folder, "orders").withColumnRenamed("o_orderdate", "LastModified"),
        ("sales", "lineitem"): read_table(spark, folder, "lineitem").withColumnRenamed("l_shipdate", "Created"),
        ("web", "events"): read_table(spark, folder, "events").withColumns(
            {"LastChange": F.col("ts"), "Created": F.col("ts"), "DateLastModified": F.lit(None).cast("timestamp_ntz")}
        ),
        ("archive", "orders"): read_table(spark, folder, "orders").withColumnRenamed("o_orderdate", "LogDate"),
        ("zExceptionSales", "part"): read_table(spark, folder, "part").withColumn("LastModified", moment("2020-01-01")),
        ("sales", "customer"): read_table(spark, folder, "customer"),
    }


def _watermark_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The chosen columns, each with how many rows of its table a load would look at."""
    tables = _loaded_tables(spark, folder)
    chosen = watermark.watermark_columns(watermark.columns_frame(spark, tables), default=watermark.FULL_LOAD_COLUMN)
    counts = profile.table_counts({f"{schema}.{table}": df for (schema, table), df in tables.items()})
    named = chosen.withColumn("table_name", F.concat_ws(".", "schemaname", "tablename"))
    return named.join(counts, "table_name").drop("table_name")


# archive.orders has only a "created" column, but another orders table has a "modified" one.
_WATERMARK_COLUMNS = """
SELECT 'sales' AS schemaname, 'orders' AS tablename, 'LastModified' AS columnname, count(*) AS row_count FROM orders
UNION ALL SELECT 'sales', 'lineitem', 'Created', count(*) FROM lineitem
UNION ALL SELECT 'web', 'events', 'LastChange', count(*) FROM events
UNION ALL SELECT 'web', 'events', 'DateLastModified', count(*) FROM events
UNION ALL SELECT 'archive', 'orders', 'DWLoadDate', count(*) FROM orders
UNION ALL SELECT 'sales', 'customer', 'DWLoadDate', count(*) FROM customer
"""


def _watermark_values(spark: SparkSession, folder: str) -> DataFrame:
    tables = _loaded_tables(spark, folder)
    chosen = watermark.watermark_columns(watermark.columns_frame(spark, tables))
    # One row per watermark column of the catalog, not per row of a table.
    values = watermark.max_watermarks(tables, [tuple(row) for row in chosen.collect()])
    return times_as_text(values, "watermark")


_WATERMARK_VALUES = f"""
SELECT 'sales' AS schemaname, 'orders' AS tablename, 'LastModified' AS columnname,
       {sql_time('max(o_orderdate)', 'watermark')} FROM orders
UNION ALL SELECT 'sales', 'lineitem', 'Created', {sql_time('max(l_shipdate)')} FROM lineitem
UNION ALL SELECT 'web', 'events', 'LastChange', {sql_time('max(ts)')} FROM events
"""


def _watermark_update(spark: SparkSession, folder: str) -> DataFrame:
    """A task per customer, an instance per nation, a database per region."""
    customer = read_table(spark, folder, "customer")
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    control = customer.select(
        F.col("c_custkey").alias("TaskID"), F.col("c_nationkey").alias("DatabaseID"), moment("2000-01-01").alias("LoadWatermark")
    )
    tasks = customer.select(F.col("c_custkey").alias("TaskID"), F.col("c_mktsegment").alias("TaskName"))
    instances = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("DatabaseID"), F.col("r_name").alias("DatabaseName"), F.col("n_name").alias("InstanceName")
    )
    databases = region.select(F.col("r_name").alias("DatabaseName"))
    value = read_table(spark, folder, "orders").agg(F.max("o_orderdate")).first()[0]
    name = nation.where(F.col("n_nationkey") == 7).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    database = name.select("r_name").first()[0]
    updated = watermark.update_watermarks(
        control, tasks, instances, databases, "BUILDING", "NATION_7", database, value
    )
    return times_as_text(updated, "LoadWatermark")


_WATERMARK_UPDATE = f"""
SELECT c_custkey AS "TaskID", c_nationkey AS "DatabaseID",
       CASE WHEN c_mktsegment = 'BUILDING' AND n_name = 'NATION_7'
            THEN (SELECT {sql_time('max(o_orderdate)')} FROM orders)
            ELSE '2000-01-01 00:00:00.000000' END AS "LoadWatermark"
FROM customer JOIN nation ON n_nationkey = c_nationkey
"""


def _since(spark: SparkSession, folder: str) -> DataFrame:
    tables = {("sales", "orders"): read_table(spark, folder, "orders"), ("web", "events"): read_table(spark, folder, "events")}
    control = [("sales", "orders", "o_orderdate"), ("web", "events", None)]
    slices = watermark.incremental_slices(tables, control, "2000-06-01")
    return times_as_text(slices["sales", "orders", "o_orderdate"], "o_orderdate")


_SINCE = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {sql_time('o_orderdate', 'o_orderdate')}, o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-01'
"""



def _since_two_columns(spark: SparkSession, folder: str) -> DataFrame:
    """A table with two watermark columns, one of them NULL for most rows: a slice for each."""
    events = read_table(spark, folder, "events").select(
        "event_id", F.col("ts").alias("LastChange"), F.when(F.col("event_type") == "error", F.col("ts")).alias("DateLastModified")
    )
    control = [("web", "events", "LastChange"), ("web", "events", "DateLastModified")]
    bound = events.agg(F.date_trunc("day", F.max("LastChange"))).first()[0]
    slices = watermark.incremental_slices({("web", "events"): events}, control, bound)
    parts = [part.select("event_id", F.lit(name[2]).alias("column_name")) for name, part in slices.items()]
    return parts[0].unionByName(parts[1])


_SINCE_TWO = """
WITH bound AS (SELECT date_trunc('day', max(ts)) AS low FROM events)
SELECT event_id, 'LastChange' AS column_name FROM events, bound WHERE ts >= low
UNION ALL SELECT event_id, 'DateLastModified' FROM events, bound WHERE ts >= low AND event_type = 'error'
"""

# Profiles and files


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.table_counts(read_tables(spark, folder))


_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)


def _columns(spark: SparkSession, folder: str) -> DataFrame:
    """Every column of every table, beside its table's size."""
    tables = read_tables(spark, folder)
    return profile.table_columns(tables).join(profile.table_counts(tables), "table_name")


_COLUMNS = f"""
SELECT c.table_name, c.ordinal_position::INTEGER AS ordinal_position, c.column_name,
       CASE c.data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
         WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
         ELSE c.data_type END AS data_type, n.row_count
FROM information_schema.columns c JOIN ({_COUNTS}) n ON n.table_name = c.table_name
"""


def _stale(spark: SparkSession, folder: str) -> DataFrame:
    dated = {
        "orders": (read_table(spark, folder, "orders"), "o_orderdate"),
        "lineitem": (read_table(spark, folder, "lineitem"), "l_shipdate"),
        "events": (read_table(spark, folder, "events"), "ts"),
    }
    return times_as_text(profile.stale_tables(dated, "2018-02-05"), "last_update")


_STALE = f"""
SELECT 'orders' AS table_name, {sql_time('max(o_orderdate)', 'last_update')} FROM orders
HAVING max(o_orderdate) < TIMESTAMP '2018-02-05'
UNION ALL SELECT 'lineitem', {sql_time('max(l_shipdate)')} FROM lineitem HAVING max(l_shipdate) < TIMESTAMP '2018-02-05'
UNION ALL SELECT 'events', {sql_time('max(ts)')} FROM events HAVING max(ts) < TIMESTAMP '2018-02-05'
"""


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """The table files themselves as rows: each blob is whole when its format's mark is at both ends."""
    files = load_files(spark, folder, "*.parquet", recursive=True, piece=PIECE)
    size = F.octet_length("content").cast("bigint")
    behind = F.col("length") - F.col("position") - size
    # A mark may lie across pieces: those that hold some of it are put together in order.
    first = F.when(F.col("position") < 4, F.struct("position", F.substring("content", 1, 4).alias("mark")))
    last = F.when(behind < 4, F.struct("position", F.substring("content", -4, 4).alias("mark")))
    pieces = files.groupBy("path", "name", "length").agg(
        F.sum(size).alias("size"), F.collect_list(first).alias("first"), F.collect_list(last).alias("last")
    )

    def joined(marks: str) -> Column:
        return F.aggregate(F.array_sort(marks), F.lit("").cast("binary"), lambda whole, piece: F.concat(whole, piece["mark"]))

    return pieces.select(
        "name",
        F.substring(joined("first"), 1, 4).cast("string").alias("head"),
        F.substring(joined("last"), -4, 4).cast("string").alias("tail"),
        (F.col("size") == F.col("length")).alias("is_whole"),
    )


_FILES = " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS name, 'PAR1' AS head, 'PAR1' AS tail, true AS is_whole" for t in TABLES
)


def _copied(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    return profile.copy_columns(lines, {"l_orderkey": "order_key", "l_linenumber": "line_number", "l_quantity": "quantity"})


# Fixtures over whole tables

_FIXTURE_NOW = dt.datetime(2024, 6, 1, 12)
_ORDER_SPEC = TableSpec(keys=("o_orderkey",))


def _fixture_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One fixture row per order, then the same rows with the first versioned column changed."""
    orders = read_table(spark, folder, "orders")
    base = fixtures.fixture_like(orders, _ORDER_SPEC.keys, _FIXTURE_NOW)
    changed = fixtures.perturb(base, _ORDER_SPEC, _FIXTURE_NOW)
    both = base.withColumn("kind", F.lit("base")).unionByName(changed.withColumn("kind", F.lit("changed")))
    return times_as_text(both, "o_orderdate")


_FIXTURE_ROWS = """
SELECT o_orderkey, n::BIGINT AS o_custkey, 'A' AS o_orderstatus, 1.0::DOUBLE AS o_totalprice,
       '2024-06-01 12:00:00.000000' AS o_orderdate, 'A' AS o_orderpriority, kind
FROM orders, (VALUES (1, 'base'), (2, 'changed')) v(n, kind)
"""


def _fixture_unversioned(spark: SparkSession, folder: str) -> DataFrame:
    """The first column outside the hash changed: a day later, so nothing would be loaded."""
    orders = read_table(spark, folder, "orders").withColumnRenamed("o_orderdate", "LastModified")
    base = fixtures.fixture_like(orders, _ORDER_SPEC.keys, _FIXTURE_NOW)
    changed = fixtures.perturb(base, _ORDER_SPEC, _FIXTURE_NOW, versioned=False)
    difference = table_diff(changed, base).where(F.col("side") == "expected").drop("side", "copies")
    return times_as_text(difference, "LastModified")


_FIXTURE_UNVERSIONED = """
SELECT o_orderkey, 1::BIGINT AS o_custkey, 'A' AS o_orderstatus, 1.0::DOUBLE AS o_totalprice,
       '2024-06-02 12:00:00.000000' AS "LastModified", 'A' AS o_orderpriority FROM orders
"""


def _parent_fixtures(spark: SparkSession, folder: str) -> DataFrame:
    """Parents for every part and supplier the line items use, with suppliers left out once."""
    lines = read_table(spark, folder, "lineitem")
    schemas = {name: read_table(spark, folder, name).schema for name in ("part", "supplier")}
    keys = [
        ForeignKey("l_partkey", None, "p_partkey", "part"),
        ForeignKey("l_suppkey", None, "s_suppkey", "supplier"),
    ]
    filled = fixtures.parent_rows(lines, keys, schemas, _FIXTURE_NOW)
    without = fixtures.parent_rows(lines, keys, schemas, _FIXTURE_NOW, leave_out="supplier")
    part = filled["part"].select(F.lit("part").alias("parent"), F.col("p_partkey").alias("key"), F.col("p_name").alias("name"))
    supplier = filled["supplier"].select(F.lit("supplier"), "s_suppkey", "s_name")
    left_out = without["supplier"].select(F.lit("left out"), "s_suppkey", "s_name")
    return part.union(supplier).union(left_out)


_PARENT_FIXTURES = """
SELECT DISTINCT 'part' AS parent, l_partkey AS key, 'A' AS name FROM lineitem
UNION ALL SELECT DISTINCT 'supplier', l_suppkey, 'A' FROM lineitem
"""


def _view_fills_every_column(spark: SparkSession, folder: str) -> DataFrame:
    """A view of orders with their customers, over sources filled by type."""

    def view(sources: dict[str, DataFrame]) -> DataFrame:
        joined = sources["orders"].join(sources["customer"], F.col("o_custkey") == F.col("c_custkey"))
        return joined.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "c_name", "c_acctbal")

    tables = {name: read_table(spark, folder, name) for name in ("orders", "customer")}
    return fixtures.check_view(view, tables, spark, _FIXTURE_NOW, keys=["o_orderkey", "o_custkey", "c_custkey"])


_VIEW_FILLS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS filled_rows FROM orders"
    for c in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "c_name", "c_acctbal")
)


def _sample_shape(spark: SparkSession, folder: str) -> DataFrame:
    """A random data set as long as the line item table, with a user per supplier, and its bounds."""
    rows = read_table(spark, folder, "lineitem").count()
    users = fixtures.sample_users(spark, read_table(spark, folder, "supplier").count())
    data = fixtures.sample_data(spark, rows, seed=3, users=users.count())
    inside = (
        F.col("OtherDate").between(moment("2015-01-01"), moment("2015-12-31"))
        & F.col("VarcharColumn").rlike("^TEST([0-9]|[1-9][0-9]|100)$")
        & F.col("IntColumn").between(0, 100_000)
        & F.col("FloatColumn").between(0, 10_000)
    )
    return data.join(users, "UserID", "left").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(inside).alias("rows_in_bounds"),
        F.count("Username").alias("rows_with_user"),
        F.count_distinct("RowKey").alias("distinct_keys"),
    )


_SAMPLE_SHAPE = """
SELECT count(*) AS row_count, count(*) AS rows_in_bounds, count(*) AS rows_with_user, count(*) AS distinct_keys
FROM lineitem
"""

QUERIES = {
    "encrypt_and_decrypt": Query(_decrypted, _DECRYPTED),
    "decrypt_without_key": Query(_no_key, _NO_KEY),
    "mask_columns": Query(_masked, _MASKED),
    "watermark_columns": Query(_watermark_columns, _WATERMARK_COLUMNS),
    "watermark_values": Query(_watermark_values, _WATERMARK_VALUES),
    "watermark_update": Query(_watermark_update, _WATERMARK_UPDATE),
    "incremental_slice": Query(_since, _SINCE),
    "incremental_slice_two_columns": Query(_since_two_columns, _SINCE_TWO),
    "mask_any_script": Query(_masked_any_script, _MASKED_ANY),
    "encrypt_across_zones": Query(_encrypted_instants, _ENCRYPTED_INSTANTS),
    "table_counts": Query(_counts, _COUNTS),
    "table_columns": Query(_columns, _COLUMNS),
    "stale_tables": Query(_stale, _STALE),
    "files_as_rows": Query(_files, _FILES),
    "copy_columns": Query(
        _copied, "SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_quantity AS quantity FROM lineitem"
    ),
    "fixture_rows": Query(_fixture_rows, _FIXTURE_ROWS),
    "fixture_unversioned_change": Query(_fixture_unversioned, _FIXTURE_UNVERSIONED),
    "fixture_parents": Query(_parent_fixtures, _PARENT_FIXTURES),
    "view_fills_every_column": Query(_view_fills_every_column, _VIEW_FILLS),
    "sample_data_shape": Query(_sample_shape, _SAMPLE_SHAPE),
}
