"""A customer hierarchy with cycles, unknown parents and rows that are their own parent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import hierarchy as h
from tidemark.plans.query import Query
from tidemark.sources.tables import read_table


def customer_edges(spark: SparkSession, folder: str) -> h.Edges:
    """Customer ``k`` reports to ``k div 10``, except that some nations' customers are wired wrongly."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    parent = (
        F.when(key == 0, F.lit(0))
        .when(nation < 5, key.bitwiseXOR(F.lit(1)))
        .when(nation == 20, key * 10 + 3)
        .when(nation == 21, key)
        .when(nation == 22, F.lit(None))
        .otherwise(F.floor(key / 10))
    )
    rows = read_table(spark, folder, "customer").select(
        key.alias("OrganizationID"), parent.cast("bigint").alias("ParentOrganizationID"), "c_mktsegment"
    )
    return h.Edges(rows)


_EDGES = """
edges AS (
  SELECT c_custkey AS id, CASE WHEN c_custkey = 0 THEN 0 WHEN c_nationkey < 5 THEN xor(c_custkey, 1)
      WHEN c_nationkey = 20 THEN c_custkey * 10 + 3 WHEN c_nationkey = 21 THEN c_custkey
      WHEN c_nationkey = 22 THEN NULL ELSE c_custkey // 10 END AS parent, c_mktsegment
  FROM customer
)"""
_WALK = f"""
WITH RECURSIVE {_EDGES}, walk AS (
  SELECT id, parent AS ancestor, id::VARCHAR AS path, 0 AS distance FROM edges
  UNION ALL
  SELECT w.id, e.parent, w.path || ' > ' || e.id, w.distance + 1
  FROM walk w JOIN edges e ON e.id = w.ancestor AND e.parent <> e.id AND w.ancestor <> w.id
  WHERE w.distance < 50
)"""
_REMOVED = f"""
{_WALK}, circular AS (
  SELECT DISTINCT id FROM walk WHERE id = ancestor AND ancestor <> 0 AND distance > 0
), nested AS (
  SELECT id, parent FROM edges WHERE parent IN (SELECT id FROM circular) AND id NOT IN (SELECT id FROM circular)
), below AS (
  SELECT 1 AS level, id, parent FROM nested
  UNION ALL SELECT b.level + 1, e.id, e.parent FROM below b JOIN edges e ON e.parent = b.id
), removed AS (SELECT id FROM circular UNION SELECT id FROM nested UNION SELECT id FROM below)"""
_PATHS = f"""
{_REMOVED}, kept AS (SELECT * FROM edges WHERE id NOT IN (SELECT id FROM removed)),
paths AS (
  SELECT id, '/' AS path FROM kept WHERE id = 0
  UNION ALL SELECT k.id, p.path || k.id || '/' FROM kept k JOIN paths p ON k.parent = p.id WHERE k.id <> 0
)"""


def _ancestors(spark: SparkSession, folder: str) -> DataFrame:
    return h.ancestors(customer_edges(spark, folder))


def _circular(spark: SparkSession, folder: str) -> DataFrame:
    return h.circular(customer_edges(spark, folder))


def _nested(spark: SparkSession, folder: str) -> DataFrame:
    edges = customer_edges(spark, folder)
    return h.nested(edges, h.circular(edges))


def _descendants(spark: SparkSession, folder: str) -> DataFrame:
    edges = customer_edges(spark, folder)
    return h.descendants(edges, h.nested(edges, h.circular(edges)))


def _quarantine_clean(spark: SparkSession, folder: str) -> DataFrame:
    return h.quarantine(customer_edges(spark, folder), 7).clean


def _quarantine_exceptions(spark: SparkSession, folder: str) -> DataFrame:
    return h.quarantine(customer_edges(spark, folder), 7).exceptions


_QUARANTINE_CLEAN = f"""
{_REMOVED} SELECT id AS "OrganizationID", parent AS "ParentOrganizationID", c_mktsegment
FROM edges WHERE id NOT IN (SELECT id FROM removed)
"""
_QUARANTINE_EXCEPTIONS = f"""
{_REMOVED} SELECT id AS "OrganizationID", parent AS "ParentOrganizationID", c_mktsegment,
       7::BIGINT AS "ServerExecutionID", 0 AS "ErrorCode", 0 AS "ErrorColumn",
       'Circular ParentOrganizationID Reference' AS "ErrorDescription"
FROM edges WHERE id IN (SELECT id FROM removed)
"""


def _siblings(spark: SparkSession, folder: str) -> DataFrame:
    return h.sibling_number(customer_edges(spark, folder))


def _siblings_hot(spark: SparkSession, folder: str) -> DataFrame:
    """All customers of a nation are siblings: families above half a percent of all rows are cut into slices."""
    customer = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    edges = h.Edges(customer, "c_custkey", "c_nationkey")
    return h.sibling_number(edges, hot_rows=max(customer.count() // 200, 1))


_SIBLINGS = f"""
WITH {_EDGES} SELECT id AS "OrganizationID", parent AS "ParentOrganizationID", c_mktsegment,
       row_number() OVER (PARTITION BY parent ORDER BY id) AS "Num" FROM edges
"""


def _clean_paths(spark: SparkSession, folder: str) -> DataFrame:
    edges = customer_edges(spark, folder)
    return h.paths(edges.with_rows(h.quarantine(edges, 7).clean))


def _paths(spark: SparkSession, folder: str) -> DataFrame:
    return _clean_paths(spark, folder).select("id", "path")


def _depth_first(spark: SparkSession, folder: str) -> DataFrame:
    """The trail sorts depth first; here as its depth and its ids as text."""
    return _clean_paths(spark, folder).select(
        "id", F.size("trail").alias("depth"), F.array_join(F.col("trail").cast("array<string>"), "/").alias("trail_text")
    )


def _updated(spark: SparkSession, folder: str) -> DataFrame:
    """Building customers carry a stale path and household ones a right one where depth is one."""
    organization = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("OrganizationID"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("/stale/"))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit("/"), F.col("c_custkey").cast("string"), F.lit("/")))
        .alias("OrganizationHierarchyID"),
    )
    return h.update_if_changed(
        organization, _clean_paths(spark, folder), "OrganizationID", "OrganizationHierarchyID"
    )


_UPDATED = f"""
{_PATHS}, organization AS (
  SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'BUILDING' THEN '/stale/'
      WHEN c_mktsegment = 'HOUSEHOLD' THEN '/' || c_custkey || '/' END AS old FROM customer
)
SELECT o.id AS "OrganizationID", p.path AS "OrganizationHierarchyID", o.old IS DISTINCT FROM p.path AS changed
FROM organization o LEFT JOIN paths p ON p.id = o.id
"""


def _resolved(spark: SparkSession, folder: str) -> DataFrame:
    """Old exceptions of every customer; cycle exceptions go where a path exists by now."""
    edges = customer_edges(spark, folder)
    old = edges.df.select(
        "OrganizationID",
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("Orphan OrganizationID"))
        .otherwise(F.lit(h.CIRCULAR))
        .alias("ErrorDescription"),
    )
    table = _updated(spark, folder)
    return h.clear_resolved(old, table, "OrganizationID", "OrganizationHierarchyID")


_RESOLVED = f"""
{_PATHS}, old AS (
  SELECT id, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Orphan OrganizationID'
      ELSE 'Circular ParentOrganizationID Reference' END AS d FROM edges
)
SELECT id AS "OrganizationID", d AS "ErrorDescription" FROM old
WHERE d LIKE 'Orphan%' OR id NOT IN (SELECT id FROM paths)
"""

def _long_cycle_edges(spark: SparkSession, folder: str) -> h.Edges:
    """Customers in rings of 60, and customers of some nations below a member of the next ring."""
    key = F.col("c_custkey")
    ring = F.when(key % 60 == 59, key - 59).otherwise(key + 1)
    rows = read_table(spark, folder, "customer").select(
        key.alias("OrganizationID"),
        F.when(F.floor(key / 60) % 3 == 0, ring).otherwise(key - 60).cast("bigint").alias("ParentOrganizationID"),
    )
    return h.Edges(rows)


def _long_cycles(spark: SparkSession, folder: str) -> DataFrame:
    edges = _long_cycle_edges(spark, folder)
    members = h.circular(edges, root=-1).withColumn("kind", F.lit("member"))
    removed = h.quarantine(edges, 7).exceptions.select(F.col("OrganizationID").alias("id"), F.lit("removed").alias("kind"))
    return members.unionByName(removed)


# The last ring may lack members and is then a chain.
_LONG_CYCLES = """
WITH rings AS (
  SELECT c_custkey AS id, c_custkey // 60 AS ring, c_custkey // 60 % 3 AS place,
         (SELECT max(c_custkey) FROM customer) AS top FROM customer
), whole AS (SELECT *, (ring - place) * 60 + 59 <= top AS closed FROM rings)
SELECT id, 'member' AS kind FROM whole WHERE place = 0 AND closed
UNION ALL SELECT id, 'removed' FROM whole WHERE closed
"""


def several_parent_edges(spark: SparkSession, folder: str) -> h.Edges:
    """The customer hierarchy with a second parent for every third customer."""
    edges = customer_edges(spark, folder)
    second = read_table(spark, folder, "customer").where(F.col("c_custkey") % 3 == 0).select(
        F.col("c_custkey").alias("OrganizationID"),
        F.floor(F.col("c_custkey") / 7).cast("bigint").alias("ParentOrganizationID"),
        "c_mktsegment",
    )
    return edges.with_rows(edges.df.unionByName(second))


_SEVERAL = f"""
WITH RECURSIVE {_EDGES}, pairs AS (
  SELECT id, parent FROM edges UNION SELECT c_custkey, c_custkey // 7 FROM customer WHERE c_custkey % 3 = 0
), steps AS (SELECT id, parent FROM pairs WHERE parent <> id), up AS (
  SELECT id, parent AS ancestor FROM steps UNION SELECT u.id, s.parent FROM up u JOIN steps s ON s.id = u.ancestor
), members AS (SELECT DISTINCT id FROM up WHERE id = ancestor),
removed AS (SELECT id FROM members UNION SELECT id FROM up WHERE ancestor IN (SELECT id FROM members))"""


def _several_removed(spark: SparkSession, folder: str) -> DataFrame:
    return h.quarantine(several_parent_edges(spark, folder), 7).exceptions.select(F.col("OrganizationID").alias("id")).distinct()


def _several_circular(spark: SparkSession, folder: str) -> DataFrame:
    return h.circular(several_parent_edges(spark, folder))


def ring_edges(spark: SparkSession, folder: str) -> h.Edges:
    """All customers below the two that follow them: the first two thirds in one ring, the next sixth in a
    ladder that leads into it, the rest in a ladder that leads nowhere."""
    customer = read_table(spark, folder, "customer").select(F.col("c_custkey").cast("bigint").alias("id"))
    total = customer.count()
    ring, ladder = total * 2 // 3, total * 5 // 6
    rows = customer.select("id", F.explode(F.array(F.col("id") + 1, F.col("id") + 2)).alias("next"))
    key, after = F.col("id"), F.col("next")
    parent = F.when(key < ring, after % ring).when((key < ladder) & (after >= ladder), F.lit(0)).otherwise(after)
    return h.Edges(rows.select("id", parent.cast("bigint").alias("parent")), "id", "parent")


def _ring(spark: SparkSession, folder: str) -> DataFrame:
    edges = ring_edges(spark, folder)
    members = h.circular(edges, root=-1)
    removed = h.quarantine(edges, 7, members=members).exceptions.select("id").distinct()
    return members.withColumn("kind", F.lit("member")).unionByName(removed.withColumn("kind", F.lit("removed")))


_RING = """
WITH sized AS (SELECT c_custkey AS id, count(*) OVER () AS n FROM customer)
SELECT id, 'member' AS kind FROM sized WHERE id < n * 2 // 3
UNION ALL SELECT id, 'removed' FROM sized WHERE id < n * 5 // 6
"""


def _tree_of_two(spark: SparkSession, folder: str) -> h.Edges:
    """Every customer below two smaller ones."""
    key = F.col("c_custkey")
    rows = read_table(spark, folder, "customer").select(key.alias("id"))
    return h.Edges(
        rows.select("id", F.explode(F.array(F.floor(F.col("id") / 5), F.floor(F.col("id") / 3))).alias("parent")), "id", "parent"
    )


def _smallest(spark: SparkSession, folder: str) -> DataFrame:
    return h.paths(_tree_of_two(spark, folder), smallest=True).select("id", "path")


# Shortest first, then by the numbers on the way.
_SMALLEST = """
WITH RECURSIVE pairs AS (
  SELECT c_custkey AS id, c_custkey // 5 AS parent FROM customer UNION SELECT c_custkey, c_custkey // 3 FROM customer
), walks AS (
  SELECT 0::BIGINT AS id, []::BIGINT[] AS trail
  UNION ALL SELECT p.id, list_append(w.trail, p.id) FROM walks w JOIN pairs p ON p.parent = w.id AND p.id <> 0 AND p.id <> p.parent
), ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY len(trail), trail) AS place FROM walks)
SELECT id, '/' || list_aggregate(list_transform(trail, lambda x: x::VARCHAR || '/'), 'string_agg', '') AS path FROM ranked
WHERE place = 1 AND id <> 0 UNION ALL SELECT 0, '/' FROM customer WHERE c_custkey = 0
"""

QUERIES = {
    "hierarchy_ring_of_two_parents": Query(_ring, _RING),
    "hierarchy_long_cycle": Query(_long_cycles, _LONG_CYCLES),
    "hierarchy_several_parents_quarantine": Query(_several_removed, f"{_SEVERAL} SELECT id FROM removed"),
    "hierarchy_several_parents_circular": Query(_several_circular, f"{_SEVERAL} SELECT id FROM members WHERE id <> 0"),
    "hierarchy_smallest_paths": Query(_smallest, _SMALLEST),
    "hierarchy_ancestors": Query(_ancestors, f"{_WALK} SELECT id, ancestor, path, distance FROM walk"),
    "hierarchy_circular": Query(_circular, f"{_REMOVED} SELECT id FROM circular"),
    "hierarchy_nested": Query(_nested, f"{_REMOVED} SELECT id, parent FROM nested"),
    "hierarchy_descendants": Query(_descendants, f"{_REMOVED} SELECT level, id, parent FROM below"),
    "hierarchy_quarantine_clean": Query(_quarantine_clean, _QUARANTINE_CLEAN),
    "hierarchy_quarantine_exceptions": Query(_quarantine_exceptions, _QUARANTINE_EXCEPTIONS),
    "hierarchy_sibling_number": Query(_siblings, _SIBLINGS),
    "hierarchy_sibling_number_hot_keys": Query(
        _siblings_hot,
        """SELECT c_custkey, c_nationkey,
        row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS "Num" FROM customer""",
    ),
    "hierarchy_paths": Query(_paths, f"{_PATHS} SELECT id, path FROM paths"),
    "hierarchy_depth_first": Query(
        _depth_first,
        f"""{_PATHS} SELECT id, (length(path) - length(replace(path, '/', '')) - 1)::INTEGER AS depth,
        trim(path, '/') AS trail_text FROM paths""",
    ),
    "hierarchy_update_changed": Query(_updated, _UPDATED),
    "hierarchy_resolved_exceptions": Query(_resolved, _RESOLVED),
}
