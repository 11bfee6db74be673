"""Compare registered queries with DuckDB on the same files."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from tidemark.plans.registry import QUERIES
from tidemark.sources.tables import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def compare(connection: duckdb.DuckDBPyConnection, name: str, result: DataFrame) -> str:
    """An empty text when both engines agree, else what differs."""
    query = QUERIES[name]
    columns = sorted(result.columns)
    ours = Counter(tuple(row) for row in result.select(*columns).collect())
    if query.sql is None:
        return "" if ours else "no rows"
    answer = connection.execute(query.sql)
    names = [d[0] for d in answer.description]
    if sorted(names) != columns:
        return f"columns {columns} and {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(row[i] for i in order) for row in answer.fetchall())
    if not ours and not theirs:
        return "both empty"
    if ours == theirs:
        return ""
    only_ours, only_theirs = list((ours - theirs).items()), list((theirs - ours).items())
    return (
        f"{sum(ours.values())} and {sum(theirs.values())} rows; columns {columns}\n"
        f"  only Spark ({len(only_ours)}): {only_ours[:3]}\n  only SQL ({len(only_theirs)}): {only_theirs[:3]}"
    )


if __name__ == "__main__":
    from tidemark.session import local_session

    folder = sys.argv[1]
    session = local_session(8)
    db = connect(folder)
    for name in sys.argv[2:] or QUERIES:
        begun = time.time()
        problem = compare(db, name, QUERIES[name].run(session, folder))
        print(f"{'FAIL' if problem else 'ok':4} {time.time() - begun:6.1f}s {name} {problem}", flush=True)
