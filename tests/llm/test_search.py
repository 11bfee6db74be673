"""Exact top-k search against all pairs."""

import math
import sys

import pytest

from tidemark.llm import topk
from tidemark.llm.queries import ORACLE_SQL, QUERIES

sys.path.append(str(__import__("pathlib").Path(__file__).parent.parent))
from oracle import connect  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, query_id string, score double"


def brute(rows, k, scale=256, chosen=lambda i: i % 50 == 0):
    good = [
        (r[0], [math.floor(scale * x) for x in r[1]])
        for r in rows
        if r[0] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1])
    ]
    queries = {}
    for i, v in good:
        if chosen(i):
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        scores = [
            (-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w, strict=True)))), i)
            for i, w in good
            if i != q and len(w) == len(v)
        ]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def found(df, k, **more):
    asked = df.where("vec_id % 50 = 0")
    return sorted(tuple(r) for r in topk.top_k(asked, df, k=k, **more).collect())


def test_agrees_with_sql(spark, folder):
    result = QUERIES["op2_topk"](spark, folder)
    cursor = connect(folder).execute(ORACLE_SQL["op2_topk"])
    assert [d[0] for d in cursor.description] == result.columns
    assert sorted(map(tuple, result.collect())) == sorted(cursor.fetchall())


@pytest.mark.parametrize("k", [1, 3, 100])
def test_ties_copies_and_bad_vectors(frame, k):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7) / 8, -0.5, (i * i % 11) / 16], "q", 0.0) for i in range(130)]
    rows += [(i, [0.5, 0.5, 0.5], None, None) for i in range(130, 190)]  # a third are copies
    rows += [(3, [0.25, 0.0, 1.0], "again", 1.0), (50, [9.0, 1.0, 0.0], "again", 1.0)]
    rows += [(200, None, None, None), (201, [], None, None), (202, [1.0, None, 2.0], None, None)]
    rows += [(250, [nan, 1.0, 1.0], None, None), (203, [inf, 1.0, 1.0], None, None), (None, [1.0, 1.0, 1.0], None, None)]
    rows += [(300, [1.0, 2.0], None, None), (301, [3.0, 4.0], None, None), (302, [3.0, 4.0], None, None)]
    assert found(frame(rows, SCHEMA), k) == brute(rows, k)


def test_small_blocks_give_the_same(frame):
    rows = [(i, [math.sin(i), math.cos(3 * i)], "", 0.0) for i in range(400)]
    assert found(frame(rows, SCHEMA), 4, block=2) == brute([(i, [*map(_float, v)], *r) for i, v, *r in rows], 4)


def _float(x):
    import numpy as np

    return float(np.float32(x))


def test_huge_components_are_exact(frame):
    rows = [(50 * i, [2.0**30 * (i + 1), 2.0**20, -(2.0**45)], "", 0.0) for i in range(6)]
    rows += [(50 * i + 1, [2.0**100, -(2.0**60), float(i)], "", 0.0) for i in range(4)]
    assert found(frame(rows, SCHEMA), 3) == brute(rows, 3)


def test_empty_tables(frame, spark):
    empty = spark.createDataFrame([], SCHEMA)
    rows = [(1, [1.0], "", 0.0)]
    assert found(empty, 3) == []
    assert topk.top_k(empty, frame(rows, SCHEMA), k=3).collect() == []
    assert topk.top_k(frame(rows, SCHEMA), empty, k=3).collect() == []
