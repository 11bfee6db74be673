"""Exact top-k search by histogram selection.

Every candidate is scored against every query, in blocks: a bounded block of queries is sent to
all tasks, candidates stay where they lie. A pass does not keep scores but counts them: each task
sends one histogram per query, Spark adds them up, and the bin that holds the k-th score becomes
the range of the next pass, until it is one score wide. The last pass keeps what lies above the
k-th score and, of those equal to it, the smallest ids.

Vectors become integers, floor(scale * x). Vectors that are null or empty, that hold a null or a
number that is not finite, or whose id is null take no part; a candidate is only compared with
queries of its own dimension. Repeated rows are candidates of their own; a query's own id
never is its candidate. Where several query rows have one id, the first by components stands for
them. Equal scores go by the smaller id. Scores beyond a long stand as the largest or smallest long.
Empty tables on either side give an empty result. Only the named columns are read, so others cannot
clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import settle
from tidemark.llm.common import only
from tidemark.llm.shipping import ship

#: Queries sent out at once: with 1,000 dimensions, 16 MB.
BLOCK = 2048
BINS = 256
_EXACT = 1 << 53
_LONG = 1 << 63
#: Cells of a score matrix worked on at once.
_CELLS = 1 << 21


def as_integers(df: DataFrame, vector: str, scale: float) -> DataFrame:
    """Valid vectors alone, with ``v``: floor(scale * x) of each component as a double."""
    x = F.col(vector)
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    floored = F.transform(x, lambda c: _floor(c, scale))
    return df.where(x.isNotNull() & (F.size(x) > 0) & whole).withColumn("v", floored)


def _floor(c: Column, scale: float) -> Column:
    scaled = c.cast("double") * F.lit(float(scale))
    # Doubles of 2^53 and more are whole already; floor() would squeeze them into a long.
    return F.when(F.abs(scaled) < float(_EXACT), F.floor(scaled).cast("double")).otherwise(scaled)


def _matrix(column: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the wanted dimension as a matrix, and which rows they are."""
    sizes = np.diff(column.offsets.to_numpy())
    fits = sizes == dimension
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values[np.repeat(fits, sizes)].reshape(-1, dimension), fits


def _scores(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact inner products as longs."""
    if not rows.size:
        return np.zeros((len(rows), len(queries)), np.int64)
    bound = float(np.abs(rows).max()) * float(np.abs(queries).max()) * rows.shape[1]
    if bound < _EXACT:
        return (rows @ queries.T).astype(np.int64)
    if bound < _LONG / 2:
        return rows.astype(np.int64) @ queries.astype(np.int64).T
    exact = np.array([[int(x) for x in r] for r in rows], object) @ np.array([[int(x) for x in q] for q in queries], object).T
    return np.clip(exact, -_LONG, _LONG - 1).astype(np.int64)


def _scored(batches: Iterator[pa.RecordBatch], ids: np.ndarray, queries: np.ndarray):
    """Blocks of (candidate ids, scores, whether a candidate of the query)."""
    for batch in batches:
        rows, fits = _matrix(batch.column(1), queries.shape[1])
        own = batch.column(0).to_numpy(zero_copy_only=False)[fits]
        step = max(1, _CELLS // max(1, len(ids)))
        for at in range(0, len(own), step):
            part = own[at : at + step]
            yield part, _scores(rows[at : at + step], queries), part[:, None] != ids[None, :]


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    scale: float = 256,
    block: int = BLOCK,
) -> DataFrame:
    """Each query's ``k`` highest scores, ties to the smaller id: (query_id, rank, <key>, score)."""
    spark = candidates.sparkSession
    ship(spark)
    rows = as_integers(only(candidates, id=key, x=vector), "x", scale).where("id is not null").select(F.col("id").cast("long"), "v")
    asked = as_integers(only(queries, id=key, x=vector), "x", scale).where("id is not null")
    asked = asked.groupBy(F.col("id").cast("long").alias("id")).agg(F.min("v").alias("v"))
    # Queries in numbered blocks, each of a size that a task can hold.
    count = asked.count()
    blocks = max(1, -(-count // block))
    placed = settle(asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(2 * blocks))), "queries")
    names = [r["block"] for r in placed.select("block").distinct().collect()]
    found = [_block(placed.where(F.col("block") == b).select("id", "v"), rows, key, k) for b in sorted(names)]
    if not found:
        return _result(spark.createDataFrame([], "query_id long, id long, score long"), key, k)
    return _result(reduce(DataFrame.union, found), key, k)


def _result(found: DataFrame, key: str, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(key), "score")
    )


def _block(asked: DataFrame, rows: DataFrame, key: str, k: int) -> DataFrame:
    """Candidates at or above the k-th score of a block's queries; a bounded superset by ties."""
    spark = rows.sparkSession
    held = asked.toArrow()
    sizes = np.diff(held.column("v").combine_chunks().offsets.to_numpy())
    parts = []
    for dimension in np.unique(sizes).tolist():
        matrix, fits = _matrix(held.column("v").combine_chunks(), dimension)
        ids = held.column("id").to_numpy()[fits]
        parts.append(_select(spark, rows, ids, matrix, k))
    return reduce(DataFrame.union, parts)


def _select(spark, rows: DataFrame, ids: np.ndarray, matrix: np.ndarray, k: int) -> DataFrame:
    n = len(ids)
    sent = spark.sparkContext.broadcast((ids, matrix))

    def extent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.full(n, _LONG - 1, np.int64)
        high = np.full(n, -_LONG, np.int64)
        count = np.zeros(n, np.int64)
        for _, scores, other in _scored(batches, *sent.value):
            low = np.minimum(low, np.where(other, scores, _LONG - 1).min(axis=0))
            high = np.maximum(high, np.where(other, scores, -_LONG).max(axis=0))
            count += other.sum(axis=0)
        some = count > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.flatnonzero(some)), pa.array(low[some]), pa.array(high[some]), pa.array(count[some])],
            ["q", "low", "high", "n"],
        )

    low, high, want = [0] * n, [-1] * n, [0] * n
    ends = rows.mapInArrow(extent, "q long, low long, high long, n long").groupBy("q")
    for r in ends.agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).collect():
        low[r["q"]], high[r["q"]], want[r["q"]] = r["low"], r["high"], min(k, r["n"])

    # [low, high] holds the score at place ``want``, counted from the top of that range.
    while any(a < b for a, b in zip(low, high, strict=True)):
        width = np.array([max(1, -(-(b - a + 1) // BINS)) for a, b in zip(low, high, strict=True)], np.uint64)
        bounds = (np.array(low, np.int64), np.array(high, np.int64), width)
        open_ = np.array([a < b for a, b in zip(low, high, strict=True)])

        def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, matrix = sent.value
            lows, highs, widths = (x[open_] for x in bounds)
            counts = np.zeros(open_.sum() * BINS, np.int64)
            first = np.arange(open_.sum()) * BINS
            for _, scores, other in _scored(batches, ids[open_], matrix[open_]):
                inside = other & (scores >= lows) & (scores <= highs)
                bins = (scores.view(np.uint64) - lows.view(np.uint64)) // widths
                cells = np.where(inside, bins.astype(np.int64) + first, -1)
                counts += np.bincount(cells[cells >= 0], minlength=len(counts))
            at = np.flatnonzero(counts)
            q = np.flatnonzero(open_)[at // BINS]
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(at % BINS), pa.array(counts[at])], ["q", "bin", "n"])

        summed = rows.mapInArrow(histogram, "q long, bin long, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        above = Window.partitionBy("q").orderBy(F.col("bin").desc())
        running = summed.withColumn("upto", F.sum("n").over(above))
        needs = spark.createDataFrame([(q, want[q]) for q in np.flatnonzero(open_).tolist()], "q long, want long")
        hit = running.join(needs, "q").where((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("n") < F.col("want")))
        for r in hit.collect():  # one row per query of the block
            q, at = r["q"], r["bin"]
            begin, step = low[q], int(width[q])
            want[q] -= r["upto"] - r["n"]
            low[q], high[q] = begin + at * step, min(high[q], begin + (at + 1) * step - 1)

    threshold = np.array(low, np.int64)
    there = np.array(want) > 0

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, _ = sent.value
        ties: list[np.ndarray] = [np.zeros(0, np.int64)] * n
        for own, scores, other in _scored(batches, *sent.value):
            above = other & (scores > threshold) & there
            r, q = np.nonzero(above)
            yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(own[r]), pa.array(scores[r, q])], ["query_id", "id", "score"])
            r, q = np.nonzero(other & (scores == threshold) & there)
            for one in np.unique(q):  # of equal scores, no more than k of the smallest ids can count
                ties[one] = np.sort(np.append(ties[one], own[r[q == one]]))[:k]
        q = np.repeat(np.arange(n), [len(t) for t in ties])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[q]), pa.array(np.concatenate(ties)), pa.array(threshold[q])], ["query_id", "id", "score"]
        )

    return rows.mapInArrow(keep, "query_id long, id long, score long")
