"""Best-fit packing by exact-complement hashing.

Pieces are known by their lengths alone, and lengths lie between 1 and the capacity: a histogram
of at most ``capacity`` numbers, whatever the corpus, decides which lengths share a sequence. The
plan is made on that histogram: each length, from the longest, looks up single lengths, pairs and
triples that fill its gap exactly and takes as many as their counts allow; what is left is packed
best-fit, whole groups of equal sequences at a time. Spark then deals the pieces out: the n-th
piece of a length takes the n-th place that the plan has for that length.

Null and empty texts are one token (the end token); very long ones are cut into pieces of the whole
text. Repeated rows and null keys are packed as rows of their own, keys of any type. Pieces of one
length are alike: which goes where is told by their ranks. An empty table gives an empty result. Only
the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import settle
from tidemark.llm.common import offsets_of, only, ragged, slices, texts
from tidemark.llm.shipping import ship
from tidemark.llm.tokens import DEFAULT_PATH, batch_tokenizer

def cut_into_pieces(docs: DataFrame, capacity: int, end_id: int, path: str) -> DataFrame:
    """One row per piece. ``nth`` counts the earlier pieces of this length in the same ``part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = batch_tokenizer(path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for cut in slices(batch, 1):
                ids, offsets = tokenizer.encode(texts(cut.column(1)))
                n = len(cut)
                # The end token goes behind each document's ids.
                whole = np.full(len(ids) + n, end_id, "<u4")
                whole[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(offsets))] = ids
                begins = offsets + np.arange(n + 1)
                total = np.diff(begins)
                pieces = -(-total // capacity)
                first = total - (pieces - 1) * capacity
                doc = np.repeat(np.arange(n), pieces)
                number = ragged(np.zeros(n, np.int64), pieces)
                length = np.where(number == 0, first[doc], capacity)
                start = np.where(number == 0, 0, first[doc] + (number - 1) * capacity)
                at = begins[doc] + start
                data = whole.view(np.uint8).data
                crc = np.fromiter(
                    (zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)),
                    np.int64,
                    len(at),
                )
                # The how manieth of its length each piece is, within this task.
                by = np.argsort(length, kind="stable")
                ordered = length[by]
                run_begin = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
                run_size = np.diff(np.append(run_begin, len(ordered)))
                nth = np.empty(len(length), np.int64)
                nth[by] = seen[ordered] + np.arange(len(ordered)) - np.repeat(run_begin, run_size)
                seen[ordered[run_begin]] += run_size
                yield pa.RecordBatch.from_arrays(
                    [
                        cut.column(0).take(pa.array(doc)),
                        pa.array(number, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.array(np.full(len(doc), part), pa.int32()),
                        pa.array(nth, pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
    )


@dataclass
class Plan:
    """``groups``: lengths in a sequence, and how many such sequences there are."""

    capacity: int
    groups: list[tuple[tuple[int, ...], int]] = field(default_factory=list)

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.groups)

    def places(self) -> dict[int, np.ndarray]:
        """By length: rows of (first rank, first sequence, offset), ascending ranks."""
        rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        given: Counter[int] = Counter()
        sequence = 0
        for lengths, n in self.groups:
            offset = 0
            for length in lengths:
                rows[length].append((given[length], sequence, offset))
                given[length] += n
                offset += length
            sequence += n
        return {length: np.array(r, np.int64) for length, r in rows.items()}


class _Available:
    """Counts of lengths, with indices of the sums of one, two and three of them."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.copy()

    def fits(self, lengths: tuple[int, ...]) -> int:
        need = Counter(lengths)
        return min(int(self.counts[x]) // n for x, n in need.items())

    def take(self, lengths: tuple[int, ...], n: int) -> None:
        for x in lengths:
            self.counts[x] -= n

    def single(self, total: int) -> tuple[int, ...] | None:
        return (total,) if 0 < total < len(self.counts) and self.counts[total] else None

    def pair(self, total: int, most: int) -> tuple[int, ...] | None:
        """The pair with the longest first member not over ``most`` that sums to ``total``."""
        high = min(total - 1, most, len(self.counts) - 1)
        low = -(-total // 2)
        if high < low:
            return None
        firsts = np.arange(high, low - 1, -1)
        there = (self.counts[firsts] > 0) & (self.counts[total - firsts] > 0)
        there &= (firsts * 2 != total) | (self.counts[firsts] > 1)
        at = np.flatnonzero(there)
        return (int(firsts[at[0]]), total - int(firsts[at[0]])) if len(at) else None

    def triple(self, total: int, most: int) -> tuple[int, ...] | None:
        present = np.flatnonzero(self.counts[: min(total - 1, most + 1)])
        for first in present[::-1]:
            if 3 * first < total:
                return None
            self.counts[first] -= 1
            rest = self.pair(total - int(first), int(first))
            self.counts[first] += 1
            if rest:
                return (int(first), *rest)
        return None


def make_plan(counts: np.ndarray, capacity: int) -> Plan:
    """Pack a histogram: counts[x] pieces have length x, 1 to ``capacity``.

    Exact fills first and best fit for what they leave, or each sequence in turn with the longest
    that fits until the gap can be filled exactly: whichever needs fewer sequences.
    """
    plan = _exact_then_best_fit(counts, capacity)
    if plan.sequences > -(-int((counts * np.arange(capacity + 1)).sum()) // capacity):
        plan = min(plan, _fit_until_exact(counts, capacity), key=lambda p: p.sequences)
    return plan


def _fit_until_exact(counts: np.ndarray, capacity: int) -> Plan:
    plan = Plan(capacity)
    left = _Available(counts)
    for length in range(capacity, 0, -1):
        while left.counts[length]:
            lengths, gap = [length], capacity - length
            left.counts[length] -= 1
            while gap:
                found = left.single(gap) or left.pair(gap, length) or left.triple(gap, length)
                if not found:
                    smaller = np.flatnonzero(left.counts[: gap + 1])
                    if not len(smaller):
                        break
                    found = (int(smaller[-1]),)
                left.take(found, 1)
                lengths.extend(found)
                gap -= sum(found)
            more = left.fits(tuple(lengths))
            left.take(tuple(lengths), more)
            plan.groups.append((tuple(lengths), 1 + more))
    return plan


def _exact_then_best_fit(counts: np.ndarray, capacity: int) -> Plan:
    plan = Plan(capacity)
    left = _Available(counts)
    for length in range(capacity, 0, -1):
        gap = capacity - length
        while left.counts[length]:
            if not gap:
                found: tuple[int, ...] | None = ()
            else:
                left.counts[length] -= 1
                found = left.single(gap) or left.pair(gap, length) or left.triple(gap, length)
                left.counts[length] += 1
            if found is None:
                break
            lengths = (length, *found)
            n = left.fits(lengths)
            if not n:  # the pair needs more of one length than there are
                break
            left.take(lengths, n)
            plan.groups.append((lengths, n))

    # Best fit: groups of equal unfinished sequences by gap, filled in bulk.
    gaps: list[int] = []
    open_groups: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)

    def put(lengths: tuple[int, ...], n: int) -> None:
        gap = capacity - sum(lengths)
        if not gap:
            plan.groups.append((lengths, n))
            return
        if not open_groups[gap]:
            insort(gaps, gap)
        open_groups[gap].append((lengths, n))

    for length in range(capacity, 0, -1):
        n = int(left.counts[length])
        while n:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                fill = capacity // length
                if n >= fill:
                    put((length,) * fill, n // fill)
                if n % fill:
                    put((length,) * (n % fill), 1)
                break
            gap = gaps[at]
            lengths, there = open_groups[gap].pop()
            if not open_groups[gap]:
                gaps.pop(at)
            used = min(n, there)
            put((*lengths, length), used)
            if there > used:
                put(lengths, there - used)
            n -= used
    for groups in open_groups.values():
        plan.groups.extend(groups)
    return plan


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    end_id: int = 0,
    path: str = DEFAULT_PATH,
) -> DataFrame:
    """Pieces of documents with the sequence and the place that each has been given.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    ship(docs.sparkSession)
    pieces = settle(cut_into_pieces(only(docs, doc_id=key, text=text), capacity, end_id, path), "pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["n"]
    plan = make_plan(counts, capacity)
    if sum(n * len(lengths) for lengths, n in plan.groups) != counts.sum():
        raise AssertionError("the plan has lost pieces")

    # Ranks of a length run on over the parts: a running sum over one row per part.
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select(
        F.col("length").alias("of_length"),
        F.col("part").alias("of_part"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
    )
    ranked = pieces.join(before, (F.col("length") == F.col("of_length")) & (F.col("part") == F.col("of_part"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")
    )
    places = plan.places()
    lengths = np.array(sorted(places), np.int64)
    table = np.concatenate([places[x] for x in lengths]) if len(lengths) else np.zeros((0, 3), np.int64)
    begins = offsets_of(np.array([len(places[x]) for x in lengths], np.int64))
    # Ranks made unique over all lengths, so that one search finds any of them.
    shift = offsets_of(counts)
    keys = table[:, 0] + np.repeat(shift[lengths], np.diff(begins)) if len(lengths) else np.zeros(0, np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((keys, table, shift))  # bounded by the plan

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, table, shift = shared.value
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, rank + shift[length], side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:5],
                    pa.array(table[at, 1] + rank - table[at, 0], pa.int64()),
                    pa.array(table[at, 2], pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return ranked.mapInArrow(
        deal,
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )
