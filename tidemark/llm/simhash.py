"""SimHash near-duplicates: whole-text fingerprints compared tile by tile.

Words are the runs between ASCII white space, A-Z lower-cased; a shingle is so many words joined by
single spaces (a shorter text is one shingle, a text without words has the fingerprint zero). Bit b
of a fingerprint is 1 if it is 1 in more than half of the shingles' hashes, repeats counted.

Texts with one fingerprint are one node from then on. Nodes are tiled by population counts: those
of parts of the fingerprint, whose differences sum to no more than the bits that differ. Tiles
whose counts are further apart than the radius never meet; the others are compared whole, by
exclusive or and bit counts. How many tiles there are follows from the rows of each count alone, not
from partitions. Of the links within a tile pair a spanning forest is kept, so no group of
near-copies is written out as pairs, and no link is lost to its component.

Null texts are read as empty, very long ones whole; null keys keep their row but name no component
(a group of null keys alone has the component null). Repeated rows keep their place and share a
component. An empty table gives an empty one. Other columns of the input are not read, so none
can clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.durable import free, settle
from tidemark.llm.common import offsets_of, only, slices, texts
from tidemark.llm.components import components
from tidemark.llm.shipping import ship

SEED = 42
#: Rows of a tile: two tiles and a block of their comparison stay within a few MB.
TILE = 8192
#: Rows of one population count above which fingerprints are cut into more parts.
PER_COUNT = 4096
#: Bytes of text whose words and hashes are held at once.
SLICE = 2 << 20
_LANES = np.uint64(0x0001000100010001)
_FULL = 65_535


def shingle_hashes(text: str, size: int) -> list[int]:
    """XXH64 of each shingle of a text."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(line, SEED)]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    begins = np.cumsum(lengths + 1) - lengths - 1
    ends = (begins + lengths)[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(begins.tolist(), ends, strict=False)]


def majority_bits(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each group of hashes, a word of the bits that are 1 in more than half of them."""
    counts = np.diff(offsets)
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    # Four 16-bit counters share a word, so groups are summed in runs that cannot overflow one.
    runs = -(-counts[some] // _FULL)
    first = np.repeat(offsets[:-1][some], runs)
    run = np.arange(len(first)) - np.repeat(np.cumsum(runs) - runs, runs)
    cuts = first + run * _FULL
    group = np.cumsum(runs) - runs
    for shift in range(16):
        lanes = (hashes >> np.uint64(shift)) & _LANES
        sums = np.add.reduceat(lanes, cuts)
        for lane in range(4):
            bit = shift + 16 * lane
            votes = np.add.reduceat((sums >> np.uint64(16 * lane)) & np.uint64(0xFFFF), group)
            out[some] |= (2 * votes > counts[some].astype(np.uint64)).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int = 3) -> DataFrame:
    """(key, print): the fingerprint of every whole text, as a signed long."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch, 1, SLICE):
                lists = [shingle_hashes(t, shingle) for t in texts(cut.column(1)).to_pylist()]
                offsets = offsets_of(np.array([len(x) for x in lists], np.int64))
                hashes = np.fromiter((h for x in lists for h in x), np.uint64, offsets[-1])
                bits = majority_bits(hashes, offsets)
                yield pa.RecordBatch.from_arrays([cut.column(0), pa.array(bits.view(np.int64))], [key, "print"])

    kind = docs.schema[key].dataType.simpleString()
    return only(docs, **{key: key, "text": text}).mapInArrow(run, f"`{key}` {kind}, print bigint")


# Tiles


def count_key(column: str, parts: int) -> Column:
    """Population counts of equal parts of a 64-bit word, as one number to the base 100."""
    size = 64 // parts
    mask = (1 << size) - 1 if size < 64 else -1
    total = F.lit(0).cast("long")
    for i in range(parts):
        count = F.bit_count(F.shiftrightunsigned(column, i * size).bitwiseAND(F.lit(mask))).cast("long")
        total = total * 100 + count
    return total


def _steps(parts: int, radius: int) -> list[int]:
    """Differences between keys of parts whose counts differ by ``radius`` or less in sum.

    One of each pair of opposite steps is enough, as links have no direction.
    """
    out = []
    for step in product(range(-radius, radius + 1), repeat=parts):
        if sum(map(abs, step)) <= radius:
            number = sum(d * 100 ** (parts - 1 - i) for i, d in enumerate(step))
            if number >= 0:
                out.append(number)
    return sorted(set(out))


def parts_for(rows: int) -> int:
    """Into how many parts fingerprints are cut for their counts: more of them part more rows.

    Counts of 64 / p random bits take about sqrt(2 pi e * 16 / p) values, p of them that to the p.
    """
    for parts in (1, 2, 4):
        if rows / (2 * np.pi * np.e * 16 / parts) ** (parts / 2) <= PER_COUNT:
            return parts
    return 8


def tiles(nodes: DataFrame) -> DataFrame:
    """Nodes (print, key) as tiles of one key: (key, part, prints).

    A key of n rows has n / TILE parts, rounded up, and a hash deals its rows to them.
    """
    counts = settle(nodes.groupBy("key").agg(F.ceil(F.count("*") / F.lit(TILE)).alias("parts")), "counts")
    dealt = nodes.join(counts, "key").select("key", F.pmod(F.xxhash64("print"), "parts").alias("part"), "print")
    # Dealt by tile: the join's own dealing, by key alone, would leave a common count to one task.
    return dealt.repartition("key", "part").groupBy("key", "part").agg(F.collect_list("print").alias("prints"))


def forest(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> np.ndarray:
    """Labels of the rows of a and then b: the smallest row each is linked to. ``same``: a is b."""
    na, nb = len(a), len(b)
    label = np.arange(na + (0 if same else nb))
    block = max(1, (1 << 18) // max(1, nb))
    for begin in range(0, na, block):
        r, c = np.nonzero(np.bitwise_count(a[begin : begin + block, None] ^ b[None, :]) <= radius)
        r += begin
        if same:
            later = c > r
            r, c = r[later], c[later]
        else:
            c = c + na
        if not len(r):
            continue
        cuts = np.flatnonzero(np.diff(r)) + 1
        for row, found in zip(r[np.r_[0, cuts]], np.split(c, cuts), strict=True):
            met = np.unique(np.append(label[found], label[row]))
            if len(met) > 1:
                label[np.isin(label, met[1:])] = met[0]
    return label


def links(nodes: DataFrame, radius: int, steps: list[int]) -> DataFrame:
    """A spanning forest (a, b) of the links of each tile pair whose keys differ by one of ``steps``."""
    held = settle(tiles(nodes), "tiles")
    names = held.select("key", "part")
    wanted = names.select(
        F.col("key").alias("a_key"), F.col("part").alias("a_part"), F.explode(F.array(*map(F.lit, steps))).alias("step")
    )
    pairs = wanted.join(names, F.col("key") == F.col("a_key") + F.col("step")).where("step > 0 OR a_part <= part")
    left = held.select(F.col("key").alias("a_key"), F.col("part").alias("a_part"), F.col("prints").alias("a"))
    right = held.withColumnRenamed("prints", "b")
    both = pairs.drop("step").join(left, ["a_key", "a_part"]).join(right, ["key", "part"])
    both = both.select("a_key", "a_part", "key", "part", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = list(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
            for row, (a_key, a_part, b_key, b_part) in enumerate(names):
                same = (a_key, a_part) == (b_key, b_part)
                a, b = (batch.column(i)[row].values.to_numpy() for i in (4, 5))
                label = forest(a, a if same else b, radius, same)
                prints = a if same else np.concatenate([a, b])
                child = np.flatnonzero(label != np.arange(len(label)))
                if len(child):
                    yield pa.RecordBatch.from_arrays([pa.array(prints[child]), pa.array(prints[label[child]])], ["a", "b"])

    # Tile pairs are few and long: dealt out evenly, so that no task has many of the large ones.
    dealt = both.repartition(spread_over(held.sparkSession), "a_key", "a_part", "key", "part")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def spread_over(spark: SparkSession) -> int:
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def near_groups(prints: DataFrame, key: str, radius: int) -> DataFrame:
    """(key, print) with ``component_id``: the smallest key reachable over links within the radius."""
    prints = settle(prints, "prints")
    distinct = settle(prints.groupBy("print").agg(F.min(key).alias("least")), "nodes")
    parts = parts_for(distinct.count())
    keyed = distinct.select("print", count_key("print", parts).alias("key"))
    member = settle(components(links(keyed, radius, _steps(parts, radius))), "members")
    named = distinct.join(member, F.col("print") == F.col("node"), "left")
    named = named.select("print", "least", F.coalesce("component", "print").alias("component"))
    # Settled, so that neither a large component nor a text that many documents have holds up its join.
    least = settle(named.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    of_print = settle(named.join(least, "component").select("print", "component_id"), "groups")
    free(distinct, member, least)
    return prints.join(of_print, "print").select(key, "print", "component_id")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """(key, fingerprint, component_id) of all documents."""
    found = near_groups(fingerprints(docs, key, text, shingle), key, radius)
    return found.select(key, F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """Whole rows of ``docs``, one of each group of ``near_duplicates``: that with the smallest key.

    Rows that repeat key and text are copies too; rows that share a key, but no near text, stay.
    """
    identity = F.struct(F.col(f"`{key}`").alias("key"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("hash"))
    marked = docs.select(identity.alias("id"), F.col(f"`{text}`").alias("text"))
    found = near_groups(fingerprints(marked, "id", "text", shingle), "id", radius)
    kept = settle(found.select(F.col("component_id").alias("id")).distinct(), "kept")
    kept = kept.select(F.col("id.key").alias("kept_key"), F.col("id.hash").alias("kept_hash"))
    renamed = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    k, t = (F.col(f"c{docs.columns.index(name)}") for name in (key, text))
    hashed = renamed.withColumns({"own_key": k, "own_hash": F.xxhash64(F.coalesce(t, F.lit("")))})
    same = F.col("own_key").eqNullSafe(F.col("kept_key")) & (F.col("own_hash") == F.col("kept_hash"))
    staying = hashed.join(kept, same, "left_semi").dropDuplicates(["own_key", "own_hash"])
    return staying.drop("own_key", "own_hash").toDF(*docs.columns)
