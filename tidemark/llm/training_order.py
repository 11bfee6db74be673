"""Training-order materialisation: a keyed permutation gives every sequence a global slot.

Sequences are tokenised documents. Their ranks, 0 to N - 1, are permuted by a Feistel network over
the next even number of bits; ranks whose image is N or more walk its cycle until it is not, which
makes it a permutation of exactly N slots that anyone with the key can compute either way. Slots
are cut into ranges of equal length, and each range is one shard: the ids of its sequences in slot
order, each with an end id behind it, in records of a fixed number of ids; only the last record of
a shard is padded. A reader that knows the shard and the record it was at goes on from there with one seek.

The tokens pass through one shuffle, by range; a task writes its shards as the sorted rows come by
and holds no shard in memory. A shard is written under the attempt's name and renamed when it is
whole, so a lost executor costs a rewrite of the same bytes. Ranks follow the input's partitions,
as those of ``zipWithIndex`` do; a table that changes between the two reads is refused.

Null and empty texts are sequences of the end id alone; very long ones are one sequence, whole. Repeated
rows and null keys are sequences of their own. An empty table gives no shard. Only the named columns
are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import new_run_folder, settle
from tidemark.llm.common import only, slices, texts
from tidemark.llm.shipping import ship
from tidemark.llm.tokens import DEFAULT_PATH, batch_tokenizer

ROUNDS = 6
#: Slots of a shard, and ids of a record.
SHARD_SLOTS = 4096
RECORD_IDS = 2048
ID_TYPE = "<u2"  # holds the vocabulary's 50,257 ids


class Permutation:
    """A keyed permutation of 0 .. size - 1."""

    def __init__(self, key: str, size: int):
        self.size = size
        self.half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = [
            np.uint64(int.from_bytes(hashlib.sha256(f"{key}/{size}/{i}".encode()).digest()[:8], "little"))
            for i in range(ROUNDS)
        ]

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x ^ key) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(32))) & self.mask

    def _forward(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for key in self.keys:
            left, right = right, left ^ self._round(right, key)
        return (left << np.uint64(self.half)) | right

    def _backward(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for key in reversed(self.keys):
            left, right = right ^ self._round(left, key), left
        return (left << np.uint64(self.half)) | right

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        x = step(np.asarray(x).astype(np.uint64))
        out = np.flatnonzero(x >= np.uint64(self.size))
        while len(out):
            x[out] = step(x[out])
            out = out[x[out] >= np.uint64(self.size)]
        return x.astype(np.int64)

    def slots(self, ranks: np.ndarray) -> np.ndarray:
        return self._walk(ranks, self._forward)

    def ranks(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, self._backward)


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:08d}.bin"


def read_records(folder: str, shard: int, first: int, count: int, record_ids: int = RECORD_IDS) -> np.ndarray:
    """Records of a shard from the ``first`` on, read with one seek: count x ids."""
    system, path = fs.FileSystem.from_uri(shard_path(folder, shard))
    stride = record_ids * np.dtype(ID_TYPE).itemsize
    with system.open_input_file(path) as file:
        data = file.read_at(count * stride, first * stride)
    return np.frombuffer(data, ID_TYPE).reshape(-1, record_ids)


class _ShardWriter:
    """Writes one shard after the other, each whole or not at all."""

    def __init__(self, folder: str, record_ids: int, pad_id: int):
        self.system, self.path = fs.FileSystem.from_uri(folder)
        self.folder, self.record_ids, self.pad_id = folder, record_ids, pad_id
        self.shard, self.written, self.file = -1, 0, None

    def add(self, shard: int, ids: np.ndarray) -> int:
        """Appends a sequence; gives the place of its first id in the shard."""
        if shard != self.shard:
            self.close()
            context = TaskContext.get()
            self.system.create_dir(self.path, recursive=True)
            self.shard, self.written = shard, 0
            self.attempt = f"{self.path}/_attempt-{shard}-{context.taskAttemptId()}"
            self.file = self.system.open_output_stream(self.attempt)
        at = self.written
        self.file.write(ids.tobytes())
        self.written += len(ids)
        return at

    def close(self) -> None:
        if self.file is not None:
            short = -self.written % self.record_ids
            self.file.write(np.full(short, self.pad_id, ID_TYPE).tobytes())
            self.file.close()
            whole = f"{self.path}/{shard_path('', self.shard)[1:]}"
            if self.system.get_file_info(whole).type == fs.FileType.NotFound:
                self.system.move(self.attempt, whole)
            else:  # an earlier attempt has written the same bytes
                self.system.delete_file(self.attempt)
            self.file = None


def materialise(
    docs: DataFrame,
    folder: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    secret: str = "epoch-0",
    end_id: int | None = None,
    shard_slots: int = SHARD_SLOTS,
    record_ids: int = RECORD_IDS,
    path: str = DEFAULT_PATH,
) -> DataFrame:
    """Writes the shards into ``folder``; gives where each sequence is.

    Columns: key, rank, slot, shard, start (ids before it in the shard), length (with the end id),
    ids_crc32 (of its ids as written).
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or new_run_folder(spark, "shards")
    rows = only(docs, key=key, text=text)
    parts = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")).collect()
    sizes = {r["part"]: r["n"] for r in parts}
    before, total = {}, 0
    for part in sorted(sizes):
        before[part], total = total, total + sizes[part]
    kind = docs.schema[key].dataType.simpleString()

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, order = batch_tokenizer(path), Permutation(secret, total)
        end = max(tokenizer.added.values()) if end_id is None else end_id
        part = TaskContext.get().partitionId()
        seen = 0
        for batch in batches:
            for cut in slices(batch, 1):
                n = len(cut)
                ids, offsets = tokenizer.encode(texts(cut.column(1)))
                whole = np.full(len(ids) + n, end, ID_TYPE)
                whole[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(offsets))] = ids
                begins = (offsets + np.arange(n + 1)) * whole.itemsize
                held = pa.Array.from_buffers(
                    pa.large_binary(), n, [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(whole)]
                )
                ranks = before.get(part, 0) + seen + np.arange(n)
                seen += n
                if seen > sizes.get(part, 0):
                    raise RuntimeError("the table has changed since its rows were counted")
                slots = order.slots(ranks)
                yield pa.RecordBatch.from_arrays(
                    [cut.column(0), pa.array(ranks), pa.array(slots), pa.array(slots // shard_slots), held.cast(pa.binary())],
                    ["key", "rank", "slot", "shard", "ids"],
                )
        if seen != sizes.get(part, 0):
            raise RuntimeError("the table has changed since its rows were counted")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            tokenizer = batch_tokenizer(path)
            end = max(tokenizer.added.values()) if end_id is None else end_id
            writer = writer or _ShardWriter(folder, record_ids, end)
            starts, lengths, sums = [], [], []
            for shard, ids in zip(batch.column(3).to_pylist(), batch.column(4), strict=True):
                data = np.frombuffer(ids.as_buffer(), ID_TYPE)
                starts.append(writer.add(shard, data))
                lengths.append(len(data))
                sums.append(zlib.crc32(data))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
                ["key", "rank", "slot", "shard", "start", "length", "ids_crc32"],
            )
        if writer:
            writer.close()

    shards = max(1, -(-total // shard_slots))
    placed = rows.mapInArrow(tokenise, f"key {kind}, rank bigint, slot bigint, shard bigint, ids binary")
    # A range of slots is a partition: the range's number is the partition's, no sampling needed.
    sorted_ = placed.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("slot")
    manifest = settle(
        sorted_.mapInArrow(
            write,
            f"key {kind}, rank bigint, slot bigint, shard bigint, start bigint, length bigint, ids_crc32 bigint",
        ),
        "manifest",
    )
    return manifest.select(F.col("key").alias(key), "rank", "slot", "shard", "start", "length", "ids_crc32")
