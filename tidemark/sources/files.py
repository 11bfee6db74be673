"""Whole files as rows."""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a file that a task may hold as one value, and of each part of a longer one.
PIECE = 64 * 2**20
RECORD = 8 * 2**20


def load_files(
    spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False, piece: int | None = None
) -> DataFrame:
    """One row per file: ``name``, ``path``, ``length``, ``modified`` and the ``content`` blob.

    Column pruning reaches the source: a plan that leaves ``content`` out does not open the files.
    Spark's source passes over files of length zero.

    A blob has less than 2 GB and lies whole in a task's memory. With ``piece``, a file of more bytes comes in
    several rows of equal size, and all rows have the ``position`` at which their ``content`` begins. The files
    that are longer are listed at the call. One that is named like a compressed file stays whole.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    columns = [
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "path",
        "length",
        F.col("modificationTime").alias("modified"),
        "content",
    ]
    files = reader.load(path)
    if piece is None:
        return files.select(*columns)
    whole = files.where(F.col("length") <= piece).select(*columns, F.lit(0).cast("bigint").alias("position"))
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    longer = files.where(F.col("length") > piece).select("path", "length", F.unix_micros("modificationTime"))
    for at, length, modified in longer.collect():
        if codecs.getCodec(spark._jvm.org.apache.hadoop.fs.Path(at)) is not None:
            part = spark.read.format("binaryFile").load(_literal(at)).withColumn("position", F.lit(0).cast("bigint"))
        else:
            parts = _parts(spark, at, _part_length(length, min(piece, RECORD)))
            part = parts.withColumns({"path": F.lit(at), "length": F.lit(length), "modificationTime": F.timestamp_micros(F.lit(modified))})
        whole = whole.unionByName(part.select(*columns, "position"))
    return whole


def _part_length(length: int, most: int) -> int:
    """The largest number up to ``most`` that parts of a file of ``length`` bytes can all have; 1 where it is prime."""
    pairs = ((d, length // d) for d in range(1, min(math.isqrt(length), most) + 1) if length % d == 0)
    return max(n for pair in pairs for n in pair if n <= most)


def _literal(path: str) -> str:
    """``path`` where patterns, and several paths between commas, are read."""
    return re.sub(r"([\\*?\[\]{}^])", r"\\\1", path).replace(",", r"{\,}")


def _parts(spark: SparkSession, path: str, size: int) -> DataFrame:
    """A file's bytes as (position, content), ``size`` bytes in each row. Tasks begin at a multiple of it."""
    records = spark.sparkContext.binaryRecords(_literal(path), size)._jrdd.rdd()
    rows = spark._jsparkSession.createDataset(records, spark._jvm.org.apache.spark.sql.Encoders.BINARY())
    # The lower 33 bits number the rows of a task, and a task reads one block.
    number = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    return DataFrame(rows.toDF(), spark).select(
        (F.input_file_block_start() + number * size).alias("position"), F.col("value").alias("content")
    )
