"""Merged tables in folders: a load rewrites only the partitions it touches, and history only grows.

Below ``root``, ``current`` holds the current rows in the partitions of ``TableSpec.partition_by``, written
with Spark's dynamic partition overwrite; ``history`` holds each load's replaced rows, partitioned by load
and by the day their period ended, so time travel reads only days that can matter; ``incoming`` holds what
a load is about to make current.

A load has a number. Its rows are complete in ``incoming`` and ``history`` before anything current is
overwritten, so a load that died goes on from there when it is run again, and one that is done does
nothing. One writer per table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.moments import Moment
from tidemark.operators.merge import merge_load
from tidemark.operators.temporal import TemporalTable
from tidemark.spec import TableSpec

#: More touched partitions than this are not named one by one: all are read and written.
MAX_NAMED = 10_000
LOAD, ENDED = "load", "ended"


@dataclass(frozen=True)
class StoredTable:
    spark: SparkSession
    root: str
    spec: TableSpec
    schema: T.StructType

    @classmethod
    def create(cls, df: DataFrame, root: str, spec: TableSpec) -> StoredTable:
        """Store current rows, with their period columns, as a new table without history."""
        missing = {*spec.partition_by, spec.start, spec.end} - set(df.columns)
        if missing:
            raise ValueError(f"the rows have no {sorted(missing)}")
        table = cls(df.sparkSession, root, spec, df.schema)
        table._folder("history").mkdirs(table._path("history"))
        df.write.partitionBy(*spec.partition_by).parquet(f"{root}/current")
        return table

    def current(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/current").select(*self.schema.names)

    def history(self) -> DataFrame:
        """Replaced rows, with their load and the day they ended."""
        schema = T.StructType([*self.schema.fields, T.StructField(LOAD, T.LongType()), T.StructField(ENDED, T.DateType())])
        return self.spark.read.schema(schema).parquet(f"{self.root}/history")

    def versions(self) -> TemporalTable:
        """The table for time travel: reads of an instant or a range leave out days that cannot matter."""
        spec = self.spec
        return TemporalTable(self.current(), self.history().drop(LOAD), spec.keys, spec.start, spec.end, ended=ENDED)

    def touched(self, stage: DataFrame) -> Column | None:
        """Which partitions a stage can change, as a condition on partition columns alone; None: all.

        They are those of its rows, and those where its keys are now: unless the keys tell the
        partition, a row may move.
        """
        by = list(self.spec.partition_by)
        if not by:
            return None
        types = {f.name: f.dataType for f in self.schema.fields}
        parts = stage.select(*(F.col(c).cast(types[c]).alias(c) for c in by))
        if not set(by) <= set(self.spec.keys):
            keys = stage.select(*(F.col(k).cast(types[k]).alias(k) for k in self.spec.keys))
            parts = parts.unionByName(self.current().select(*dict.fromkeys((*self.spec.keys, *by))).join(keys, list(self.spec.keys), "left_semi").select(*by))
        values = parts.distinct().limit(MAX_NAMED + 1).collect()
        if len(values) > MAX_NAMED:
            return None
        if len(by) == 1:
            known = [v[0] for v in values if v[0] is not None]
            named = F.col(by[0]).isin(known) if known else F.lit(False)
            return named | F.col(by[0]).isNull() if len(known) < len(values) else named
        each = (reduce(Column.__and__, (F.col(c).eqNullSafe(F.lit(v[c]).cast(types[c])) for c in by)) for v in values)
        return reduce(Column.__or__, each, F.lit(False))

    def merge(self, stage: DataFrame, now: Moment, load: int) -> None:
        """Merge a stage: only partitions that it touches are read whole and written."""
        if self._resume(load):
            return
        touched = self.touched(stage)
        current = self.current() if touched is None else self.current().where(touched)
        self.publish(merge_load(current, stage, self.spec, now).images, load, touched)

    def publish(self, images: DataFrame, load: int, touched: Column | None = None) -> None:
        """Make a load's ``images`` the current rows of the touched partitions, and add to history.

        ``images`` holds all rows that these partitions have from now on, and the replaced ones.
        """
        if self._resume(load):
            return
        rows = images.select(*self.schema.names, "kind")
        if touched is not None:
            rows = rows.unionByName(self._vacated(touched))
        rows.write.mode("overwrite").partitionBy("kind").parquet(f"{self.root}/incoming/{LOAD}={load}")
        ended = self._incoming(load, "history").withColumn(ENDED, F.to_date(self.spec.end))
        ended.write.mode("overwrite").partitionBy(ENDED).parquet(f"{self.root}/history/{LOAD}={load}")
        self._resume(load)

    def _vacated(self, touched: Column) -> DataFrame:
        """The partitions there are now among those touched, as rows of kind ``old``."""
        by = self.spec.partition_by
        parts = self.current().where(touched).select(*by).distinct().withColumn("kind", F.lit("old"))
        return parts.select(
            *(F.col(f.name) if f.name in by else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields), "kind"
        )

    def _incoming(self, load: int, kind: str) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("kind", T.StringType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/incoming/{LOAD}={load}")
        return rows.where(F.col("kind") == kind).drop("kind")

    def _resume(self, load: int) -> bool:
        """Finish a load whose rows are complete; whether there was such a load."""
        if not self._exists(f"history/{LOAD}={load}/_SUCCESS"):
            return False
        if not self._exists(f"incoming/{LOAD}={load}"):
            return True
        by = list(self.spec.partition_by)
        rows = self._incoming(load, "current")
        writer = rows.write.mode("overwrite")
        if by:
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by)
        writer.parquet(f"{self.root}/current")
        if by:
            self._drop_empty(load, rows.select(*by).distinct())
        self._folder("incoming").delete(self._path(f"incoming/{LOAD}={load}"), True)
        return True

    def _drop_empty(self, load: int, filled: DataFrame) -> None:
        """Partitions that all rows have left are not overwritten by any row: their folders go."""
        by = list(self.spec.partition_by)
        same = [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in by]
        empty = self._incoming(load, "old").select(*by).alias("old").join(filled.alias("new"), same, "left_anti")
        files = self.spark.read.schema(self.schema).parquet(f"{self.root}/current").select(*by, F.col("_metadata.file_path").alias("path")).alias("new")
        left = files.join(empty, same, "left_semi").select(F.regexp_extract("path", "^(.*)/[^/]*$", 1)).distinct()
        for (folder,) in left.collect():
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.spark._jvm.java.net.URI(folder))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _folder(self, name: str):
        return self._path(name).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, name: str) -> bool:
        return self._folder(name).exists(self._path(name))
