"""Intermediate results kept in the cluster's shared checkpoint folder.

A settled DataFrame is read back from files, so its lineage is cut, every later use reads it
instead of computing it again, the optimizer knows its true size, and losing an executor costs
nothing but a re-read.
"""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_LOCAL_FOLDERS: dict[str, str] = {}
_SETTLED: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_SCOPE: ContextVar[list[str] | None] = ContextVar("tidemark_scratch", default=None)


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder the session names; one of our own only on a local master without a setting."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    if context.applicationId not in _LOCAL_FOLDERS:
        warnings.warn(f"{SETTING} is not set: intermediate results go to a folder of this machine", stacklevel=2)
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_FOLDERS[context.applicationId]


def new_run_folder(spark: SparkSession, label: str) -> str:
    folder = f"{checkpoint_folder(spark)}/tidemark-{label}-{uuid.uuid4().hex}"
    made = _SCOPE.get()
    if made is not None:
        made.append(folder)
    return folder


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the folders made inside it. What is wanted has to be written before.

    A DataFrame that was settled inside cannot be read afterwards.
    """
    made: list[str] = []
    token = _SCOPE.set(made)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for folder in made:
            _remove(spark, folder)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once and return it read back."""
    spark = df.sparkSession
    folder = new_run_folder(spark, label)
    df.write.parquet(folder)
    settled = spark.read.schema(df.schema).parquet(folder)
    _SETTLED[settled] = folder
    return settled


def free(*settled: DataFrame) -> None:
    """Remove the files of DataFrames that ``settle`` returned, once nothing will read them again.

    For loops: what a round was made from goes when the next round is settled.
    """
    for df in settled:
        folder = _SETTLED.pop(df, None)
        if folder is not None:
            _remove(df.sparkSession, folder)
