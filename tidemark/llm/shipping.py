"""Makes this package importable in the cluster's Python workers."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import tidemark
from tidemark.durable import checkpoint_folder

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application: put the package's source into the shared folder and name it to Spark."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(tidemark.__file__).parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, f"{root.name}/{file.relative_to(root)}")
    # For the whole application: executors that come later fetch it too, so no scope may remove it.
    path = f"{checkpoint_folder(spark)}/tidemark-code-{uuid.uuid4().hex}/tidemark-code.zip"
    jvm = context._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(held.getvalue()))
    out.close()
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
