"""Sends a package's modules to the Python workers of all executors, wherever they run."""

from __future__ import annotations

import importlib.util
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[tuple[str, str]] = set()


def ship(spark: SparkSession, package: str) -> None:
    """Once a session and package: workers then import it, though it isn't installed and lies in no folder of theirs."""
    context = spark.sparkContext
    key = (context.applicationId, package)
    if key in _sent:
        return
    root = os.path.dirname(importlib.util.find_spec(package).origin)
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{package}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _sent.add(key)


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Sessions that allow Arrow batches of more bytes are held to so many where texts go to Python; lower settings stay.
MOST_BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches by bytes: a batch of the default 10,000 rows takes a worker hundreds of MB if texts are long."""
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_BYTES)) > MOST_BATCH_BYTES:
        spark.conf.set(_BATCH_BYTES, str(MOST_BATCH_BYTES))
