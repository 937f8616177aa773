"""Makes the package importable in Python workers of sessions that were started elsewhere."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_grainfield_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="grainfield-"), "grainfield.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(here)))
    context.addPyFile(path)
    context._grainfield_shipped = True
