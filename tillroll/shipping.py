"""The package for the Python workers of a session, for clusters where it is not installed."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tillroll

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package's own files to all executors, once per application; Spark distributes them."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    home = os.path.dirname(os.path.abspath(tillroll.__file__))
    with tempfile.NamedTemporaryFile(prefix="tillroll-", suffix=".zip", delete=False) as file:
        with zipfile.ZipFile(file, "w") as archive:
            for folder, _, names in sorted(os.walk(home)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        archive.write(path, os.path.relpath(path, os.path.dirname(home)))
    atexit.register(lambda: os.path.exists(file.name) and os.remove(file.name))
    spark.sparkContext.addPyFile(file.name)
    _shipped.add(application)
