"""The package's own code on every executor, however the session was started."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

import riverdeck

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to Spark as a Python file, once per application; Spark serves it to executors."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(riverdeck.__file__))
    folder = tempfile.mkdtemp(prefix="riverdeck-code-")  # the driver's copy, from which Spark serves it
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.addPyFile(shutil.make_archive(
        os.path.join(folder, "riverdeck_code"), "zip", os.path.dirname(package), os.path.basename(package)))
    _shipped.add(app)
