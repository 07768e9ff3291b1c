"""The package on the executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Once for each application: sends this package to the Python workers of all executors."""
    context = spark.sparkContext
    if getattr(ship, "to", None) != context.applicationId:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        place = tempfile.mkdtemp(prefix="foliant-code-")  # the driver serves it from here to the executors
        atexit.register(shutil.rmtree, place, ignore_errors=True)
        context.addPyFile(shutil.make_archive(os.path.join(place, "foliant_code"), "zip", top, "foliant"))
        ship.to = context.applicationId
