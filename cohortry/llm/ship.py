"""Sending this package to the Python workers of a cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once per application.

    Workers import the operators' functions by name, and need not have the folder
    that the driver was started from.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    path = os.path.join(tempfile.mkdtemp(prefix="cohortry-"), "cohortry_package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
