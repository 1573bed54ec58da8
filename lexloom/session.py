"""Session helpers: shipping this package to Python workers that cannot import it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Adds the package as a zip to the session's Python path on executors, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        path = os.path.join(tempfile.mkdtemp(prefix="lexloom-"), "lexloom.zip")
        with zipfile.ZipFile(path, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent).as_posix())
        context.addPyFile(path)
        _shipped.add(context.applicationId)
    return spark
