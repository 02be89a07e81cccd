"""Makes the package importable on executors that do not share the driver's disk."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors once per application.

    Operators that run Python on executors call this first, so a cluster job needs no --py-files.
    The archive is served by Spark's own file server; nothing is assumed about shared folders.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(), f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for p in sorted(root.rglob("*.py")):
            out.write(p, f"{root.name}/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
