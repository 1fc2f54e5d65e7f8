"""Give the executors' Python workers this package."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession | None = None) -> None:
    """Once for each application; Spark's file server sends the archive to the executors."""
    spark = spark or SparkSession.active()
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="quillstone-")) / "quillstone.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)
