"""Send this package to the executors, once for each application."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Python workers import the package from an archive that Spark serves; no shared file system is needed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="siteweave-")) / "siteweave.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(here.rglob("*.py")):
            out.write(file, file.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
