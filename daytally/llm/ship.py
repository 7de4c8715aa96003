"""Give the Python workers this package, wherever they run."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import daytally

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the application's Python files (once); Spark's own file server hands it out."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(daytally.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="daytally-package-")) / "daytally.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
