"""Making the package importable in the Python workers of every executor."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package, once a Spark application, as a zip that the workers put on their path."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    to = Path(tempfile.mkdtemp(prefix="curul-ship-")) / f"{root.name}.zip"
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(to))
    _SHIPPED.add(app)
