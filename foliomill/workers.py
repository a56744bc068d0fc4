"""Make the package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application, unless PYTHONPATH already has it there."""
    sc, root = spark.sparkContext, Path(__file__).resolve().parent.parent
    if getattr(sc, "_foliomill_sent", False) or str(root) in os.environ.get("PYTHONPATH", "").split(":"):
        return
    archive = Path(tempfile.mkdtemp()) / "foliomill.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted((root / "foliomill").rglob("*.py")):
            z.write(path, path.relative_to(root))
    sc.addPyFile(str(archive))
    sc._foliomill_sent = True
