"""The package's code on the Python workers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, wherever the driver was started; once per application."""
    if spark.sparkContext.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        folder = tempfile.mkdtemp(prefix="tidemark-code-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = Path(folder, "tidemark.zip")
        with zipfile.ZipFile(path, "w") as out:
            for file in sorted((root / "tidemark").rglob("*.py")):
                out.write(file, file.relative_to(root))
        spark.sparkContext.addPyFile(str(path))
        _shipped.add(spark.sparkContext.applicationId)
