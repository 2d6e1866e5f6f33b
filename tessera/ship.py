"""Sends the package to the executors, for sessions whose workers don't have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package's source to the session's Python files, once a session."""
    sc = spark.sparkContext
    if sc.applicationId in _SENT:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="tessera-")) / "tessera.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(Path("tessera") / f.relative_to(root)))
    sc.addPyFile(str(path))
    _SENT.add(sc.applicationId)
