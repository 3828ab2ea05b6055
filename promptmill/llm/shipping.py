"""Give this package to the Python workers of a session."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import SparkSession

_done: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the session once, as ``--py-files`` would; Spark sends it to every executor."""
    context = spark.sparkContext
    if context.applicationId in _done:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="promptmill-code-")) / "promptmill.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _done.add(context.applicationId)


def shipped(query: Callable) -> Callable:
    @wraps(query)
    def run(spark: SparkSession, *args):
        ship(spark)
        return query(spark, *args)

    return run
