"""Make this package importable in Spark's Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import strata


def ship_package(spark: SparkSession) -> None:
    """Hand the package's sources to the session's Python workers, once (as
    ``--py-files`` does), so that a job doesn't depend on the workers' path."""
    context = spark.sparkContext
    if getattr(context, "strata_shipped", False):
        return
    root = Path(strata.__file__).parent
    if root.is_dir():
        archive = Path(tempfile.mkdtemp(prefix="strata-src-")) / "strata-src.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for source in sorted(root.rglob("*.py")):
                z.write(source, f"strata/{source.relative_to(root)}")
        context.addPyFile(str(archive))
    context.strata_shipped = True
