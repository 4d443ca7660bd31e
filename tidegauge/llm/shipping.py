"""The package on the executors' Python path."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()
#: Most bytes of rows handed to a Python worker at once, so that long texts don't fill its memory.
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's source to the executors, once per application, as any job sends its Python files."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    application = spark.sparkContext.applicationId
    if application not in _sent:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _sent.add(application)
    return spark
