"""Readies a session: workers can import this package, and get texts in batches of bounded size."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()

# Bytes of rows that a worker gets at once, unless the session says otherwise. What a task holds beside
# Spark's own memory is a small multiple of it.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Hands the package's modules to the session's workers, once; a package that came as a zip is there already.

    Where the session leaves the size of batches at Spark's default, it is set to BATCH_BYTES.
    """
    if spark.conf.get(BATCH_SETTING).rstrip("b") == str(64 << 20):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    package = Path(__file__).resolve().parent.parent
    context = spark.sparkContext
    if context.applicationId in _SHIPPED or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="run-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
