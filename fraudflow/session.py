"""Session settings and shipping of this package to executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Bytes of an Arrow batch that goes to a Python worker: rows alone bound nothing where texts are long.
BATCH_BYTES = 4 << 20


def ship_package(spark: SparkSession) -> None:
    """Makes the package importable in Python workers (once per application), and bounds their batches.

    Python functions travel by reference, so executors need the modules; on a
    cluster this does what ``--py-files`` would. A session's own bound of Arrow
    batches in bytes stays.
    """
    context = spark.sparkContext
    if not spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if getattr(context, "_fraudflow_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="fraudflow-")) / "fraudflow_package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._fraudflow_shipped = True
