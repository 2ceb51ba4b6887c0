"""Sending this package to the executors, for the few steps that run in their Python."""

import atexit
import io
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED = "feira.shipped"


def ship(spark: SparkSession) -> None:
    """Once per application. The driver serves the packed copy, so it stays until Python ends."""
    context = spark.sparkContext
    if context.getLocalProperty(_SHIPPED) == context.applicationId:
        return
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, str(file.relative_to(root.parent)))
    folder = tempfile.mkdtemp(prefix="feira-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, f"{root.name}.zip")
    Path(path).write_bytes(packed.getvalue())
    context.addPyFile(path)
    context.setLocalProperty(_SHIPPED, context.applicationId)
