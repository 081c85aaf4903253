"""The package on the executors' Python path, where the launch did not put it there."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]
_done: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's sources to the session's Python workers, once per application.

    Not needed with ``--py-files`` or a PYTHONPATH that holds the package: then nothing is sent.
    """
    root = str(_PACKAGE.parent)
    application = spark.sparkContext.applicationId
    if application in _done or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    # The driver serves the archive for as long as it lives.
    folder = tempfile.mkdtemp(prefix="package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, f"{_PACKAGE.name}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(_PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(_PACKAGE.parent))
    spark.sparkContext.addPyFile(archive)
    _done.add(application)
