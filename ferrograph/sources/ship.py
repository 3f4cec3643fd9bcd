"""The package on the executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent


def driver_folder(spark: SparkSession) -> Path:
    """A folder for files that the driver serves to the executors, one a session, removed when the program ends.

    It lies in the shared folder that ``spark.checkpoint.dir`` names, if that is a plain path; only without one, as in tests, among the machine's temporary files.
    """
    context = spark.sparkContext
    if (made := getattr(context, "_ferrograph_folder", None)) is None:
        shared = (spark.conf.get("spark.checkpoint.dir", None) or "").removeprefix("file:")
        within = shared if shared.startswith("/") and Path(shared).is_dir() else None
        made = context._ferrograph_folder = Path(tempfile.mkdtemp(prefix="ferrograph-", dir=within))
        atexit.register(shutil.rmtree, made, ignore_errors=True)
    return made


def ship(spark: SparkSession) -> None:
    """Sends the package to the workers once a session; Spark keeps the file on the driver and serves it to all executors."""
    context = spark.sparkContext
    if getattr(context, "_ferrograph_shipped", False):
        return
    to = driver_folder(spark) / "ferrograph.zip"
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(ROOT.rglob("*.py")):
            z.write(p, p.relative_to(ROOT.parent))
    context.addPyFile(str(to))
    context._ferrograph_shipped = True
