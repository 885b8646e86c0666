"""The Spark session the library is tuned for."""

from __future__ import annotations

import atexit
import os
import pathlib
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

#: Settings that hold at any size; adaptive execution picks partition counts and splits skewed joins.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def session(app: str = "placeforge", master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS whose executors have this package; keyword names use double underscores for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give executors this package, so that Python functions can be unpickled wherever the driver started.

    Once for each context; the archive is a few dozen source files.
    """
    context = spark.sparkContext
    if getattr(context, "_placeforge_shipped", False):
        return
    top = pathlib.Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="placeforge-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "placeforge-source.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(top.rglob("*.py")):
            z.write(path, str(path.relative_to(top.parent)))
    context.addPyFile(archive)
    context._placeforge_shipped = True
