"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from dualscript.sources.storage import fresh_name, shared_dir

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use '__' for '.'."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()  # applications whose workers have the package


def ship_package(spark: SparkSession) -> None:
    """Let workers import this package, whatever folder they run in; once per application.

    A zip of the sources is written to the shared folder and handed to Spark.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root, raw = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/package-{fresh_name()}/dualscript.zip")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    target = files.create(path, True)
    try:
        target.write(raw.getvalue())
    finally:
        target.close()
    context.addPyFile(files.makeQualified(path).toString())
    _SHIPPED.add(context.applicationId)
