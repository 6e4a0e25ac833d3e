"""A session with the settings that the toolkit's scans rely on."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "true",  # Parquet paths are
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.timeType.enabled": "true",
}


def session(app: str = "lamina", **more) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the session's ``spark.checkpoint.dir``.  Only in a single local
    process, as in tests, may that be unset; then a temporary folder takes its
    place.  On a cluster an unset folder is an error, as each executor would
    write to a disk of its own.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="lamina-"))
        at = context.getCheckpointDir()
    return at.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """This application's own part of the shared folder; no other application writes or deletes there."""
    return f"{shared_dir(spark)}/lamina/{spark.sparkContext.applicationId}"


def clear_shared(spark: SparkSession) -> None:
    """Removes what this application has staged; results that still read it must be written before."""
    at = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
