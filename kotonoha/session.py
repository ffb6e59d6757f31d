"""Session settings that the operators are written for."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings worth having on any cluster. Sizes that depend on the cluster
# (executors, memory, shuffle partitions) are left to spark-submit.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app_name: str = "kotonoha",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the recommended settings; ``master`` only for local use."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in the Python workers, once per context."""
    context = spark.sparkContext
    if any(f.endswith("kotonoha.zip") for f in context.listFiles):
        return
    above = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="kotonoha-package-")
    context.addPyFile(shutil.make_archive(f"{folder}/kotonoha", "zip", above, "kotonoha"))
