"""Session settings the operators rely on."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else started."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("perptide")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only where none is set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="perptide-checkpoint-")


@functools.cache
def _shipped(application: str, context) -> None:
    package = os.path.dirname(os.path.abspath(__file__))
    with tempfile.TemporaryDirectory() as folder:
        kept = os.path.join(folder, "source")
        shutil.copytree(package, f"{kept}/perptide", ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='perptide-')}/perptide", "zip", kept))


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per application, as ``--py-files`` would."""
    _shipped(spark.sparkContext.applicationId, spark.sparkContext)
    return spark
