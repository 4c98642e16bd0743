"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call-site capture doubles the time it takes to build wide transforms.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "sanitaria", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings this package expects; ``extra`` keys use ``__`` for dots.

    Shuffle partitions are left to the cluster's own default: AQE coalesces
    them downwards, so a large value is safe and a small one is not.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str, below: str | None = None) -> str:
    """A fresh folder for data between two jobs: below ``below`` if given, else the shared checkpoint folder.

    Executors may be lost at any time, so everything written between two jobs
    has to sit on storage that all of them can see.  Only a local master, where
    there is one machine, may fall back to a temporary folder.
    """
    unique = f"{purpose}-{uuid.uuid4().hex[:12]}"
    if below:
        return f"{below.rstrip('/')}/_scratch/{unique}"
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="sanitaria-")
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}/{unique}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that is no longer read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
