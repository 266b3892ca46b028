"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# Runtime settings that the operators rely on. All are per-session SQL settings, so a
# cluster's own executor and memory configuration stays as it is.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Narrow source columns take 20 times their shuffled bytes and more once they are sorted, joined and combined
    # by policy, so a task gets a quarter of Spark's default. Stored files stay larger (``tables.FILE_BYTES``).
    ADVISORY: "16m",
    # Lets ``tables.read_footers`` answer counts, minima and maxima without reading rows.
    "spark.sql.parquet.aggregatePushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shuffle_into(spark: SparkSession, partitions: int) -> None:
    """Have shuffles begin with so many partitions at least. The adaptive planner merges small ones up to the advisory
    size, but splits none below an aggregation: with a fixed number a task's share would grow with the input."""
    begun = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(INITIAL, None) or 0))
    if partitions > begun:
        spark.conf.set(INITIAL, partitions)


def shared_dir(spark: SparkSession) -> str:
    """The application's own folder below the one that ``spark.checkpoint.dir`` names, which every
    executor must reach. Hadoop's file system removes it when the application ends.

    Only a local-mode session may go without the setting, in a temporary folder: there, driver
    and executors are the same machine. Elsewhere a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tontine-")
        spark.conf.set("spark.checkpoint.dir", base)
    own = f"{base.rstrip('/')}/tontine-{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(own)
    fs = path.getFileSystem(context._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
