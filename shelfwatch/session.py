"""Session defaults and the shared work folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on. Shuffle partitions and memory are left to the cluster:
# AQE coalesces small partitions and splits skewed ones from the sizes it measures.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Files of a batch are listed by this many tasks; Spark's own bound is a task per file.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "100",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the local benchmark."""
    return tune(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfwatch")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="shelfwatch-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    A machine-local folder is only ever used when the session itself runs on one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_dir()


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nobody has used before."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
