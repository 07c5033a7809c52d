"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# Settings the operators are written for.  The broadcast limits stay at Spark's
# own size checks: no operator forces a broadcast, so a lookup that outgrows the
# limit falls back to a shuffled join, where AQE splits hot keys.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g", folder: str | None = None) -> SparkSession:
    """A session for tests and the local bench, with a folder of its own; on a cluster use the one it gives."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("hourgrid")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # small tables on few cores: keep the partitions that a cluster would merge
    builder = builder.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    builder = builder.config("spark.driver.memory", memory)
    builder = builder.config("spark.checkpoint.dir", folder or tempfile.mkdtemp(prefix="hourgrid-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


class UnnamedFileSystem(ValueError):
    """The settings do not tell whether executors reach the folder."""


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``; judged by the settings alone.

    A path without a scheme means the driver's own disk unless a default file system is set, so on a cluster a scheme is
    asked for, or a default file system that is not local.  ``file:`` is taken at its word: it may be a shared mount.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if not urlparse(folder).scheme and not _one_machine(spark.sparkContext.master):
        default = spark.conf.get("spark.hadoop.fs.defaultFS", "file:///")
        if urlparse(default).scheme in ("", "file"):
            raise UnnamedFileSystem(f"spark.checkpoint.dir is {folder}: on a cluster name its file system as well")
    return folder.rstrip("/")


def _one_machine(master: str) -> bool:
    """``local`` and ``local[n]`` run in one process; ``local-cluster`` does not."""
    return master == "local" or master.startswith("local[")


# applications and folders that executors and driver were seen to share
_SHARED: set[tuple[str, str]] = set()


def _is_shared(spark: SparkSession, folder: str) -> bool:
    """Does the driver find in the folder what tasks on all cores write there, and do tasks read it back?  Asked once per application."""
    seen = (spark.sparkContext.applicationId, folder)
    if seen not in _SHARED:
        path, tasks = f"{folder}/hourgrid/probe-{uuid.uuid4().hex}", 2 * spark.sparkContext.defaultParallelism
        try:
            spark.range(0, tasks, 1, tasks).write.parquet(path)
            if spark.read.schema("id bigint").parquet(path).count() == tasks:
                _SHARED.add(seen)
        except (Py4JJavaError, PySparkException):  # a folder that some cannot write, or files that some do not see
            return False
    return seen in _SHARED


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; one whose file system is not named must prove to be shared."""
    try:
        folder = shared_folder(spark)
    except UnnamedFileSystem:
        folder = spark.conf.get("spark.checkpoint.dir").rstrip("/")
        if not _is_shared(spark, folder):
            raise
    return f"{folder}/hourgrid/{name}-{uuid.uuid4().hex}"
