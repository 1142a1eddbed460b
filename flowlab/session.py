"""Session factory and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

S3A_CONF = {"spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"}


def build_session(
    app_name: str = "flowlab",
    conf: dict[str, str] | None = None,
    master: str | None = None,
    s3a: bool = False,
) -> SparkSession:
    """Get or create a session with UTC time, adaptive execution and, on request, S3A."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULT_CONF, **(S3A_CONF if s3a else {}), **(conf or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Sizes a cluster may tune: rows per ordered slice, rows gathered per quantile, points per block, rows of a
# tree's branch that one task grows.
SIZES = {
    "spark.flowlab.rowsPerSlice": 1_000_000,
    "spark.flowlab.gatherRows": 50_000,
    "spark.flowlab.blockRows": 4_096,
    "spark.flowlab.subtreeRows": 1_000_000,
}


def size(spark: SparkSession, name: str) -> int:
    """A size from the session, or its default."""
    return int(spark.conf.get(name, str(SIZES[name])))


def shared_folder(spark: SparkSession) -> str:
    """Root folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A folder of our own is made only in local mode with the setting unset (tests).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="flowlab-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours on whatever file system it lies; none there is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``fresh_folder`` named."""
    if not path.startswith(f"{shared_folder(spark)}/"):
        raise ValueError(f"{path} is not below the shared folder")
    remove_path(spark, path)
