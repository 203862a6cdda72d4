"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def build_session(
    app: str = "changeloom",
    cores: int | str = "*",
    partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A local session with the settings the jobs expect; a cluster sets the same ones at submit time."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Build a hash table of the smaller side of a partition where that is safe, instead of sorting both.
        .config("spark.sql.join.preferSortMergeJoin", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    )
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for name, value in (settings or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a temporary
    folder: on a cluster, executors could not see a folder of the driver's machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root(spark.sparkContext.applicationId)


@cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"changeloom-{application}-")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go when it ends, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable in sessions that did not set the folder at start."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(work_path(spark, "rdd"))


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows of a schema, known as empty to the optimizer."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
