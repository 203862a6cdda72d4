"""The few file-system calls that DataFrames do not offer, on whatever file system a path belongs to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none if it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def size(spark: SparkSession, path: str) -> int:
    """Bytes below ``path``."""
    fs, target = _open(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds anything but marker files, whose names start with a dot or an underscore."""
    return any(not name.startswith((".", "_")) for name in children(spark, path))


def written(spark: SparkSession, path: str) -> bool:
    """Whether a job finished writing the folder."""
    return exists(spark, f"{path}/_SUCCESS")


def make(spark: SparkSession, path: str) -> None:
    """A folder, empty if it is new."""
    fs, target = _open(spark, path)
    fs.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete or absent: it is written under another name first."""
    fs, target = _open(spark, path)
    part = target.suffix(".part")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    fs.delete(target, False)
    fs.rename(part, target)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file written by ``write_text``; None if there is none."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
