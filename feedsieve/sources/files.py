"""Small files and folders of whatever file system a path names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    """The path and its file system."""
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder with all it holds."""
    located, system = _located(spark, path)
    return system.delete(located, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if there is no folder."""
    located, system = _located(spark, path)
    if not system.exists(located):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(located))


def make_folder(spark: SparkSession, path: str) -> None:
    located, system = _located(spark, path)
    system.mkdirs(located)


def read_text(spark: SparkSession, path: str) -> str:
    located, system = _located(spark, path)
    stream = system.open(located)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def place_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a file in place whole, by rename; False if there is one already."""
    located, system = _located(spark, path)
    if system.exists(located):
        return False
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return system.rename(draft, located)


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors share, below ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="feedsieve-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/feedsieve-{uuid.uuid4().hex}"
