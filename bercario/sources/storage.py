"""Where a job may write, and whether a written folder is complete."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    """The file system a path belongs to, as Spark is configured to reach it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _locate(spark, path)
    return files.exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True if a Spark write to ``path`` has ended; a failed one leaves no marker."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def folders_below(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """The folders that match a pattern below each folder of ``path``."""
    files, target = _locate(spark, f"{path}/*/{pattern}")
    found = files.globStatus(target) or []
    return [str(one.getPath().toString()) for one in found if one.isDirectory()]


def written_files(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Name, time and size of each file of a table: equal as long as nobody writes it anew."""
    files, target = _locate(spark, path)
    found = files.listFiles(target, True)
    listed = []
    while found.hasNext():
        one = found.next()
        listed.append((str(one.getPath().getName()), one.getModificationTime(), one.getLen()))
    return tuple(sorted(listed))


def remove_folder(spark: SparkSession, path: str) -> None:
    files, target = _locate(spark, path)
    files.delete(target, True)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path in the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local session without
    it may use this machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        base = os.path.join(tempfile.gettempdir(), "bercario")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
