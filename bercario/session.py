"""Session settings the engine is meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Partition counts are left to adaptive execution: it starts from many shuffle partitions and
# merges the small ones, and splits the skewed ones of a join.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(name: str, cores: int | str = "*", **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = SETTINGS | {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"} | extra
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
