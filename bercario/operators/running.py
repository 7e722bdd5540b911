"""Running totals over any number of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bercario.sources.storage import scratch_path

# Added by ``running_totals``.
UP_TO, OVERALL = "ate_aqui", "total"


def running_totals(df: DataFrame, value: str, order: Sequence[Column]) -> DataFrame:
    """``df`` with the sum of ``value`` up to each row (``ate_aqui``) and over all rows (``total``).

    ``order`` has to tell any two rows apart. Rows are dealt by range of it and stored with the number
    of their range; each range is summed, and the sums of the ranges before it are added to the
    running totals inside it. No task sees all rows: one sees a row per range.
    """
    path = scratch_path(df.sparkSession, "running")
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = df.sparkSession.read.schema(ranged.schema).parquet(path)
    sums = ranged.groupBy("_range").agg(F.sum(value).alias("_sum"))
    # As many rows as shuffle partitions.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        F.col("_range").alias("_of"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_sum").over(Window.partitionBy()).alias(OVERALL),
    )
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.withColumn("_own", F.sum(value).over(within))
    joined = summed.join(F.broadcast(before), F.col("_range") == F.col("_of"))
    return joined.select(*df.columns, (F.col("_own") + F.col("_before")).alias(UP_TO), OVERALL)
