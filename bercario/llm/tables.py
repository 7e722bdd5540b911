"""Inputs, stored intermediate tables and row keys that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bercario.sources.storage import scratch_path


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def stored(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """The frame, written once to the shared folder and read back; with options of the writer.

    Later steps read the files, so a lost executor never makes them compute the frame anew.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def text_key(text: Column) -> Column:
    """Together with the id, tells apart rows that share an id."""
    return F.xxhash64(text)


def matching(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equality of the columns, where null equals null."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition
