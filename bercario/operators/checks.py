"""Key checks on built or stored tables; they report, and change nothing."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bercario.schemas import RECORD_KEY, STAR, STAR_KEYS


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys on more than one row, and on how many."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("linhas")).filter(F.col("linhas") > 1)


def records_unique(births: DataFrame) -> bool:
    """True if no record key repeats, so that removing duplicates would change nothing.

    Only the key is read and shuffled, a small part of what a distinct over whole rows moves.
    """
    keys = births.groupBy(RECORD_KEY).agg(F.count(F.lit(1)).alias("rows"))
    return keys.filter(F.col("rows") > 1).isEmpty()


def key_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, keys and repeated keys of each star table."""

    def summary(name: str, df: DataFrame) -> DataFrame:
        per_key = df.groupBy(STAR_KEYS[name]).agg(F.count(F.lit(1)).alias("rows"))
        return per_key.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("linhas"),
            F.count(F.lit(1)).alias("chaves"),
            F.count_if(F.col("rows") > 1).alias("chaves_repetidas"),
        ).select(F.lit(name).alias("tabela"), "linhas", "chaves", "chaves_repetidas")

    return reduce(DataFrame.unionByName, [summary(name, df) for name, df in tables.items() if name in STAR])


def orphans(fact: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Fact keys that the dimension does not have, with their births.

    The fact is counted per key before the join, so a frequent key is one row by then.
    """
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("nascimentos"))
    return per_key.join(dimension, F.col(key) == F.col(dimension_key), "left_anti")
