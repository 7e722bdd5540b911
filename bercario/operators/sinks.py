"""Table writes: Parquet folders or catalog tables, in three modes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bercario.sources.storage import path_exists

MODES = ("append", "append_new_only", "overwrite")

# Rows of a page of a sorted file: what a filter reads at least.
PAGE_ROWS = 4_000


def rows_not_in(
    df: DataFrame, old: DataFrame, key: str | Sequence[str] | None = None, only_in: Column | None = None
) -> DataFrame:
    """The rows of ``df`` that ``old`` does not have.

    Rows are the same if they agree in ``key``, one or more columns, null being equal to null;
    without a key, if they agree in all columns of ``df``. ``only_in`` restricts the rows of ``old``
    that are looked at to where a row of ``df`` can be, such as its partitions.
    """
    names = list(df.columns) if key is None else [key] if isinstance(key, str) else list(key)
    old = old if only_in is None else old.filter(only_in)
    old = old.select(*[F.col(name).alias(f"_old_{i}") for i, name in enumerate(names)])
    same = [df[name].eqNullSafe(old[f"_old_{i}"]) for i, name in enumerate(names)]
    return df.join(old, reduce(and_, same), "left_anti")


def records_not_in(df: DataFrame, old: DataFrame, digest: str, also: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose ``digest``, a hash of the row, and whole numbers ``also`` are not in ``old``.

    Joined by the digest alone, the numbers being compared on what it finds: if ``old`` is a table
    bucketed by the digest, its rows stay where they are.
    """
    old = old.select(*[F.col(name).alias(f"_old_{name}") for name in (digest, *also)])
    same = df[digest] == old[f"_old_{digest}"]
    for name in also:
        same = same & ((df[name] - old[f"_old_{name}"]) == 0)
    return df.join(old, same, "left_anti")


def write_table(
    df: DataFrame,
    path: str | None = None,
    *,
    table: str | None = None,
    mode: str = "append",
    key: str | Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    only_in: Column | None = None,
    sort_by: Sequence[str] = (),
    buckets: tuple[int, str] | None = None,
) -> None:
    """Write ``df`` to a Parquet folder or a catalog table, creating it if needed.

    ``append`` adds every row, so a repeated run stores everything twice. ``append_new_only``
    adds the rows that are not stored yet, see ``rows_not_in``, which makes a repeated run harmless
    (one writer at a time). ``overwrite`` replaces the table.
    """
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table name")
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    spark = df.sparkSession
    if mode == "append_new_only":
        stored = spark.catalog.tableExists(table) if table else path_exists(spark, path)
        if stored:
            # The schema is given, as a failed first write leaves a folder without any file.
            old = spark.table(table) if table else spark.read.schema(df.schema).parquet(path)
            df = rows_not_in(df, old, key, only_in)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode("overwrite" if mode == "overwrite" else "append").partitionBy(*partition_by)
    if sort_by:
        writer = writer.option("parquet.page.row.count.limit", PAGE_ROWS)
    if buckets and table:
        many, column = buckets
        dealt = df.repartition(many, column).write.mode("overwrite" if mode == "overwrite" else "append")
        writer = dealt.partitionBy(*partition_by).bucketBy(many, column).sortBy(column)
    if table:
        writer.format("parquet").saveAsTable(table)
    else:
        writer.parquet(path)
