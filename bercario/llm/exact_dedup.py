"""Exact copies, by sorting contents.

Rows are dealt out by range of their normalised content, with splitters that Spark samples; the
external sort of each range then puts equal texts next to each other, and the window over the
sorted rows compares whole neighbouring texts. The range key is the start of the text, a hash
of all of it and, for a group too large for one task, a salt, so that no splitter is a long text
and no group fills a task. The salt follows the place of a row in the input, not its id: copies
without an id, or with one id, are spread like any others.

Defined results: a null text is an empty one. A null id is smaller than any other; copies that
are all without id have a null ``keep_id``. Of rows that repeat an id and a text, one is kept.
Columns besides id and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bercario.llm.tables import stored

# A group of more rows than these, and than a thousandth of all rows, is split.
LEAST_SPLIT = 500
_SPLITTER_CHARS = 24


def large_groups(rows: DataFrame, limit: int) -> DataFrame:
    """Content hashes on more than ``limit`` rows, and over how many salts to spread them."""
    counted = rows.groupBy("content").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit)
    return counted.select("content", F.ceil(F.col("n") / limit).cast("int").alias("salts"))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    least_split: int = LEAST_SPLIT,
) -> DataFrame:
    """One row per row: id, keep_id, group_size, kept, text_sha256.

    Of equal normalised texts the row with the largest id stays.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (normalise(text) if normalise else text).alias("body")
    )
    rows = rows.withColumn("content", F.xxhash64("body")).withColumn("place", F.monotonically_increasing_id())
    # Groups above the limit hold all rows at most, so there are fewer than a thousand of them:
    # few enough to broadcast whatever the input.
    limit = max(least_split, docs.count() // 1000)
    rows = rows.join(F.broadcast(large_groups(rows, limit)), "content", "left")
    salt = F.coalesce(F.pmod(F.xxhash64("place"), F.col("salts")), F.lit(0)).cast("int")
    rows = rows.select(
        "doc_id",
        "body",
        "content",
        F.substring("body", 1, _SPLITTER_CHARS).alias("head"),
        salt.alias("salt"),
        F.col("salts").isNotNull().alias("split"),
    )
    dealt = rows.repartitionByRange("head", "content", "salt")
    equal = W.partitionBy("head", "content", "salt", "body")
    descending = equal.orderBy(F.col("doc_id").desc_nulls_last())
    runs = dealt.select(
        "doc_id",
        F.sha2("body", 256).alias("text_sha256"),
        F.first("doc_id").over(descending).alias("keep_id"),
        F.count(F.lit(1)).over(equal).alias("group_size"),
        (F.row_number().over(descending) == 1).alias("leads"),
        "split",
        "salt",
    )
    runs = stored(runs, "exact-dedup")
    # A split group lies in several runs; each gives one row here. There are fewer than a
    # thousand such groups, so their totals can be broadcast.
    whole = (
        runs.filter("split AND leads")
        .groupBy("text_sha256")
        .agg(F.max(F.struct("keep_id", "salt")).alias("most"), F.sum("group_size").alias("whole_size"))
        .select(
            "text_sha256",
            F.col("most.keep_id").alias("whole_id"),
            F.col("most.salt").alias("whole_salt"),
            "whole_size",
        )
    )
    joined = runs.join(F.broadcast(whole), "text_sha256", "left")
    alone = F.col("whole_size").isNull()
    keep_id = F.when(alone, F.col("keep_id")).otherwise(F.col("whole_id"))
    # Of runs that lead with one id, the run of the greatest salt keeps its row.
    stays = F.col("leads") & F.col("keep_id").eqNullSafe(keep_id)
    stays = stays & (alone | (F.col("salt") == F.col("whole_salt")))
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("whole_size", "group_size").alias("group_size"),
        stays.alias("kept"),
        "text_sha256",
    )
