"""Label lookups: many rows on the left, one label row for each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a broadcast may hold. It is measured, never assumed.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 16 << 20

# A key is frequent if it is on more than this part of the rows, and on more than ``LEAST_HOT``.
# There are fewer frequent keys than parts, whatever the input.
HOT_PART, LEAST_HOT = 1_000, 1_000
# Keys that the sketch of a task keeps: its counts are off by less than one in 10,000 rows.
TRACKED = 16_384
# Into how many parts the rows of a frequent key are dealt; its label has as many copies.
SALTS = 512


def one_row_per_key(lookup: DataFrame, key: str) -> DataFrame:
    """One row for each key, the smallest, so that a lookup can never multiply rows."""
    rest = [name for name in lookup.columns if name != key]
    smallest = F.min(F.struct(*rest)).alias("row")
    return lookup.groupBy(key).agg(smallest).select(key, *[f"row.{name}" for name in rest])


def _width(columns: list[str]) -> Column:
    texts = [F.coalesce(F.octet_length(F.col(n).cast("string")), F.lit(0)) + 8 for n in columns]
    return reduce(Column.__add__, texts)


def fits_broadcast(
    df: DataFrame, most_rows: int | None = None, most_bytes: int | None = None
) -> bool:
    """True if ``df`` was counted and measured to be small.

    Adds up ``most_rows`` + 1 rows at most, which of a large table reads a few partitions only.
    It is meant for stored or read tables, not for the result of a shuffle.
    """
    most_rows = BROADCAST_ROWS if most_rows is None else most_rows
    most_bytes = BROADCAST_BYTES if most_bytes is None else most_bytes
    few = df.select(_width(df.columns).alias("width")).limit(most_rows + 1)
    rows, total = few.agg(F.count(F.lit(1)), F.coalesce(F.sum("width"), F.lit(0))).first()
    return rows <= most_rows and total <= most_bytes


def frequent_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys on more than a thousandth of the rows and on more than ``LEAST_HOT``.

    Found in one pass by a sketch of frequent items, which each task fills for itself and which are
    then merged: no key is shuffled. Its counts may be off a little, so a key near the limit may be
    in or out; the keys are read out once, so that every use of them sees the same ones.
    """
    kind = df.schema[key].dataType
    keyed = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"))
    sketch = F.expr(f"approx_top_k(key, {HOT_PART}, {TRACKED})").alias("items")
    found = keyed.agg(F.count(F.lit(1)).alias("rows"), sketch).first()
    limit = max(LEAST_HOT, found["rows"] // HOT_PART)
    hot = [(item["item"],) for item in found["items"] or [] if item["count"] > limit]
    return df.sparkSession.createDataFrame(hot, T.StructType([T.StructField(key, kind)]))


def attach(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    seen_in: DataFrame | None = None,
    unique: bool = False,
) -> DataFrame:
    """``df`` with the labels its key has in a lookup, for any size of lookup and any skew.

    Each row stays one row: a key counts once, see ``one_row_per_key``, which ``unique`` skips.

    A lookup measured to be small is broadcast, and ``df`` is not shuffled. Otherwise the two are
    joined by shuffle, in which the rows of frequent keys (fewer than a thousand) are dealt to
    ``SALTS`` parts one after the other, equal rows or not, and their labels copied to each part; rows
    without a key are dealt like them and get no label. ``df`` is read once, and before that its key
    alone for the sketch of ``frequent_keys``.

    ``seen_in`` may give a frame in which frequent keys are cheaper to find than in ``df``.
    """
    labels = [name for name in lookup.columns if name != key]
    small = fits_broadcast(lookup)
    lookup = lookup if unique else one_row_per_key(lookup, key)
    if small:
        return df.join(F.broadcast(lookup), key, "left").select(*df.columns, *labels)

    hot = frequent_keys(df if seen_in is None else seen_in, key)
    hot = F.broadcast(hot.select(F.col(key).alias("_hot")))
    frequent = F.col("_hot").isNotNull()
    parts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    copies = lookup.join(hot, F.col(key) == F.col("_hot"), "left")
    copies = copies.select(
        F.col(key).alias("_key"), *labels, F.explode(F.when(frequent, parts).otherwise(F.array(F.lit(0)))).alias("_of")
    )
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    salt = F.when(frequent | F.col(key).isNull(), turn).otherwise(F.lit(0)).alias("_salt")
    dealt = df.join(hot, F.col(key) == F.col("_hot"), "left").select(*df.columns, salt)
    joined = dealt.join(copies, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_of")), "left")
    return joined.select(*df.columns, *labels)
