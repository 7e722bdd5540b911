"""Exact-size random sample that is repeatable and needs no global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HASH_DIGITS = 32
_STEP = 3  # hash digits per narrowing pass: a histogram of at most 4,096 rows
_FEW = 50_000  # few enough rows to rank one by one
_COPIES_PER_ROW = 10_000


def sample_exact(
    df: DataFrame, n: int, key: str, seed: int = 42, allow_fewer: bool = False
) -> DataFrame:
    """``n`` rows of ``df`` without replacement: those with the smallest seeded key hash.

    The hash of the last row taken is found first, by counting rows per hash prefix and then
    again inside the prefix the cut falls in. Each pass is a map-side combined count over the
    key column; only one row per pass comes to the driver. The sample itself is then a plain
    filter, without shuffle, and the same however the data is partitioned or recomputed.

    This runs jobs when called. ``df`` is read once per pass (two or three at any size), so it
    is best a stored table. A population below ``n`` is an error unless ``allow_fewer``.
    """
    if n < 0:
        raise ValueError(f"cannot sample {n} rows")
    if n == 0:
        return df.limit(0)
    hashed = _seeded_hash(F.col(key), seed)
    cut = _cut(df.select(hashed.alias("hash")), n)
    if cut is None:
        if allow_fewer:
            return df
        raise ValueError(f"cannot take {n} rows out of {df.count()}")
    value, at_cut, missing = cut
    if missing == at_cut:
        return df.filter(hashed <= value)
    tied = df.filter(hashed == value)
    return df.filter(hashed < value).unionByName(_part_of_tie(tied, missing))


def _seeded_hash(value: Column, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), value.cast("string")))


def _cut(hashes: DataFrame, n: int) -> tuple[str, int, int] | None:
    """The hash of the ``n``-th row, the rows that have it, and how many of them are needed.

    None if there are fewer than ``n`` rows.
    """
    missing, prefix = n, ""
    while True:
        digits = min(len(prefix) + _STEP, _HASH_DIGITS)
        group = _group_at(hashes, prefix, F.substring("hash", 1, digits), missing)
        if group is None:
            return None
        missing, prefix = missing - group["before"], group["part"]
        if group["rows"] <= _FEW or group["low"] == group["high"]:
            break
    # Few rows, or (a key that repeats often) few distinct hashes: count each hash by itself.
    group = _group_at(hashes, prefix, F.col("hash"), missing)
    return group["part"], group["rows"], missing - group["before"]


def _group_at(hashes: DataFrame, prefix: str, part: Column, position: int):
    """The group of equal ``part`` that holds the row at ``position`` among those with ``prefix``.

    ``low`` and ``high`` are equal if all its rows have one hash. They are taken over a number,
    as a minimum of text would make Spark sort all rows instead of hashing them.
    """
    number = F.xxhash64("hash")
    groups = (
        hashes.filter(F.col("hash").startswith(prefix))
        .groupBy(part.alias("part"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min(number).alias("low"), F.max(number).alias("high"))
    )
    # One task sees all groups, but there are at most 4,096 or ``_FEW`` of them.
    running = groups.withColumn("upto", F.sum("rows").over(Window.orderBy("part")))
    before = (F.col("upto") - F.col("rows")).alias("before")
    reached = running.filter(F.col("upto") >= position)
    return reached.select("part", "rows", "low", "high", before).orderBy("part").first()


def _part_of_tie(tied: DataFrame, n: int) -> DataFrame:
    """``n`` of the more than ``n`` rows that share a key, chosen by the rest of the row.

    Equal rows are counted, not ranked, and the last one is repeated as often as needed.
    """
    # Of the values as they are: text forms may drop digits of a timestamp. As 32 hex digits.
    parts = [F.xxhash64(F.lit(part), *tied.columns) for part in range(2)]
    row_hash = F.concat(*[F.lower(F.lpad(F.hex(part), 16, "0")) for part in parts])
    value, _, missing = _cut(tied.select(row_hash.alias("hash")), n)
    last = tied.filter(row_hash == value).dropDuplicates()
    starts = F.sequence(F.lit(0).cast("bigint"), F.lit(missing - 1), F.lit(_COPIES_PER_ROW))
    blocks = last.withColumn("_from", F.explode(starts)).repartition("_from")
    end = F.least(F.col("_from") + _COPIES_PER_ROW, F.lit(missing)) - 1
    copies = blocks.withColumn("_copy", F.explode(F.sequence(F.col("_from"), end)))
    return tied.filter(row_hash < value).unionByName(copies.select(*tied.columns))
