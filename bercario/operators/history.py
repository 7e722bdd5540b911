"""Labels over time: which label a code had on which day.

A history is built from dated labels (``code, labels..., desde``): what a reference file said from its
day on. It has a row per code and interval, ``[desde, ate)``, where equal labels that follow each
other are one interval and the last has no end. Files may be added in any order of their days. A code
that a later file lacks keeps its label: reference files drop codes that are no longer given out,
and old records still have them.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bercario.operators.lookups import attach, one_row_per_key

SINCE, UNTIL = "desde", "ate"


def dated(labels: DataFrame, key: str, since: datetime.date) -> DataFrame:
    """The labels of a file that holds from a day on, one row per code, the smallest of several."""
    return one_row_per_key(labels.filter(F.col(key).isNotNull()), key).withColumn(SINCE, F.lit(since))


def history_of(dated_labels: DataFrame, key: str) -> DataFrame:
    """The intervals of dated labels; of two labels of one day the smaller counts.

    Rows of a code meet in one task, sorted: there is one for each change of its label.
    """
    labels = [name for name in dated_labels.columns if name not in (key, SINCE)]
    label = F.struct(*labels)
    by_day = dated_labels.groupBy(key, SINCE).agg(F.min(label).alias("label"))
    by_code = Window.partitionBy(key).orderBy(SINCE)
    changes = by_day.withColumn("before", F.lag("label").over(by_code)).withColumn("first", F.row_number().over(by_code) == 1)
    changes = changes.filter(F.col("first") | ~F.col("label").eqNullSafe(F.col("before")))
    until = F.lead(SINCE).over(by_code)
    return changes.select(key, *[f"label.{name}" for name in labels], SINCE, until.alias(UNTIL))


def labels_as_of(history: DataFrame, day: datetime.date | None = None) -> DataFrame:
    """The labels in force on a day, in the shape of a dimension; without a day, the newest."""
    if day is None:
        chosen = history.filter(F.col(UNTIL).isNull())
    else:
        chosen = history.filter((F.col(SINCE) <= F.lit(day)) & (F.col(UNTIL).isNull() | (F.lit(day) < F.col(UNTIL))))
    return chosen.drop(SINCE, UNTIL)


def new_labels(dated_labels: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """The dated labels that say something else than the history does for their day."""
    labels = [name for name in dated_labels.columns if name not in (key, SINCE)]
    known = history.select(
        F.col(key).alias("_key"), *[F.col(name).alias(f"_{name}") for name in labels],
        F.col(SINCE).alias("_since"), F.col(UNTIL).alias("_until"),
    )
    same = F.col(key) == F.col("_key")
    for name in labels:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    same = same & (F.col("_since") <= F.col(SINCE)) & (F.col("_until").isNull() | (F.col(SINCE) < F.col("_until")))
    return dated_labels.join(known, same, "left_anti")


def attach_as_of(df: DataFrame, history: DataFrame, key: str, day: Column, earliest: bool = True) -> DataFrame:
    """``df`` with the labels that its key had on a day, NULL for a code without.

    Before the first day of a code its first label holds, unless ``earliest`` is False. The intervals
    of a code become one row, so a lookup of any size and a code on a third of the rows are handled as
    by ``attach``, and the interval is chosen in the row: nothing is joined by range.
    """
    labels = [name for name in history.columns if name not in (key, SINCE, UNTIL)]
    interval = F.struct(F.col(SINCE), F.col(UNTIL), *labels)
    # As many intervals as a code had labels.
    per_code = history.groupBy(key).agg(F.sort_array(F.collect_list(interval)).alias("_labels"))
    joined = attach(df, per_code, key, unique=True)
    known = F.filter("_labels", lambda i: i[SINCE] <= day)
    last = F.try_element_at(known, F.lit(-1))
    if earliest:
        last = F.coalesce(last, F.try_element_at(F.col("_labels"), F.lit(1)))
    return joined.select(*df.columns, *[last[name].alias(name) for name in labels])
