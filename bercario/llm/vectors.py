"""Columns of vectors: which rows take part, and vectors of a batch as a matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """True for a vector without null, infinite or undefined components; a null one is not."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, number), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def of_common_length(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The rows whose vectors have the length that most have, the smaller one if two are as common."""
    length = F.size(vector)
    counts = rows.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("rows"))
    most = counts.orderBy(F.desc("rows"), "length").first()
    return (rows, 0) if most is None else (rows.filter(length == most["length"]), most["length"])
