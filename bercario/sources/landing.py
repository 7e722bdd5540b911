"""Landing: store a source once, never replacing what is there."""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame

from bercario.sources.storage import is_complete, path_exists

LANDING_STATUS = "status STRING, message STRING"


def land_if_absent(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` unless a complete copy is there; one row says what happened.

    ``created``: written now. ``exists``: a complete copy was there and is unchanged.
    ``error``: nothing usable was written, which includes a folder that a failed or still
    running write left without its completion marker. Assumes one writer per path.
    """
    spark = df.sparkSession

    def outcome(status: str, message: str) -> DataFrame:
        return spark.createDataFrame([(status, message)], LANDING_STATUS)

    if not path:
        return outcome("error", "the path is empty")
    if is_complete(spark, path):
        return outcome("exists", f"already stored: {path}")
    if path_exists(spark, path):
        return outcome("error", f"incomplete, remove it first: {path}")
    try:
        df.write.mode("errorifexists").parquet(path)
    except (PySparkException, Py4JError) as failure:
        return outcome("error", str(failure))
    return outcome("created", f"stored: {path}")
