"""Readers of the three ``;``-separated inputs.

Every column is read as text and picked by its header name. A declared schema would be
matched by position, and the registry's column order differs between years.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bercario.functions.codes import STATES
from bercario.functions.expressions import whole_number, without_check_digit
from bercario.schemas import (
    BIRTH_COLUMNS,
    MUNICIPALITY_COLUMNS,
    OCCUPATION_COLUMNS,
    RECORD_KEY,
)

# The texts, besides the empty one, that mean "missing" in the input files.
MISSING = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


# The line as it is, where it has more or fewer fields than the header; else NULL.
BROKEN_LINE = "_linha"

# Where a line comes from: the file, and the byte at which the part of it begins that a task read.
FILE, BLOCK = "arquivo", "bloco"

# What ``split_births`` says of a line, and the column that says it.
VERDICT = "veredito"
COMPLETE, INCOMPLETE, TOO_MANY_FIELDS = "completa", "incompleta", "campos demais"


def _fields(line: Column, sep: str, quote: str) -> Column:
    """The number of fields of a line; a separator inside quotes does not count."""
    quoted = rf"{re.escape(quote)}[^{re.escape(quote)}]*+{re.escape(quote)}"
    return F.size(F.split(F.regexp_replace(line, quoted, ""), re.escape(sep), -1))


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    *,
    sep: str = ";",
    quote: str = '"',
    encoding: str = "UTF-8",
    missing: Sequence[str] = MISSING,
    multiline: bool = False,
    lineage: bool = False,
) -> DataFrame:
    """The named columns as text, missing markers as NULL, and lines with too many fields.

    ``BROKEN_LINE`` has the text of a line with more fields than the header, whose values may
    belong to other columns. A short line lacks its last values, like any incomplete row.

    One path (a file, folder or glob) shares one header, and a file in it with another header
    is an error. Paths in a list may have different column orders: they are joined by name.
    A quote inside quotes is written twice; a backslash is an ordinary character.
    ``multiline`` allows line breaks inside quotes, but makes each file a single task. ``lineage``
    adds ``arquivo`` and ``bloco``, where the line comes from.
    """
    options = {
        "header": True,
        "sep": sep,
        "quote": quote,
        "escape": quote,
        "encoding": encoding,
        "multiLine": multiline,
        "enforceSchema": False,
    }

    places = []
    if lineage:
        places = [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK)]

    def read_one(path: str) -> DataFrame:
        header = spark.read.options(**options).csv(path).columns
        schema = T.StructType([T.StructField(name, T.StringType()) for name in [*header, BROKEN_LINE]])
        # Fields are only counted where all of a line is parsed.
        whole = {"columnNameOfCorruptRecord": BROKEN_LINE, "columnPruning": False}
        reader = spark.read.options(**options, **whole).schema(schema)
        long = _fields(F.col(BROKEN_LINE), sep, quote) > len(header)
        line = F.when(long, F.col(BROKEN_LINE)).alias(BROKEN_LINE)
        return reader.csv(path).select(*columns, line, *places)

    listed = [paths] if isinstance(paths, str) else list(paths)
    texts = reduce(DataFrame.unionByName, [read_one(path) for path in listed])
    return texts.select(
        *[F.when(~F.col(name).isin(*missing), F.col(name)).alias(name) for name in columns],
        BROKEN_LINE,
        *([FILE, BLOCK] if lineage else []),
    )


def read_delimited(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], **options
) -> DataFrame:
    """The named columns of ``read_lines``; a line with too many fields is an error."""
    lines = read_lines(spark, paths, columns, **options)
    error = F.raise_error(F.concat(F.lit("too many fields: "), F.col(BROKEN_LINE)))
    # Part of every column, so that no projection can leave the test out.
    tested = F.when(F.col(BROKEN_LINE).isNotNull(), error)
    return lines.select(*[F.coalesce(tested, F.col(name)).alias(name) for name in columns])


def read_births(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """The 17 birth columns, as text, without the lines of ``rejected_lines``."""
    lines = read_lines(spark, paths, BIRTH_COLUMNS, **{"encoding": "ISO-8859-1"} | options)
    return lines.filter(F.col(BROKEN_LINE).isNull()).select(*BIRTH_COLUMNS)


def rejected_lines(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """Lines of a births file with too many fields: CONTADOR as read, ``linha`` and ``motivo``."""
    lines = read_lines(spark, paths, BIRTH_COLUMNS, **{"encoding": "ISO-8859-1"} | options)
    broken = lines.filter(F.col(BROKEN_LINE).isNotNull())
    reason = F.lit("campos demais").alias("motivo")
    return broken.select(RECORD_KEY, F.col(BROKEN_LINE).alias("linha"), reason)


def split_births(spark: SparkSession, paths: str | Sequence[str], target: str, **options) -> dict[str, DataFrame]:
    """Births files read once, and stored at ``target`` by what is to be said of each line.

    By verdict: ``completa`` and ``incompleta`` lines with the 17 columns as text, lines with
    ``campos demais`` as they are; all with the file they come from and the place of the block. A
    later step reads the lines of one verdict, a folder of its own, and never the text files again.
    """
    options = {"encoding": "ISO-8859-1"} | options
    lines = read_lines(spark, paths, BIRTH_COLUMNS, lineage=True, **options)
    complete = reduce(Column.__and__, [F.col(name).isNotNull() for name in BIRTH_COLUMNS])
    verdict = (
        F.when(F.col(BROKEN_LINE).isNotNull(), TOO_MANY_FIELDS).when(complete, COMPLETE).otherwise(INCOMPLETE)
    )
    named = lines.withColumn(VERDICT, verdict).withColumnRenamed(BROKEN_LINE, "linha")
    named.write.mode("overwrite").partitionBy(VERDICT).parquet(target)
    stored = spark.read.schema(named.schema).parquet(target)

    def of(name: str, *columns: str) -> DataFrame:
        return stored.filter(F.col(VERDICT) == name).select(*columns, FILE, BLOCK)

    return {
        COMPLETE: of(COMPLETE, *BIRTH_COLUMNS),
        INCOMPLETE: of(INCOMPLETE, *BIRTH_COLUMNS),
        TOO_MANY_FIELDS: of(TOO_MANY_FIELDS, RECORD_KEY, "linha"),
    }


def read_municipalities(
    spark: SparkSession,
    paths: str | Sequence[str],
    states: Mapping[str, str] = STATES,
    **options,
) -> DataFrame:
    texts = read_delimited(spark, paths, MUNICIPALITY_COLUMNS, **options)
    return prepare_municipalities(texts, states)


def read_occupations(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    texts = read_delimited(spark, paths, OCCUPATION_COLUMNS, **{"encoding": "ISO-8859-1"} | options)
    return prepare_occupations(texts)


def prepare_municipalities(df: DataFrame, states: Mapping[str, str] = STATES) -> DataFrame:
    """Municipality code without check digit, name, and state abbreviation (NULL if unknown)."""
    state_names = [F.lit(item) for pair in states.items() for item in pair]
    return df.select(
        without_check_digit(F.col("Codigo_Municipio_Completo")).alias("Codigo_Municipio_Completo"),
        "Nome_Municipio",
        F.create_map(*state_names)[F.col("Nome_UF")].alias("UF"),
    )


def prepare_occupations(df: DataFrame) -> DataFrame:
    """Occupation code as a number, so that leading zeros do not matter, and its title."""
    code = whole_number(F.col("CODIGO"), df.schema["CODIGO"].dataType)
    return df.select(code.alias("CODIGO"), "TITULO")
