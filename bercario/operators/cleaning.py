"""From raw birth records to typed, plausible ones.

The order matters and is kept: complete rows, then parsing, then the plausibility filters. Each
step is a projection or filter, so cleaning never shuffles and runs inside the scan stage.

A strict caller is told of unreadable values before it gets any row, by a look at all complete
rows, so that neither a filter nor a column that is not read can hide one.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bercario.functions.expressions import compact_date, date_in_range, number, whole_number
from bercario.schemas import BIRTH_COLUMNS, DATE_COLUMNS

# Mothers are born in [first, end), and have at most this many children.
MOTHER_BORN_FROM, MOTHER_BORN_BEFORE = "1950-01-01", "2014-01-01"
MOST_CHILDREN = 10
CHILDREN = ["QTDFILVIVO", "QTDFILMORT"]

# Added by ``assessed_births``.
ACCEPTED, REASON = "aceito", "motivo"


class UnreadableBirths(ValueError):
    """Complete records hold values that cannot be read."""


def _computed_once(df: DataFrame) -> DataFrame:
    """``df``, whose expressions filters above it will not compute a second time.

    Spark moves a filter below a projection and repeats the expressions there, but not below one
    with a value that is new for each row. Without that, parsing twice makes one method so large
    that the JVM never compiles it.
    """
    return df.withColumn("_row", F.monotonically_increasing_id()).filter("_row >= 0").drop("_row")


def complete_rows(raw: DataFrame) -> DataFrame:
    """Rows with a value in all 17 columns, the unused education group included.

    Written as plain null tests, which (unlike ``dropna``) reach a Parquet scan.
    """
    return raw.filter(reduce(and_, [F.col(name).isNotNull() for name in BIRTH_COLUMNS]))


def _types(raw: DataFrame) -> dict[str, T.DataType]:
    return {field.name: field.dataType for field in raw.schema}


def _parsed(raw: DataFrame) -> dict[str, Column]:
    """Typed expression of every birth column; NULL where the text cannot be read."""
    types = _types(raw)
    numbers = {name: whole_number(F.col(name), types[name]) for name in BIRTH_COLUMNS}
    return numbers | {name: compact_date(numbers[name]) for name in DATE_COLUMNS}


def _doubtful(raw: DataFrame) -> list[str]:
    """Columns that may hold an unreadable value: dates, and codes not stored as whole numbers."""
    whole = {field.name for field in raw.schema if isinstance(field.dataType, T.IntegralType)}
    return [name for name in BIRTH_COLUMNS if name in DATE_COLUMNS or name not in whole]


def _reason(unreadable: dict[str, Column]) -> Column:
    return F.concat_ws(",", *[F.when(bad, F.lit(name)) for name, bad in unreadable.items()])


def require_readable(raw: DataFrame) -> None:
    """An error that names columns and values if complete rows hold unreadable ones.

    Runs a job over the columns that may be unreadable, whatever the caller goes on to read.
    """
    bad = rejected_births(raw).limit(1).collect()
    if bad:
        names = bad[0][REASON].split(",")
        raise UnreadableBirths("; ".join(f"unreadable {name}: {bad[0][name]}" for name in names))


def parse_columns(df: DataFrame, columns: list[str], strict: bool = True) -> DataFrame:
    """``df`` with the named columns as BIGINT or DATE, unreadable values as NULL.

    When strict, complete rows of the whole frame must be readable, see ``require_readable``.
    """
    if strict:
        require_readable(df)
    parsed = _parsed(df)
    return df.withColumns({name: parsed[name] for name in columns})


def _mother_plausible(born: Column) -> Column:
    return date_in_range(born, MOTHER_BORN_FROM, MOTHER_BORN_BEFORE)


def _few_children(df: DataFrame) -> Column:
    """Counts are compared with their decimals, before they are cut: 10.5 is too many."""
    types = _types(df)
    return reduce(and_, [number(F.col(n), types[n]) <= MOST_CHILDREN for n in CHILDREN])


def plausible_births(df: DataFrame) -> DataFrame:
    """Rows whose mother's birth date (parsed) and child counts (parsed or not) are in range."""
    return df.filter(_mother_plausible(F.col("DTNASCMAE")) & _few_children(df))


def clean_births(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Complete, parsed, plausible births.

    When strict, an unreadable value in any complete row is an error here, before a row is
    returned. Otherwise such rows are left out and returned by ``rejected_births``.
    """
    if strict:
        require_readable(raw)
    complete = complete_rows(raw)
    parsed = _parsed(complete)
    columns = [parsed[name].alias(name) for name in BIRTH_COLUMNS]
    once = _computed_once(complete.select(*columns, _few_children(complete).alias("_few")))
    plausible = _mother_plausible(F.col("DTNASCMAE")) & F.col("_few")
    return complete_rows(once).filter(plausible).select(*BIRTH_COLUMNS)


def rejected_births(raw: DataFrame) -> DataFrame:
    """Complete rows with an unreadable value, as they came, and the names of those columns.

    Plausibility is not asked: a row that another filter would drop is listed as well.
    """
    complete = complete_rows(raw)
    parsed = _parsed(complete)
    flags = [parsed[name].isNull().alias(f"_bad_{name}") for name in _doubtful(complete)]
    once = _computed_once(complete.select(*BIRTH_COLUMNS, *flags))
    unreadable = {name: F.col(f"_bad_{name}") for name in _doubtful(complete)}
    bad = once.filter(reduce(or_, unreadable.values()))
    return bad.select(*BIRTH_COLUMNS, _reason(unreadable).alias(REASON))


def assessed_births(raw: DataFrame) -> DataFrame:
    """Every complete row, parsed, with what a strict run has to know, for storing.

    ``aceito`` says that the row is readable and plausible. For an unreadable value the parsed
    column is NULL and ``bruto_<column>`` has the text.
    """
    complete = complete_rows(raw)
    parsed = _parsed(complete)
    texts = {
        f"bruto_{name}": F.when(parsed[name].isNull(), F.col(name).cast("string"))
        for name in _doubtful(complete)
    }
    rows = complete.select(
        *[parsed[name].alias(name) for name in BIRTH_COLUMNS],
        *[text.alias(name) for name, text in texts.items()],
        _few_children(complete).alias("_few"),
    )
    readable = reduce(and_, [F.col(name).isNotNull() for name in BIRTH_COLUMNS])
    plausible = _mother_plausible(F.col("DTNASCMAE")) & F.col("_few")
    accepted = F.coalesce(readable & plausible, F.lit(False))
    return rows.withColumn(ACCEPTED, accepted).drop("_few")


def _flags(assessed: DataFrame) -> dict[str, Column]:
    texts = [name for name in assessed.columns if name.startswith("bruto_")]
    return {name.removeprefix("bruto_"): F.col(name).isNotNull() for name in texts}


def unreadable(assessed: DataFrame) -> Column:
    """True for the rows of ``assessed_births`` that hold an unreadable value."""
    return reduce(or_, _flags(assessed).values())


def unreadable_rows(assessed: DataFrame) -> DataFrame:
    """The rows of ``assessed_births`` with an unreadable value, as text, and which columns."""
    flags = _flags(assessed)
    columns = [
        F.coalesce(F.col(name).cast("string"), F.col(f"bruto_{name}")).alias(name)
        if name in flags
        else F.col(name).cast("string").alias(name)
        for name in BIRTH_COLUMNS
    ]
    bad = assessed.filter(unreadable(assessed))
    return bad.select(*columns, _reason(flags).alias(REASON))
