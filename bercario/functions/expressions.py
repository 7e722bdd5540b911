"""Scalar expressions over registry columns. All are native, none calls Python per row."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def whole_number(value: Column, dtype: T.DataType) -> Column:
    """``value`` as BIGINT, cut toward zero; NULL where it is no number."""
    if isinstance(dtype, T.IntegralType):
        return value.cast("bigint")
    return number(value, dtype).try_cast("bigint")


def number(value: Column, dtype: T.DataType) -> Column:
    """``value`` as a number with its decimals; NULL where it is none.

    Text becomes a decimal, since ``7.0`` is a valid way to write code 7 and a binary fraction
    would change codes of more than 15 digits.
    """
    return value.try_cast("decimal(38,18)") if isinstance(dtype, T.StringType) else value


def compact_date(code: Column) -> Column:
    """DATE of a ddMMyyyy number with 7 or 8 digits; NULL where there is no such day.

    The leading zero of the day may be lost. Padded to nine digits, the text starts with 0 just
    when the number is not too long, and a number that is too short has day 00. The era rules out
    year 0000. The expression uses ``code`` once: it ends up inside filters, where Spark would
    compute each use anew.
    """
    text = F.concat(F.lit("AD"), F.lpad(code.cast("string"), 9, "0"))
    return F.try_to_date(text, "G'0'ddMMyyyy")


def date_in_range(date: Column, first: str, end: str) -> Column:
    """True from ``first`` up to, not including, ``end``; uses ``date`` once, as above.

    Days past the first, divided by the length of the range, are at least 0 and below 1.
    """
    start, length = datetime.date.fromisoformat(first), _days(first, end)
    return F.floor(F.date_diff(date, F.lit(start)) / length) == 0


def _days(first: str, end: str) -> int:
    return (datetime.date.fromisoformat(end) - datetime.date.fromisoformat(first)).days


def stripped_date_text(date: Column) -> Column:
    """Date text with trailing blanks, zeros and colons removed, as compatible output has it.

    Days 10, 20 and 30 lose their zero: 1990-10-20 becomes 1990-10-2.
    """
    return F.rtrim(date.cast("string"), F.lit(" 0:"))


def joined_code(*codes: Column) -> Column:
    """The digits of the codes written one after the other, as one BIGINT."""
    return F.concat(*[code.cast("string") for code in codes]).cast("bigint")


def without_check_digit(code: Column) -> Column:
    """Code text without its last character."""
    return F.substring(code, F.lit(1), F.length(code) - 1)


def completed_years(start: Column, end: Column) -> Column:
    """Whole years from ``start`` to ``end``; someone born on Feb 29 turns a year on Mar 1."""
    before_birthday = _month_and_day(end) < _month_and_day(start)
    years = F.year(end) - F.year(start) - F.when(before_birthday, 1).otherwise(0)
    return years.cast("bigint")


def _month_and_day(date: Column) -> Column:
    return F.month(date) * 100 + F.dayofmonth(date)


def age_band(age: Column, youngest: int = 15, oldest: int = 45, width: int = 5) -> Column:
    """Age band as text: ``<15``, ``15-19``, ..., ``45+``; ``invalid`` below zero."""
    low = (F.lit(youngest) + F.floor((age - youngest) / width) * width).cast("bigint")
    high = F.least(low + (width - 1), F.lit(oldest - 1).cast("bigint"))
    return (
        F.when(age < 0, "invalid")
        .when(age < youngest, f"<{youngest}")
        .when(age >= oldest, f"{oldest}+")
        .otherwise(F.concat(low.cast("string"), F.lit("-"), high.cast("string")))
    )
