"""Scalar expressions on literal values."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bercario.functions import codes
from bercario.functions.expressions import (
    age_band,
    compact_date,
    completed_years,
    date_in_range,
    joined_code,
    stripped_date_text,
    whole_number,
    without_check_digit,
)


def values(spark, rows, schema, expression):
    return [row[0] for row in spark.createDataFrame(rows, schema).select(expression).collect()]


def one_column(spark, items, kind, expression):
    return values(spark, [(item,) for item in items], f"c {kind}", expression(F.col("c")))


def day(text):
    return datetime.date.fromisoformat(text)


@pytest.mark.parametrize(
    ("number", "expected"),
    [
        (1011990, "1990-01-01"),
        (31121990, "1990-12-31"),
        (29022000, "2000-02-29"),
        (1012014, "2014-01-01"),
        (29021900, None),
        (32011990, None),
        (30022001, None),
        (1131990, None),
        (1001990, None),
        (111990, None),
        (311219901, None),
        (3112199012, None),
        (1010000, None),
        (-1011990, None),
        (0, None),
        (9223372036854775807, None),
        (None, None),
    ],
)
def test_compact_date(spark, number, expected):
    found = one_column(spark, [number], "BIGINT", compact_date)
    assert found == [expected and day(expected)]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_compact_date_is_a_calendar_day_in_any_time_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = one_column(spark, [21101990, 1011950, 1011910], "BIGINT", compact_date)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == [day("1990-10-21"), day("1950-01-01"), day("1910-01-01")]


def test_date_in_range_has_an_open_end(spark):
    days = [day(d) for d in ["1949-12-31", "1950-01-01", "2013-12-31", "2014-01-01", "0001-01-01"]]
    found = one_column(
        spark, [*days, None], "DATE", lambda c: date_in_range(c, "1950-01-01", "2014-01-01")
    )
    assert found == [False, True, True, False, False, None]


def test_whole_number_of_text(spark):
    texts = ["7", "7.0", "7.9", "-7.9", " 7 ", "010105", "abc", "NaN", "1e400", "", None]
    found = one_column(spark, texts, "STRING", lambda c: whole_number(c, T.StringType()))
    assert found == [7, 7, 7, -7, 7, 10105, None, None, None, None, None]


def test_stripped_date_text(spark):
    days = [day(d) for d in ["1990-10-20", "2022-01-30", "2022-01-05", "2000-10-10", "2001-12-31"]]
    found = one_column(spark, days, "DATE", stripped_date_text)
    assert found == ["1990-10-2", "2022-01-3", "2022-01-05", "2000-10-1", "2001-12-31"]


def test_joined_code(spark):
    found = values(
        spark, [(1, 2), (9, 0), (1, 10), (0, 1)], "a BIGINT, b BIGINT",
        joined_code(F.col("a"), F.col("b")),
    )
    assert found == [12, 90, 110, 1]


def test_without_check_digit(spark):
    assert one_column(spark, ["3509502", "1", None], "STRING", without_check_digit) == ["350950", "", None]


@pytest.mark.parametrize(
    ("born", "at", "age"),
    [
        ("1992-02-29", "2023-02-28", 30),
        ("1992-02-29", "2023-03-01", 31),
        ("1992-02-29", "2024-02-29", 32),
        ("1990-05-10", "2020-05-09", 29),
        ("1990-05-10", "2020-05-10", 30),
        ("2020-05-10", "2019-05-09", -2),
    ],
)
def test_completed_years(spark, born, at, age):
    found = values(
        spark, [(day(born), day(at))], "a DATE, b DATE", completed_years(F.col("a"), F.col("b"))
    )
    assert found == [age]


def test_age_band(spark):
    ages = [-1, 0, 14, 15, 19, 20, 24, 43, 44, 45, 99]
    assert one_column(spark, ages, "BIGINT", age_band) == [
        "invalid", "<15", "<15", "15-19", "15-19", "20-24", "20-24", "40-44", "40-44", "45+", "45+",
    ]


def test_age_band_with_other_limits(spark):
    ages = [9, 10, 19, 20, 24, 25]
    found = one_column(spark, ages, "BIGINT", lambda c: age_band(c, 10, 25, 10))
    assert found == ["<10", "10-19", "10-19", "20-24", "20-24", "25+"]


@pytest.mark.parametrize(
    ("table", "code", "label"),
    [
        (codes.EDUCATION, 0, "Sem Escolaridade"),
        (codes.EDUCATION, 12, "Ensino Médio Incompleto ou Inespecífico"),
        (codes.EDUCATION, 13, None),
        (codes.VISITS, 4, "7 e mais"),
        (codes.SEX, 0, "I – Ignorado"),
        (codes.DELIVERY, 2, "Cesário"),
        (codes.GESTATION, 5, "37 a 41 semanas"),
        (codes.RACE, 5, "Indígena"),
        (codes.RACE, 9, None),
        (codes.MARITAL_STATUS, 9, "Ignorada"),
        (codes.BIRTH_PLACE, 9, None),
        (codes.EDUCATION, None, None),
    ],
)
def test_decode(spark, table, code, label):
    assert one_column(spark, [code], "BIGINT", lambda c: codes.decode(c, table)) == [label]


def test_decode_text_codes(spark):
    found = one_column(spark, ["1", "9", "4"], "STRING", lambda c: codes.decode(c, codes.PREGNANCY))
    assert found == ["Única", "Ignorado", None]


def test_states_and_regions():
    assert len(codes.STATES) == len(codes.REGIONS) == 27
    assert codes.STATES["São Paulo"] == "SP"
    assert codes.REGIONS["SP"] == "Sudeste"
    assert codes.REGIONS["DF"] == "Centro-Oeste"
