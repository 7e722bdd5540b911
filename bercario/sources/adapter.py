"""Registry-shaped inputs derived from an orders/customer/nation/region schema.

No registry data ships with this repository. These expressions give the three inputs the
value ranges and flaws of the real files (lost leading zeros, unknown codes, missing values,
out-of-range dates), one birth per order, so every query can run on tables of any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bercario.schemas import BIRTH_COLUMNS

# The adapter's state names are region names; one has no abbreviation.
ADAPTER_STATES = {"AFRICA": "AF", "AMERICA": "AM", "ASIA": "AS", "EUROPE": "EU"}
ADAPTER_REGIONS = {"AF": "AFRICA", "AM": "AMERICA", "AS": "ASIA", "EU": "EUROPE"}

_BIRTHS = {
    "CONTADOR": "o_orderkey + 1",
    "CODMUNNASC": "case when o_orderkey % 59 = 0 then 119999 else 110001 + c_nationkey end",
    "LOCNASC": "case when o_orderkey % 53 = 0 then 9 else 1 + o_orderkey % 5 end",
    "ESTCIVMAE": (
        "case when o_orderkey % 37 = 0 then 9 else cast(substr(o_orderpriority, 1, 1) as int) end"
    ),
    "ESCMAE": "o_orderkey % 14",
    "CODOCUPMAE": "case when o_orderkey % 61 = 0 then 9000000000000 else o_custkey end",
    "QTDFILVIVO": "o_orderkey % 13",
    "QTDFILMORT": "(o_orderkey * 7) % 12",
    "GESTACAO": "case when o_orderkey % 41 = 0 then 9 else 1 + o_orderkey % 6 end",
    "PARTO": "case o_orderstatus when 'F' then 1 when 'O' then 2 else 9 end",
    "CONSULTAS": "1 + o_orderkey % 4",
    "DTNASC": (
        "extract(day from o_orderdate) * 1000000 + extract(month from o_orderdate) * 10000"
        " + extract(year from o_orderdate)"
    ),
    "SEXO": "o_orderkey % 3",
    "RACACOR": "1 + (o_orderkey * 3) % 5",
    "RACACORMAE": "1 + (o_orderkey + 2) % 5",
    "DTNASCMAE": (
        "(1 + o_orderkey % 28) * 1000000 + (1 + o_orderkey % 12) * 10000"
        " + (case when o_orderkey % 31 = 0 then 2014 when o_orderkey % 23 = 0 then 1949"
        " else 1950 + o_orderkey % 36 end)"
    ),
    "ESCMAEAGR1": "case when o_orderkey % 29 = 0 then null else o_orderkey % 13 end",
}
_PREGNANCY = "case when o_orderkey % 4 = 3 then '9' else cast(1 + o_orderkey % 4 as string) end"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_births(
    spark: SparkSession,
    folder: str,
    malformed_dates: bool = False,
    pregnancy: bool = False,
    years_later: bool = False,
) -> DataFrame:
    """The 17 birth columns as BIGINT.

    Some births have a municipality or an occupation that the lookup tables do not know.
    ``malformed_dates`` spoils some birth dates; ``pregnancy`` adds the text code GRAVIDEZ;
    ``years_later`` gives other births with the same numbers: four years later, of other mothers.
    """
    records = _table(spark, folder, "orders").join(
        _table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    texts = dict(_BIRTHS)
    if malformed_dates:
        texts["DTNASC"] = f"case when o_orderkey % 97 = 0 then 32011990 else {texts['DTNASC']} end"
    if years_later:
        # A compact date ends with the year; four years on, the 29th of February exists again.
        texts["DTNASC"] += " + 4"
        texts["DTNASCMAE"] += " - 1"
        texts["ESCMAE"] = "(o_orderkey + 1) % 14"
    columns = [F.expr(texts[name]).cast("bigint").alias(name) for name in BIRTH_COLUMNS]
    if pregnancy:
        columns.append(F.expr(_PREGNANCY).alias("GRAVIDEZ"))
    return records.select(*columns)


def raw_municipalities(spark: SparkSession, folder: str) -> DataFrame:
    """Every nation as a municipality with a seven-digit code."""
    nations = _table(spark, folder, "nation").join(
        _table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    code = F.concat(
        (F.col("n_nationkey") + 110001).cast("string"), (F.col("n_nationkey") % 10).cast("string")
    )
    return nations.select(
        code.alias("Codigo_Municipio_Completo"),
        F.col("n_name").alias("Nome_Municipio"),
        F.col("r_name").alias("Nome_UF"),
    )


def raw_occupations(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer as an occupation."""
    return _table(spark, folder, "customer").select(F.col("c_custkey").alias("CODIGO"), F.col("c_name").alias("TITULO"))


def not_employed_codes(spark: SparkSession, folder: str) -> DataFrame:
    """The occupation codes that stand for "not employed"."""
    customers = _table(spark, folder, "customer").filter(F.col("c_mktsegment") == "HOUSEHOLD")
    return customers.select(F.col("c_custkey").alias("CODIGO"))
