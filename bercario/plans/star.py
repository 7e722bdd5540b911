"""The eight star tables, and the wide views that reports read.

``births`` is always the output of ``clean_births`` (or a sample of it), or the stored records. A
birth is a record, distinct in all its columns: two rows are one birth only if they agree in
everything, so all tables and views count the same births, whichever columns they show.
``unique`` says that no record repeats, as in the stored records: the large tables then need no
distinct, and are built without any shuffle. Labels are added after codes, so text is never
shuffled where a number will do.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bercario.functions import codes
from bercario.functions.codes import decode
from bercario.functions.expressions import joined_code, stripped_date_text
from bercario.operators.lookups import attach
from bercario.schemas import BIRTH_COLUMNS, RECORD_HASH, RECORDS, YEAR, as_table, table_schema

# Rows of the reference files that occur in the births -------------------------------------


def join_municipalities(births: DataFrame, municipalities: DataFrame) -> DataFrame:
    """One row per birth and matching municipality: code, name, state."""
    matching = births["CODMUNNASC"].cast("string") == municipalities["Codigo_Municipio_Completo"]
    return births.join(municipalities, matching).select("CODMUNNASC", "Nome_Municipio", "UF")


def join_occupations(births: DataFrame, occupations: DataFrame) -> DataFrame:
    """One row per birth and matching occupation: code, title."""
    matching = births["CODOCUPMAE"] == occupations["CODIGO"]
    return births.join(occupations, matching).select("CODOCUPMAE", "TITULO")


def dim_municipio(births: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Municipalities that occur in the births.

    The births are reduced to their distinct codes before the join; a distinct after it would
    first build one row per birth.
    """
    occurring = births.select(F.col("CODMUNNASC").cast("string").alias("code")).distinct()
    matching = F.col("Codigo_Municipio_Completo") == F.col("code")
    return municipality_labels(municipalities.join(occurring, matching, "left_semi")).distinct()


def dim_profissao(births: DataFrame, occupations: DataFrame) -> DataFrame:
    """Occupations that occur in the births; see ``dim_municipio``."""
    occurring = births.select(F.col("CODOCUPMAE").alias("code")).distinct()
    matching = F.col("CODIGO") == F.col("code")
    return occupation_labels(occupations.join(occurring, matching, "left_semi")).distinct()


def municipality_labels(municipalities: DataFrame) -> DataFrame:
    """All municipalities in the shape of ``dim_municipio``."""
    labels = municipalities.select(
        F.col("Codigo_Municipio_Completo").try_cast("bigint").alias("id_codmunicipionasc"),
        F.col("Nome_Municipio").alias("cidade"),
        F.col("UF").alias("estado"),
    )
    return as_table(labels, "dim_municipio")


def occupation_labels(occupations: DataFrame) -> DataFrame:
    """All occupations in the shape of ``dim_profissao``."""
    labels = occupations.select(
        F.col("CODIGO").alias("id_ocupmae"), F.col("TITULO").alias("ocupacao")
    )
    return as_table(labels, "dim_profissao")


# Code dimensions ---------------------------------------------------------------------------


def dim_escolaridade(births: DataFrame, education_column: str = "ESCMAE") -> DataFrame:
    """Education codes; ``education_column`` may name the grouped code ESCMAEAGR1 instead."""
    found = births.select(F.col(education_column).alias("id_escmae")).distinct()
    label = decode(F.col("id_escmae"), codes.EDUCATION)
    return as_table(found.withColumn("escolaridade", label), "dim_escolaridade")


def dim_consultas(births: DataFrame) -> DataFrame:
    found = births.select(F.col("CONSULTAS").alias("id_consultas")).distinct()
    label = decode(F.col("id_consultas"), codes.VISITS)
    return as_table(found.withColumn("descricao", label), "dim_consultas")


def dim_gestacao(births: DataFrame) -> DataFrame:
    found = births.select(F.col("GESTACAO").alias("id_gestacao")).distinct()
    label = decode(F.col("id_gestacao"), codes.GESTATION)
    return as_table(found.withColumn("descricao_semanas", label), "dim_gestacao")


def dim_parto_sexo(births: DataFrame) -> DataFrame:
    """Pairs of delivery and sex; the key is the digits of the first, then of the second."""
    found = births.select("SEXO", "PARTO").distinct()
    labelled = found.select(
        joined_code(F.col("PARTO"), F.col("SEXO")).alias("id_parto_sexo"),
        decode(F.col("SEXO"), codes.SEX).alias("sexo"),
        decode(F.col("PARTO"), codes.DELIVERY).alias("parto"),
    )
    return as_table(labelled, "dim_parto_sexo")


# Mother and fact ---------------------------------------------------------------------------


def _mother_columns(education_column: str, compat: bool) -> dict[str, Column]:
    born = F.col("DTNASCMAE")
    return {
        "id_mae": F.col("CONTADOR"),
        "id_escmae": F.col(education_column),
        "id_codocupmae": F.col("CODOCUPMAE"),
        "dtnascmae": stripped_date_text(born) if compat else born,
        "id_gestacao": F.col("GESTACAO"),
        "raca_mae": decode(F.col("RACACORMAE"), codes.RACE),
        "estado_civil": decode(F.col("ESTCIVMAE"), codes.MARITAL_STATUS),
        "qtd_filhovivo": F.col("QTDFILVIVO"),
        "qtd_filhomorto": F.col("QTDFILMORT"),
    }


def _fact_columns(compat: bool) -> dict[str, Column]:
    # Compatible output looks race and place up one field too early.
    race, place = ("CONSULTAS", "RACACOR") if compat else ("RACACOR", "LOCNASC")
    born = F.col("DTNASC")
    return {
        "id_mae": F.col("CONTADOR"),
        "id_calendario": stripped_date_text(born) if compat else born,
        "id_codmunnasc": F.col("CODMUNNASC"),
        "id_parto_sexo": joined_code(F.col("PARTO"), F.col("SEXO")),
        "id_consulta": F.col("CONSULTAS"),
        "raca_nascidos": decode(F.col(race), codes.RACE),
        "local_nascimento": decode(F.col(place), codes.BIRTH_PLACE),
    }


def _named(columns: Mapping[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def records(births: DataFrame, unique: bool = False) -> DataFrame:
    """Each record once, with what identifies it: the year of the birth and a hash of the record."""
    rows = births.select(*BIRTH_COLUMNS)
    return (rows if unique else rows.distinct()).withColumns(
        {
            RECORD_HASH: F.xxhash64(*BIRTH_COLUMNS),
            YEAR: F.year("DTNASC"),
        }
    )


def _rows(births: DataFrame, unique: bool) -> DataFrame:
    return births if unique else births.select(*BIRTH_COLUMNS).distinct()


def _per_record(
    rows: DataFrame, columns: Mapping[str, Column], table: str, compat: bool, identity: bool
) -> DataFrame:
    """A table with a row per record, and the identity of the record if asked."""
    types = {field.name: field.dataType for field in table_schema(table, compat)}
    cast = [column.cast(types[name]).alias(name) for name, column in columns.items()]
    return rows.select(*cast, *([RECORD_HASH, YEAR] if identity else []))


def dim_mae(
    births: DataFrame,
    education_column: str = "ESCMAE",
    compat: bool = False,
    unique: bool = False,
    identity: bool = False,
) -> DataFrame:
    """The mother as described by one birth record; its key is the record's."""
    columns = _mother_columns(education_column, compat)
    return _per_record(_rows(births, unique), columns, "dim_mae", compat, identity)


def fact_births(
    births: DataFrame, compat: bool = False, unique: bool = False, identity: bool = False
) -> DataFrame:
    """One row per birth record.

    ``compat`` gives the output of the system this replaces, flaws included: race of the
    newborn from the visits code, place of birth from the race code, and dates as text that
    has lost trailing zeros.
    """
    return _per_record(
        _rows(births, unique), _fact_columns(compat), "fatos_nascidos", compat, identity
    )


def star_tables(
    births: DataFrame,
    municipalities: DataFrame,
    occupations: DataFrame,
    education_column: str = "ESCMAE",
    compat: bool = False,
    unique: bool = False,
    identity: bool = False,
) -> dict[str, DataFrame]:
    """All eight tables by name; ``identity`` adds to mother and fact which record they are of.

    The four tables of codes are made from their combinations, a few thousand at most, so that the
    births are read once for all of them.
    """
    combinations = births.select(
        F.col(education_column), "CONSULTAS", "GESTACAO", "SEXO", "PARTO"
    ).distinct()
    return {
        "dim_municipio": dim_municipio(births, municipalities),
        "dim_profissao": dim_profissao(births, occupations),
        "dim_escolaridade": dim_escolaridade(combinations, education_column),
        "dim_consultas": dim_consultas(combinations),
        "dim_parto_sexo": dim_parto_sexo(combinations),
        "dim_gestacao": dim_gestacao(combinations),
        "dim_mae": dim_mae(births, education_column, compat, unique, identity),
        "fatos_nascidos": fact_births(births, compat, unique, identity),
    }


# Views for reports -------------------------------------------------------------------------


def birth_profile(
    births: DataFrame,
    education_column: str = "ESCMAE",
    unique: bool = False,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Fact, mother and coded labels of each birth, straight from the births.

    Both tables describe the same record, so nothing is joined. ``only`` names the columns wanted
    besides those of the fact; of stored records no others are read.
    """
    mother = _mother_columns(education_column, compat=False)
    labels = {
        "escolaridade": decode(F.col(education_column), codes.EDUCATION),
        "descricao_semanas": decode(F.col("GESTACAO"), codes.GESTATION),
        "descricao_consultas": decode(F.col("CONSULTAS"), codes.VISITS),
        "sexo": decode(F.col("SEXO"), codes.SEX),
        "parto": decode(F.col("PARTO"), codes.DELIVERY),
    }
    beside_fact = mother | labels
    wanted = list(beside_fact) if only is None else list(only)
    columns = _fact_columns(compat=False) | {name: beside_fact[name] for name in wanted}
    return _rows(births, unique).select(*_named(columns))


def births_wide(
    births: DataFrame,
    municipalities: DataFrame,
    occupations: DataFrame,
    education_column: str = "ESCMAE",
    unique: bool = False,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Each birth with the labels of all dimensions; NULL where a dimension has no row.

    ``only`` names the columns wanted besides those of the fact and of the reference files.
    """
    cities = municipality_labels(municipalities)
    cities = cities.withColumnRenamed("id_codmunicipionasc", "id_codmunnasc")
    jobs = occupation_labels(occupations).withColumnRenamed("id_ocupmae", "id_codocupmae")
    wide = birth_profile(births, education_column, unique, only)
    wide = attach(wide, cities, "id_codmunnasc", births.select(F.col("CODMUNNASC").alias("id_codmunnasc")))
    if "id_codocupmae" not in wide.columns:
        return wide
    return attach(wide, jobs, "id_codocupmae", births.select(F.col("CODOCUPMAE").alias("id_codocupmae")))


def births_wide_from_star(
    tables: Mapping[str, DataFrame], education_column: str = "ESCMAE"
) -> DataFrame:
    """The same view from the stored tables.

    Fact and mother are read from the stored records, which both were made of: the two large
    tables are not joined, and a birth keeps its own mother whatever numbers repeat. The labels
    come from the stored dimensions. Every dimension counts once per key, so the result has the
    rows of the records even if a dimension was appended twice.
    """
    renamed = {
        "dim_municipio": {"id_codmunicipionasc": "id_codmunnasc"},
        "dim_profissao": {"id_ocupmae": "id_codocupmae"},
        "dim_escolaridade": {},
        "dim_gestacao": {},
        "dim_consultas": {"id_consultas": "id_consulta", "descricao": "descricao_consultas"},
        "dim_parto_sexo": {},
    }
    columns = _fact_columns(compat=False) | _mother_columns(education_column, compat=False)
    wide = tables[RECORDS].select(*_named(columns))
    for name, names in renamed.items():
        dimension = tables[name].withColumnsRenamed(names)
        key = dimension.columns[0]
        coded = tables[RECORDS].select(columns[key].alias(key))
        wide = attach(wide, dimension, key, coded)
    return wide
