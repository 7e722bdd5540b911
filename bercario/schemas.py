"""Column lists and table schemas, declared once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_KEY = "CONTADOR"

# CONTADOR counts the records of one file, so it repeats from year to year. A record is known by
# the year of the birth, its number, and a hash of all its columns.
YEAR, RECORD_HASH = "ano", "registro"
RECORDS = "registros"

# Which series of files a record comes from, and which load wrote a stored row.
SOURCE, BATCH = "fonte", "lote"

# Counts by code, and the dated labels of the reference files.
CUBE = "cubo"
LABEL_TABLES = {"dim_municipio": "rotulos_municipio", "dim_profissao": "rotulos_profissao"}

DATE_COLUMNS = ["DTNASC", "DTNASCMAE"]

# The 17 births columns read from the registry file; a record needs all of them.
BIRTH_COLUMNS = [
    "CONTADOR",
    "CODMUNNASC",
    "LOCNASC",
    "ESTCIVMAE",
    "ESCMAE",
    "CODOCUPMAE",
    "QTDFILVIVO",
    "QTDFILMORT",
    "GESTACAO",
    "PARTO",
    "CONSULTAS",
    "DTNASC",
    "SEXO",
    "RACACOR",
    "DTNASCMAE",
    "RACACORMAE",
    "ESCMAEAGR1",
]

MUNICIPALITY_COLUMNS = ["Codigo_Municipio_Completo", "Nome_Municipio", "Nome_UF"]
OCCUPATION_COLUMNS = ["CODIGO", "TITULO"]

# What one record is in the stored tables that have a row per record.
IDENTITY = {
    RECORDS: [YEAR, RECORD_KEY, RECORD_HASH],
    "dim_mae": [YEAR, "id_mae", RECORD_HASH],
    "fatos_nascidos": [YEAR, "id_mae", RECORD_HASH],
}

STAR = {
    "dim_municipio": "id_codmunicipionasc BIGINT, cidade STRING, estado STRING",
    "dim_profissao": "id_ocupmae BIGINT, ocupacao STRING",
    "dim_escolaridade": "id_escmae BIGINT, escolaridade STRING",
    "dim_consultas": "id_consultas BIGINT, descricao STRING",
    "dim_parto_sexo": "id_parto_sexo BIGINT, sexo STRING, parto STRING",
    "dim_gestacao": "id_gestacao BIGINT, descricao_semanas STRING",
    "dim_mae": (
        "id_mae BIGINT, id_escmae BIGINT, id_codocupmae BIGINT, dtnascmae DATE, id_gestacao BIGINT, "
        "raca_mae STRING, estado_civil STRING, qtd_filhovivo BIGINT, qtd_filhomorto BIGINT"
    ),
    "fatos_nascidos": (
        "id_mae BIGINT, id_calendario DATE, id_codmunnasc BIGINT, id_parto_sexo BIGINT, "
        "id_consulta BIGINT, raca_nascidos STRING, local_nascimento STRING"
    ),
}

# The key is the first column of each table.
STAR_KEYS = {name: ddl.split(" ", 1)[0] for name, ddl in STAR.items()}


def table_schema(table: str, compat: bool = False) -> T.StructType:
    """Schema of a star table; the compatible output keeps its dates as text."""
    ddl = STAR[table]
    return T.StructType.fromDDL(ddl.replace(" DATE", " STRING") if compat else ddl)


def stored_schema(table: str, compat: bool = False) -> T.StructType:
    """Schema of a table as the warehouse stores it; tables with a row per record say which.

    Every row says which load wrote it.
    """
    if table == RECORDS:
        fields = [
            T.StructField(name, T.DateType() if name in DATE_COLUMNS else T.LongType())
            for name in BIRTH_COLUMNS
        ]
    else:
        fields = table_schema(table, compat).fields
    if table in IDENTITY:
        source = [T.StructField(SOURCE, T.StringType())] if table == RECORDS else []
        fields = [*fields, T.StructField(RECORD_HASH, T.LongType()), *source, T.StructField(YEAR, T.IntegerType())]
    return T.StructType([*fields, T.StructField(BATCH, T.StringType())])


def as_table(df: DataFrame, table: str, compat: bool = False) -> DataFrame:
    """``df`` with exactly the columns, order and types of a star table."""
    fields = table_schema(table, compat).fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
