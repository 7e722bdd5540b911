"""Births counted once by every code that a report shows, for all reports and filters.

One pass over the records of a load counts them by year and the codes that filters choose from, and
by one more code at a time (grouping sets). A load stores its counts next to its rows; as they add
up, the cube of a warehouse is the counts of all loads in force. A report reads one grouping set of
it and never a record, and gives the same result, see ``plans.reports``.

Codes are stored and labels added when a report is read, so a changed label needs no new count. The
largest set has a row per occupation, municipality, year, delivery and marital status that occur
together, which is far below the number of births once there are many per year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bercario.functions import codes
from bercario.functions.codes import decode
from bercario.functions.expressions import completed_years
from bercario.schemas import BATCH, YEAR

# What filters choose from; part of every set.
SHARED = {
    YEAR: YEAR,
    "CODMUNNASC": "id_codmunnasc",
    "PARTO": "parto",
    "ESTCIVMAE": "estado_civil",
}
# The code that each further set counts by, and what a report calls it.
SETS = {
    "base": None,
    "idade": "idade",
    "escolaridade": "escolaridade",
    "ocupacao": "id_codocupmae",
    "local": "local_nascimento",
    "raca_mae": "raca_mae",
    "raca_nascido": "raca_nascidos",
    "consulta": "id_consulta",
    "mes": "id_calendario",
}
_LABELS = {
    "parto": codes.DELIVERY,
    "estado_civil": codes.MARITAL_STATUS,
    "escolaridade": codes.EDUCATION,
    "local_nascimento": codes.BIRTH_PLACE,
    "raca_mae": codes.RACE,
    "raca_nascidos": codes.RACE,
}
COUNT = "nascimentos"
SUMS = {"filhos_vivos": "QTDFILVIVO", "filhos_mortos": "QTDFILMORT"}

_FIELDS = (
    [("conjunto", "STRING"), ("codigo", "BIGINT"), ("mes", "DATE")]
    + [(name, "BIGINT") for name in (*[c for c in SHARED if c != YEAR], COUNT, *SUMS)]
    + [(YEAR, "INT"), (BATCH, "STRING")]
)
CUBE_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in _FIELDS)


def counted(records: DataFrame, education_column: str = "ESCMAE") -> DataFrame:
    """The cube of records, with a row per cell: ``conjunto`` names the set, ``codigo`` its code.

    Counts are added up on the map side, so records are read once and only cells are moved.
    """
    code = {
        "idade": completed_years(F.col("DTNASCMAE"), F.col("DTNASC")),
        "escolaridade": F.col(education_column),
        "ocupacao": F.col("CODOCUPMAE"),
        "local": F.col("LOCNASC"),
        "raca_mae": F.col("RACACORMAE"),
        "raca_nascido": F.col("RACACOR"),
        "consulta": F.col("CONSULTAS"),
        # A month as a number, to have one type for all codes.
        "mes": (F.year("DTNASC") * 12 + F.month("DTNASC") - 1).cast("bigint"),
    }
    named = {name: f"_{name}" for name in code}
    rows = records.select(
        *SHARED, *SUMS.values(), *[column.cast("bigint").alias(named[name]) for name, column in code.items()]
    )
    sets = [[*SHARED, *([named[name]] if name in named else [])] for name in SETS]
    by = [*SHARED, *named.values()]
    cells = rows.groupingSets([[F.col(c) for c in one] for one in sets], *[F.col(c) for c in by]).agg(
        F.grouping_id().alias("_set"),
        F.count(F.lit(1)).alias(COUNT),
        *[F.sum(column).alias(name) for name, column in SUMS.items()],
    )
    # A bit of the set's number is 0 where it counts by that code.
    absent = {name: sum(1 << at for at, other in enumerate(reversed(by)) if other not in one) for name, one in zip(SETS, sets, strict=True)}
    which = F.create_map(*[F.lit(x) for name, number in absent.items() for x in (number, name)])[F.col("_set").cast("int")]
    code_of = F.coalesce(*[F.col(column) for column in named.values()])
    cells = cells.select(which.alias("conjunto"), code_of.alias("codigo"), *SHARED, COUNT, *SUMS)
    first_day = F.make_date(F.floor(F.col("codigo") / 12).cast("int"), (F.col("codigo") % 12 + 1).cast("int"), F.lit(1))
    month = F.when(F.col("conjunto") == "mes", first_day)
    names = [name for name, _ in _FIELDS if name not in (BATCH, YEAR, "mes")]
    return cells.select(*names, month.alias("mes"), F.col(YEAR).cast("int").alias(YEAR))


def cells(cube: DataFrame, name: str = "base") -> DataFrame:
    """One set of a cube as births for a report: labels, codes and ``nascimentos``, how many births."""
    column = SETS[name]
    shared = [
        (decode(F.col(c), _LABELS[label]) if label in _LABELS else F.col(c)).alias(label)
        for c, label in SHARED.items()
    ]
    own = []
    if column == "id_calendario":
        own = [F.col("mes").alias(column)]
    elif column is not None:
        own = [(decode(F.col("codigo"), _LABELS[column]) if column in _LABELS else F.col("codigo")).alias(column)]
    return cube.filter(F.col("conjunto") == name).select(*shared, *own, COUNT, *SUMS)
