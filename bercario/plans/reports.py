"""The reports on births.

Each takes ``births`` with the columns it names: the fact table where that is enough, otherwise
``birth_profile`` or either wide view; or ``cube.cells``, whose rows stand for as many births as
``nascimentos`` says. A label that is not in those (city, state, occupation) is
joined after counting per code, when the largest code is one row: no report moves single births,
so a code that a third of them share costs no more than any other. Windows without partition
only see such counts, one row per month, state or label.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bercario.functions.codes import DELIVERY, REGIONS, UNKNOWN, VISITS, decode, label_or_unknown
from bercario.functions.expressions import age_band, completed_years
from bercario.operators.lookups import one_row_per_key
from bercario.operators.running import OVERALL, UP_TO, running_totals

_COUNT = "nascimentos"


def mother_age(births: DataFrame | None = None) -> Column:
    """Completed years of the mother at the birth."""
    if births is not None and "idade" in births.columns:
        return F.col("idade")
    return completed_years(F.col("dtnascmae"), F.col("id_calendario"))


def _are_counts(births: DataFrame) -> bool:
    return _COUNT in births.columns


def _number(births: DataFrame) -> Column:
    if _are_counts(births):
        return F.coalesce(F.sum(_COUNT), F.lit(0)).cast("bigint")
    return F.count(F.lit(1))


def _births(births: DataFrame) -> Column:
    return _number(births).alias(_COUNT)


def _per_label(births: DataFrame, label: str) -> DataFrame:
    counted = births.groupBy(label).agg(_births(births))
    return counted.withColumn(label, label_or_unknown(F.col(label)))


def _per_lookup(
    births: DataFrame, code: str, lookup: DataFrame, lookup_key: str, *also: str
) -> DataFrame:
    """Births per code, and per ``also``, with the lookup's columns."""
    counted = births.groupBy(code, *also).agg(_births(births))
    labels = one_row_per_key(lookup, lookup_key).withColumnRenamed(lookup_key, code)
    return counted.join(labels, code, "left")


def _total(counted: DataFrame, *by: str) -> DataFrame:
    return counted.groupBy(*by).agg(F.sum(_COUNT).alias(_COUNT))


def _share() -> Column:
    return F.col(_COUNT) / F.sum(_COUNT).over(Window.partitionBy())


def apply_filters(df: DataFrame, filters: Mapping[str, Sequence]) -> DataFrame:
    """Rows that have one of the chosen values in every filtered column.

    None chooses missing values. Without filters, all rows: the reset button.
    """
    for column, values in filters.items():
        present = [value for value in values if value is not None]
        chosen = F.col(column).isin(present)
        if len(present) < len(values):
            chosen = chosen | F.col(column).isNull()
        df = df.filter(chosen)
    return df


def in_states(births: DataFrame, municipalities: DataFrame, states: Sequence, code: str = "id_codmunnasc") -> DataFrame:
    """The births of some states, as a filter on the municipality's code.

    ``apply_filters`` on a joined label reads all births first. Here the codes are looked up before,
    in ``municipalities`` (the shape of ``dim_municipio``), and the scan skips what it need not read
    of tables that are kept together by place. None chooses births of no known state. The codes come
    to the driver, as many as there are municipalities.
    """
    labels = one_row_per_key(municipalities, "id_codmunicipionasc").select("id_codmunicipionasc", "estado")
    chosen = apply_filters(labels, {"estado": states})
    if None not in states:
        return births.filter(F.col(code).isin([row[0] for row in chosen.collect()]))
    others = labels.join(chosen, "id_codmunicipionasc", "left_anti").select("id_codmunicipionasc")
    return births.filter(~F.col(code).isin([row[0] for row in others.collect()]) | F.col(code).isNull())


# Mothers and births ------------------------------------------------------------------------


def births_total(births: DataFrame) -> DataFrame:
    return births.agg(_births(births))


def births_by_age_band(births: DataFrame, youngest: int = 15, oldest: int = 45, width: int = 5) -> DataFrame:
    band = age_band(mother_age(births), youngest, oldest, width)
    return births.groupBy(band.alias("faixa_etaria")).agg(_births(births))


def births_by_education(births: DataFrame) -> DataFrame:
    return _per_label(births, "escolaridade")


def mean_mother_age(births: DataFrame) -> DataFrame:
    age = mother_age(births)
    mean = F.sum(age * F.col(_COUNT)) / F.sum(_COUNT) if _are_counts(births) else F.avg(age)
    return births.agg(mean.alias("idade_media"))


def children_by_age(births: DataFrame) -> DataFrame:
    """Living and dead children of mothers of each age: sums and means."""
    by_age = births.groupBy(mother_age(births).alias("idade"))
    if _are_counts(births):
        sums = [F.sum(name).cast("bigint").alias(name) for name in ("filhos_vivos", "filhos_mortos")]
        means = [
            (F.sum(name) / F.sum(_COUNT)).alias(f"media_{name}") for name in ("filhos_vivos", "filhos_mortos")
        ]
        return by_age.agg(_births(births), *sums, *means)
    return by_age.agg(
        _births(births),
        F.sum("qtd_filhovivo").alias("filhos_vivos"),
        F.sum("qtd_filhomorto").alias("filhos_mortos"),
        F.avg("qtd_filhovivo").alias("media_filhos_vivos"),
        F.avg("qtd_filhomorto").alias("media_filhos_mortos"),
    )


# Occupations and regions -------------------------------------------------------------------


def births_by_occupation(births: DataFrame, occupations: DataFrame, top: int | None = None) -> DataFrame:
    """Births per occupation title; ``occupations`` has the shape of ``dim_profissao``."""
    counted = _per_lookup(births, "id_codocupmae", occupations, "id_ocupmae")
    titled = _total(counted.withColumn("ocupacao", label_or_unknown(F.col("ocupacao"))), "ocupacao")
    return titled if top is None else titled.orderBy(F.desc(_COUNT), "ocupacao").limit(top)


def births_by_employment(births: DataFrame, not_employed: DataFrame | Sequence[int]) -> DataFrame:
    """Births by whether the mother's occupation code is one of an employed person.

    Nothing in the data says which codes are not, so they have to be given: a list, or the
    first column of a dataframe.
    """
    if not isinstance(not_employed, DataFrame):
        not_employed = births.sparkSession.createDataFrame([(c,) for c in not_employed], "code BIGINT")
    listed = not_employed.select(F.col(not_employed.columns[0]).alias("id_codocupmae")).distinct()
    counted = births.groupBy("id_codocupmae").agg(_births(births))
    flagged = counted.join(listed.withColumn("listed", F.lit(True)), "id_codocupmae", "left")
    return _total(flagged.select(F.col("listed").isNull().alias("empregada"), _COUNT), "empregada")


def _with_region(counted: DataFrame, regions: Mapping[str, str]) -> DataFrame:
    return counted.withColumn("regiao", label_or_unknown(decode(F.col("estado"), regions)))


def births_by_region(
    births: DataFrame, municipalities: DataFrame, regions: Mapping[str, str] = REGIONS
) -> DataFrame:
    """Births per region; ``municipalities`` has the shape of ``dim_municipio``."""
    counted = _per_lookup(births, "id_codmunnasc", municipalities, "id_codmunicipionasc")
    return _total(_with_region(counted, regions), "regiao")


def birth_place_by_region(
    births: DataFrame, municipalities: DataFrame, regions: Mapping[str, str] = REGIONS
) -> DataFrame:
    place = "local_nascimento"
    counted = _per_lookup(births, "id_codmunnasc", municipalities, "id_codmunicipionasc", place)
    labelled = counted.withColumn(place, label_or_unknown(F.col(place)))
    return _total(_with_region(labelled, regions), "regiao", place)


# Delivery, visits, marital status ----------------------------------------------------------


def deliveries_by_race(births: DataFrame) -> DataFrame:
    """Births per race of the mother and type of delivery."""
    counted = births.groupBy("raca_mae", "parto").agg(_births(births))
    return counted.withColumns({c: label_or_unknown(F.col(c)) for c in ("raca_mae", "parto")})


def deliveries_by_race_table(births: DataFrame) -> DataFrame:
    """The same with one column for each type of delivery."""
    types = [*DELIVERY.values(), UNKNOWN]
    table = deliveries_by_race(births).groupBy("raca_mae").pivot("parto", types).sum(_COUNT)
    return table.select("raca_mae", *[F.coalesce(F.col(t), F.lit(0)).alias(t.lower()) for t in types])


def delivery_totals(births: DataFrame) -> DataFrame:
    def of(code: int) -> Column:
        chosen = F.col("parto") == DELIVERY[code]
        if _are_counts(births):
            return F.coalesce(F.sum(F.when(chosen, F.col(_COUNT))), F.lit(0)).cast("bigint")
        return F.count_if(chosen)

    return births.agg(
        _number(births).alias("partos"), of(1).alias("vaginais"), of(2).alias("cesarios")
    )


def births_by_visits(births: DataFrame) -> DataFrame:
    """Births per number of prenatal visits. The fact's code is enough."""
    counted = births.groupBy("id_consulta").agg(_births(births))
    label = label_or_unknown(decode(F.col("id_consulta"), VISITS))
    return _total(counted.withColumn("descricao", label), "descricao")


def births_by_marital_status(births: DataFrame) -> DataFrame:
    counted = _per_label(births, "estado_civil")
    return counted.withColumn("participacao", _share())


def births_by_newborn_race(births: DataFrame) -> DataFrame:
    return _per_label(births, "raca_nascidos")


# Months and states -------------------------------------------------------------------------


def births_by_month(births: DataFrame) -> DataFrame:
    """Births per month, and whether they are above, below or at the monthly mean."""
    month = F.trunc("id_calendario", "MM").alias("mes")
    counted = births.groupBy(month).agg(_births(births))
    counted = counted.withColumn("media", F.avg(_COUNT).over(Window.partitionBy()))
    position = (
        F.when(F.col(_COUNT) > F.col("media"), "acima")
        .when(F.col(_COUNT) < F.col("media"), "abaixo")
        .otherwise("igual")
    )
    return counted.withColumn("situacao", position)


def births_by_state_pareto(births: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Births per state from most to fewest, with the share of each and of all up to it."""
    counted = _per_lookup(births, "id_codmunnasc", municipalities, "id_codmunicipionasc")
    states = _total(counted.withColumn("estado", label_or_unknown(F.col("estado"))), "estado")
    descending = Window.orderBy(F.desc(_COUNT), "estado").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    so_far = F.sum(_COUNT).over(descending)
    return states.withColumns(
        {
            "participacao": _share(),
            "acumulado": so_far / F.sum(_COUNT).over(Window.partitionBy()),
        }
    )


def births_by_code_pareto(births: DataFrame, code: str) -> DataFrame:
    """Births per code from most to fewest, with the share of each and of all up to it.

    For codes without bound, such as occupations: no task sees the counts of all codes.
    """
    counted = births.groupBy(code).agg(_births(births))
    totals = running_totals(counted, _COUNT, [F.desc(_COUNT), F.asc_nulls_last(code)])
    return totals.select(
        code,
        _COUNT,
        (F.col(_COUNT) / F.col(OVERALL)).alias("participacao"),
        (F.col(UP_TO) / F.col(OVERALL)).alias("acumulado"),
    )
