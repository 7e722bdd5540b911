"""Every operator, table and report as a query over the adapter's tables.

A query is a function of a session and a folder with the driver tables, and returns a frame.
Those that store something do so in a new folder of the cluster's shared scratch space. Reports
and views read a stored warehouse, as they would in use; it is built once per application and
state of the folder's files, by the first query that needs it.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bercario.functions.codes import PREGNANCY, decode
from bercario.functions.expressions import whole_number
from bercario.operators.checks import key_summary, orphans
from bercario.operators.cleaning import (
    UnreadableBirths,
    clean_births,
    complete_rows,
    parse_columns,
    plausible_births,
    rejected_births,
)
from bercario.operators.history import attach_as_of, labels_as_of
from bercario.operators.lookups import attach
from bercario.operators.sampling import sample_exact
from bercario.operators.sinks import write_table
from bercario.plans import cube, reports, star
from bercario.plans.ledger import Ledger, Store
from bercario.plans.warehouse import (
    build_warehouse,
    read_cube,
    read_history,
    read_warehouse,
    rejected_path,
    write_assessed,
    write_silver,
)
from bercario.schemas import (
    BIRTH_COLUMNS,
    DATE_COLUMNS,
    RECORD_HASH,
    RECORD_KEY,
    RECORDS,
    SOURCE,
    STAR,
    YEAR,
    stored_schema,
)
from bercario.sources import adapter
from bercario.sources.delimited import (
    FILE,
    prepare_municipalities,
    prepare_occupations,
    read_births,
    read_municipalities,
    read_occupations,
    rejected_lines,
    split_births,
)
from bercario.sources.landing import land_if_absent
from bercario.sources.storage import scratch_path, written_files

Query = Callable[[SparkSession, str], DataFrame]

SAMPLE_SIZE = 1_000
TOP_OCCUPATIONS = 10
FILTERS = {"parto": ["Vaginal", "Cesário"], "estado": ["AF", "AS", None], "estado_civil": ["Casada"]}


# Inputs ------------------------------------------------------------------------------------


def _births(spark: SparkSession, folder: str) -> DataFrame:
    """Clean births by way of silver, as a load has them: the raw ones are read and parsed once."""
    return write_silver(adapter.raw_births(spark, folder), scratch_path(spark, "silver"))


def _assessed(spark: SparkSession, folder: str) -> DataFrame:
    return write_assessed(adapter.raw_births(spark, folder), scratch_path(spark, "silver"))


def _municipalities(spark: SparkSession, folder: str) -> DataFrame:
    raw = adapter.raw_municipalities(spark, folder)
    return prepare_municipalities(raw, adapter.ADAPTER_STATES)


def _occupations(spark: SparkSession, folder: str) -> DataFrame:
    return prepare_occupations(adapter.raw_occupations(spark, folder))


_WAREHOUSES: dict[tuple, str] = {}


def stored_root(spark: SparkSession, folder: str) -> str:
    """The warehouse of the folder's births, built by the first call of an application.

    Files that are written anew make it another folder.
    """
    tables = ("orders", "customer", "nation", "region")
    files = tuple(written_files(spark, f"{folder}/{name}.parquet") for name in tables)
    key = (spark.sparkContext.applicationId, folder, files)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = _stored_warehouse(spark, folder)
    return _WAREHOUSES[key]


def _warehouse(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return read_warehouse(spark, stored_root(spark, folder))


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return _warehouse(spark, folder)[RECORDS]


def _fact(spark: SparkSession, folder: str) -> DataFrame:
    return star.fact_births(_records(spark, folder), unique=True)


def _profile(spark: SparkSession, folder: str) -> DataFrame:
    return star.birth_profile(_records(spark, folder), unique=True)


def _profile_with(*only: str) -> Query:
    """The fact's columns and the named ones."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        return star.birth_profile(_records(spark, folder), unique=True, only=only)

    return query


def _wide_with(*only: str) -> Query:
    """The fact's columns, the named ones, and those of the municipality."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        cities, jobs = _municipalities(spark, folder), _occupations(spark, folder)
        return star.births_wide(_records(spark, folder), cities, jobs, unique=True, only=only)

    return query


def _city_labels(spark: SparkSession, folder: str) -> DataFrame:
    return star.municipality_labels(_municipalities(spark, folder))


def _job_labels(spark: SparkSession, folder: str) -> DataFrame:
    return star.occupation_labels(_occupations(spark, folder))


def _stored_warehouse(spark: SparkSession, folder: str, runs: int = 1, **options) -> str:
    root = scratch_path(spark, "warehouse")
    raw = adapter.raw_births(spark, folder)
    cities, jobs = _municipalities(spark, folder), _occupations(spark, folder)
    for _ in range(runs):
        build_warehouse(raw, cities, jobs, root, **options)
    return root


def _as_delimited(df: DataFrame, encoding: str) -> str:
    """Store a frame as the kind of file the readers expect."""
    path = scratch_path(df.sparkSession, "delimited")
    df.write.options(header=True, sep=";", encoding=encoding, quoteAll=True).csv(path)
    return path


# Cleaning and sampling ---------------------------------------------------------------------


def births_dropna(spark: SparkSession, folder: str) -> DataFrame:
    return complete_rows(adapter.raw_births(spark, folder))


def births_parsed_dates(spark: SparkSession, folder: str) -> DataFrame:
    return _assessed(spark, folder).select(RECORD_KEY, *DATE_COLUMNS)


def births_lenient_dates(spark: SparkSession, folder: str) -> DataFrame:
    raw = complete_rows(adapter.raw_births(spark, folder, malformed_dates=True))
    return parse_columns(raw, DATE_COLUMNS, strict=False).select(RECORD_KEY, *DATE_COLUMNS)


def births_filtered(spark: SparkSession, folder: str) -> DataFrame:
    parsed = _assessed(spark, folder)
    return plausible_births(parsed).select(RECORD_KEY, "DTNASCMAE", "QTDFILVIVO", "QTDFILMORT")


def births_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return rejected_births(adapter.raw_births(spark, folder, malformed_dates=True))


def births_strict_violations(spark: SparkSession, folder: str) -> DataFrame:
    """What a strict run lists before it ends: every bad complete row, implausible ones too."""
    root = scratch_path(spark, "strict")
    try:
        write_silver(adapter.raw_births(spark, folder, malformed_dates=True), root)
    except UnreadableBirths:
        return spark.read.parquet(rejected_path(root)).select(
            F.col(RECORD_KEY).cast("bigint").alias(RECORD_KEY), "motivo"
        )
    raise AssertionError("a strict run accepted unreadable births")


def births_clean_lenient(spark: SparkSession, folder: str) -> DataFrame:
    return clean_births(adapter.raw_births(spark, folder, malformed_dates=True), strict=False)


def births_sample_exact(spark: SparkSession, folder: str) -> DataFrame:
    return sample_exact(_records(spark, folder).select(*BIRTH_COLUMNS), SAMPLE_SIZE, RECORD_KEY)


def sample_tied_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per key of a sample whose rows agree in the key, and in the time but for microseconds."""
    time = F.expr("timestampadd(MICROSECOND, event_id, date_trunc('DAY', ts))")
    tied = spark.read.parquet(f"{folder}/events.parquet").select("event_type", time.alias("ts"))
    sampled = sample_exact(tied, SAMPLE_SIZE, "event_type")
    return sampled.groupBy("event_type").agg(F.count(F.lit(1)).alias("linhas"))


def codes_beyond_double(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of 16 digits, neighbours of which would be one as a binary fraction."""
    text = (F.col("o_orderkey") + F.lit(9007199254740993)).cast("string")
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", text.alias("texto"))
    return orders.select("o_orderkey", whole_number(F.col("texto"), T.StringType()).alias("codigo"))


# Delimited files ---------------------------------------------------------------------------


def births_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Stored with the columns in another order, read by header name, then cleaned."""
    raw = adapter.raw_births(spark, folder).select(*sorted(BIRTH_COLUMNS))
    texts = read_births(spark, _as_delimited(raw, "ISO-8859-1"))
    return write_silver(texts, scratch_path(spark, "silver"))


def _broken_files(births: DataFrame, path: str) -> None:
    """Text files in which some lines have a field too many, others three too few."""
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in BIRTH_COLUMNS]
    line = (
        F.when(F.col(RECORD_KEY) % 50 == 0, F.concat_ws(";", *fields, F.lit("x")))
        .when(F.col(RECORD_KEY) % 51 == 0, F.concat_ws(";", *fields[:-3]))
        .otherwise(F.concat_ws(";", *fields))
    )
    lines = births.select(line.alias(";".join(BIRTH_COLUMNS)))
    lines.write.options(header=True, sep="\u0001", quote="\u0002").csv(path)


def births_csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with a field too many are listed; those with fields too few are incomplete rows."""
    path = scratch_path(spark, "broken")
    _broken_files(adapter.raw_births(spark, folder), path)
    return rejected_lines(spark, path)


def births_csv_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Lines by verdict and by the folder of the file they come from, of one read of the text."""
    path = scratch_path(spark, "lineage")
    raw = adapter.raw_births(spark, folder)
    for name, rest in (("pares", 0), ("impares", 1)):
        _broken_files(raw.filter(F.col(RECORD_KEY) % 2 == rest), f"{path}/{name}")
    found = split_births(spark, [f"{path}/pares", f"{path}/impares"], scratch_path(spark, "split"))
    origin = F.element_at(F.split(FILE, "/"), -2).alias("pasta")
    counts = [
        lines.groupBy(F.lit(verdict).alias("veredito"), origin).agg(
            F.count(F.lit(1)).alias("linhas"), F.sum(F.col(RECORD_KEY).cast("bigint")).alias("soma_contador")
        )
        for verdict, lines in found.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def municipality_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    raw = adapter.raw_municipalities(spark, folder)
    return read_municipalities(spark, _as_delimited(raw, "UTF-8"), adapter.ADAPTER_STATES)


def occupation_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    raw = adapter.raw_occupations(spark, folder)
    return read_occupations(spark, _as_delimited(raw, "ISO-8859-1"))


# Joins, tables and checks ------------------------------------------------------------------


def join_municipality(spark: SparkSession, folder: str) -> DataFrame:
    return star.join_municipalities(_births(spark, folder), _municipalities(spark, folder))


def join_occupation(spark: SparkSession, folder: str) -> DataFrame:
    return star.join_occupations(_births(spark, folder), _occupations(spark, folder))


def dim_municipio(spark: SparkSession, folder: str) -> DataFrame:
    return star.dim_municipio(_births(spark, folder), _municipalities(spark, folder))


def dim_profissao(spark: SparkSession, folder: str) -> DataFrame:
    return star.dim_profissao(_births(spark, folder), _occupations(spark, folder))


def dim_escolaridade_grouped(spark: SparkSession, folder: str) -> DataFrame:
    return star.dim_escolaridade(_births(spark, folder), "ESCMAEAGR1")


def decode_pregnancy(spark: SparkSession, folder: str) -> DataFrame:
    raw = adapter.raw_births(spark, folder, pregnancy=True)
    counted = raw.groupBy("GRAVIDEZ").agg(F.count(F.lit(1)).alias("nascimentos"))
    return counted.withColumn("descricao", decode(F.col("GRAVIDEZ"), PREGNANCY))


def births_wide(spark: SparkSession, folder: str) -> DataFrame:
    cities, jobs = _municipalities(spark, folder), _occupations(spark, folder)
    return star.births_wide(_records(spark, folder), cities, jobs, unique=True)


def births_wide_from_star(spark: SparkSession, folder: str) -> DataFrame:
    return star.births_wide_from_star(_warehouse(spark, folder))


def orphan_municipality(spark: SparkSession, folder: str) -> DataFrame:
    cities = _city_labels(spark, folder)
    return orphans(_fact(spark, folder), "id_codmunnasc", cities, "id_codmunicipionasc")


def orphan_occupation(spark: SparkSession, folder: str) -> DataFrame:
    mothers = star.dim_mae(_records(spark, folder), unique=True)
    return orphans(mothers, "id_codocupmae", _job_labels(spark, folder), "id_ocupmae")


def dimension_key_check(spark: SparkSession, folder: str) -> DataFrame:
    return key_summary(_warehouse(spark, folder))


def births_total_by_view(spark: SparkSession, folder: str) -> DataFrame:
    """The births that each view and report counts, of records that repeat or share a number."""
    root = scratch_path(spark, "views")
    once = adapter.raw_births(spark, folder)
    raw = once.unionByName(adapter.raw_births(spark, folder, years_later=True))
    raw = raw.unionByName(once.filter(F.col(RECORD_KEY) % 5 == 0))
    cities, jobs = _municipalities(spark, folder), _occupations(spark, folder)
    build_warehouse(raw, cities, jobs, root)
    tables = read_warehouse(spark, root)
    profile = star.birth_profile(tables[RECORDS], unique=True)
    counted = {
        "fatos_nascidos": reports.births_total(tables["fatos_nascidos"]),
        "dim_mae": reports.births_total(tables["dim_mae"]),
        "registros": reports.births_total(tables[RECORDS]),
        "direto": reports.births_total(star.birth_profile(clean_births(raw))),
        "larga": reports.births_total(star.births_wide(tables[RECORDS], cities, jobs, unique=True)),
        "larga_do_esquema": reports.births_total(star.births_wide_from_star(tables)),
        "escolaridade": reports.births_by_education(profile),
        "estado_civil": reports.births_by_marital_status(profile),
        "mes": reports.births_by_month(tables["fatos_nascidos"]),
    }
    totals = [
        df.agg(F.lit(name).alias("visao"), F.sum("nascimentos").alias("nascimentos"))
        for name, df in counted.items()
    ]
    return reduce(DataFrame.unionByName, totals)


# Writes ------------------------------------------------------------------------------------


def _fact_written_twice(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    path = scratch_path(spark, mode)
    fact = _fact(spark, folder)
    for _ in range(2):
        write_table(fact, path, mode=mode, key="id_mae")
    return spark.read.parquet(path)


def sink_append_twice(spark: SparkSession, folder: str) -> DataFrame:
    return _fact_written_twice(spark, folder, "append")


def sink_append_new_only(spark: SparkSession, folder: str) -> DataFrame:
    return _fact_written_twice(spark, folder, "append_new_only")


def append_two_years(spark: SparkSession, folder: str) -> DataFrame:
    """Two files that use the same numbers, the second offered twice: births and their mothers."""
    root = scratch_path(spark, "years")
    cities, jobs = _municipalities(spark, folder), _occupations(spark, folder)
    for later in (False, True, True):
        raw = adapter.raw_births(spark, folder, years_later=later)
        build_warehouse(raw, cities, jobs, root, mode="append_new_only")
    tables = read_warehouse(spark, root)
    mothers = tables["dim_mae"].select("id_mae", YEAR, RECORD_HASH, "dtnascmae", "id_escmae")
    births = tables["fatos_nascidos"].join(mothers, ["id_mae", YEAR, RECORD_HASH])
    return births.select(
        "id_mae", F.col(YEAR).cast("bigint").alias(YEAR), "id_calendario", "dtnascmae", "id_escmae"
    )


def append_new_label(spark: SparkSession, folder: str) -> DataFrame:
    """A known occupation code that comes again with another title is another row."""
    root = scratch_path(spark, "labels")
    raw, cities = adapter.raw_births(spark, folder), _municipalities(spark, folder)
    jobs = _occupations(spark, folder)
    title = F.when(F.col("CODIGO") % 4 == 0, F.concat("TITULO", F.lit(" *"))).otherwise(F.col("TITULO"))
    for offered in (jobs, jobs.withColumn("TITULO", title)):
        build_warehouse(raw, cities, offered, root, mode="append_new_only")
    return read_warehouse(spark, root)["dim_profissao"]


def _with_load(spark: SparkSession, root: str) -> DataFrame:
    """The births in force, with the number of the load that wrote each."""
    births = Ledger.read(Store(spark, root)).rows(RECORDS, stored_schema(RECORDS), by_year=True)
    return births.select(
        F.col(RECORD_KEY).alias("id_mae"),
        F.col(YEAR).cast("bigint").alias(YEAR),
        F.col("DTNASC").alias("id_calendario"),
        F.col("DTNASCMAE").alias("dtnascmae"),
        F.col("ESCMAE").alias("id_escmae"),
        F.split("lote", "-")[0].cast("bigint").alias("carga"),
    )


def _corrected_root(spark: SparkSession, folder: str) -> str:
    """Two sources that use the same numbers, then a later file of the first.

    Of that file, the births of 1996 with a number divisible by 7 moved to 2000, with another mother;
    a third of all others are in it again, as they were.
    """
    root = scratch_path(spark, "corrections")
    cities, jobs = _municipalities(spark, folder), _occupations(spark, folder)
    raw, later = adapter.raw_births(spark, folder), adapter.raw_births(spark, folder, years_later=True)
    moved = later.filter((F.col(RECORD_KEY) % 7 == 0) & (F.col("DTNASC") % 10_000 == 2000))
    again = raw.filter((F.col(RECORD_KEY) % 3 == 0) & (F.col(RECORD_KEY) % 7 != 0))
    build_warehouse(raw, cities, jobs, root, source="a")
    build_warehouse(later, cities, jobs, root, mode="correct", source="b")
    build_warehouse(moved.unionByName(again), cities, jobs, root, mode="correct", source="a")
    return root


def append_corrections(spark: SparkSession, folder: str) -> DataFrame:
    """One birth per corrected record; a year without a correction is still of its first load."""
    return _with_load(spark, _corrected_root(spark, folder))


def append_withdrawals(spark: SparkSession, folder: str) -> DataFrame:
    """A later file that is the whole source: births of 1997 and 1998 are no longer in it."""
    root = scratch_path(spark, "withdrawals")
    raw = adapter.raw_births(spark, folder)
    gone = (F.col("DTNASC") % 10_000).isin(1997, 1998) & (F.col(RECORD_KEY) % 3 == 0)
    for births, mode in ((raw, "append"), (raw.filter(~gone), "replace")):
        build_warehouse(
            births, _municipalities(spark, folder), _occupations(spark, folder), root, mode=mode, source="a"
        )
    return _with_load(spark, root)


def cube_after_corrections(spark: SparkSession, folder: str) -> DataFrame:
    """Births per year as counted, after corrections have replaced some years."""
    counts = read_cube(spark, _corrected_root(spark, folder))
    per_year = cube.cells(counts).groupBy(YEAR).agg(F.sum(cube.COUNT).cast("bigint").alias("nascimentos"))
    return per_year.withColumn(YEAR, F.col(YEAR).cast("bigint"))


def warehouse_failed_run(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after a load, after one that breaks while the tables are written, and after its repeat."""
    root = scratch_path(spark, "failed")
    cities, jobs = _municipalities(spark, folder), _occupations(spark, folder)
    broken = jobs.withColumn("TITULO", F.when(F.col("CODIGO") < 0, "").otherwise(F.raise_error(F.lit("no title"))))
    seen = []

    def look(moment: str) -> None:
        tables = read_warehouse(spark, root)
        for name in ("fatos_nascidos", "dim_mae", "dim_profissao"):
            seen.append((moment, name, *tables[name].agg(F.count(F.lit(1)), F.sum(tables[name].columns[0])).first()))
        births = cube.cells(read_cube(spark, root)).agg(F.sum(cube.COUNT)).first()[0]
        seen.append((moment, "cubo", births, None))

    build_warehouse(adapter.raw_births(spark, folder), cities, jobs, root)
    look("antes")
    later = adapter.raw_births(spark, folder, years_later=True)
    try:
        build_warehouse(later, cities, broken, root)
    except Exception as error:  # noqa: BLE001  what a broken run raises is Spark's
        if "no title" not in str(error):
            raise
    else:
        raise AssertionError("the broken load was accepted")
    look("depois da falha")
    build_warehouse(later, cities, jobs, root)
    look("depois da repetição")
    return spark.createDataFrame(seen, "momento string, tabela string, linhas bigint, soma_chaves bigint")


LABELS_FROM = (datetime.date(1990, 1, 1), datetime.date(1998, 7, 1))


def label_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Births per occupation title: of the day of the birth, of two days, and the newest.

    From the middle of 1998 on a quarter of the codes have another title.
    """
    root = scratch_path(spark, "history")
    raw, cities, jobs = adapter.raw_births(spark, folder), _municipalities(spark, folder), _occupations(spark, folder)
    title = F.when(F.col("CODIGO") % 4 == 0, F.concat("TITULO", F.lit(" *"))).otherwise(F.col("TITULO"))
    offered = (jobs, jobs.withColumn("TITULO", title))
    for labels, since in zip(offered, LABELS_FROM, strict=True):
        build_warehouse(raw, cities, labels, root, mode="append_new_only", labels_since=since)
    history = read_history(spark, root)["dim_profissao"].withColumnRenamed("id_ocupmae", "id_codocupmae")
    births = star.birth_profile(read_warehouse(spark, root)[RECORDS], unique=True, only=["id_codocupmae"])
    by_day = births.groupBy("id_codocupmae", "id_calendario").agg(F.count(F.lit(1)).alias("nascimentos"))
    views = {"nascimento": attach_as_of(by_day, history, "id_codocupmae", F.col("id_calendario"))}
    last_day = LABELS_FROM[1] - datetime.timedelta(days=1)
    for name, day in (("antes", last_day), ("depois", LABELS_FROM[1]), ("atual", None)):
        views[name] = attach(by_day, labels_as_of(history, day), "id_codocupmae", unique=True)
    counts = [
        view.groupBy(F.lit(name).alias("visao"), "ocupacao").agg(F.sum("nascimentos").alias("nascimentos"))
        for name, view in views.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def sink_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    return _fact_written_twice(spark, folder, "overwrite")


def warehouse_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The eight stored tables after a repeated run that adds new rows only."""
    return _sizes(read_warehouse(spark, _stored_warehouse(spark, folder, 2, mode="append_new_only")))


def warehouse_named_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The same as tables of a database of the catalog."""
    path = scratch_path(spark, "database")
    name = "d" + path[-32:]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    for _ in range(2):
        build_warehouse(
            adapter.raw_births(spark, folder),
            _municipalities(spark, folder),
            _occupations(spark, folder),
            scratch_path(spark, "warehouse"),
            database=name,
            mode="append_new_only",
        )
    return _sizes(read_warehouse(spark, database=name))


def _stored(table: str) -> Query:
    """A stored table after a repeated run, with the columns of the star schema."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        stored = _warehouse(spark, folder)[table]
        return stored.drop(YEAR, RECORD_HASH, SOURCE)

    return query


def _sizes(stored: dict[str, DataFrame]) -> DataFrame:
    sizes = [
        stored[name].agg(
            F.lit(name).alias("tabela"),
            F.count(F.lit(1)).alias("linhas"),
            F.sum(stored[name].columns[0]).alias("soma_chaves"),
        )
        for name in STAR
    ]
    return reduce(DataFrame.unionByName, sizes)


def warehouse_sampled(spark: SparkSession, folder: str) -> DataFrame:
    """The stored fact of a run that samples."""
    root = _stored_warehouse(spark, folder, sample=SAMPLE_SIZE)
    return read_warehouse(spark, root)["fatos_nascidos"].drop(YEAR, RECORD_HASH)


def silver_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return write_silver(adapter.raw_births(spark, folder), scratch_path(spark, "silver"))


def land_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Two landings on one path, the second with other rows: what each says, and what is stored."""
    path = scratch_path(spark, "landing")
    raw = adapter.raw_births(spark, folder)
    other = raw.withColumn(RECORD_KEY, F.col(RECORD_KEY) + 1)
    said = [land_if_absent(df, path).first()["status"] for df in (raw, other)]
    stored = spark.read.parquet(path)
    return stored.agg(
        F.lit(said[0]).alias("primeira"),
        F.lit(said[1]).alias("segunda"),
        F.count(F.lit(1)).alias("linhas"),
        F.sum(RECORD_KEY).alias("soma_contador"),
    )


# Reports -----------------------------------------------------------------------------------


def _filtered(*only: str) -> Query:
    """The births that the filters choose, with the columns that they and a report need."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        source = _wide_with("parto", "estado_civil", *only)
        return reports.apply_filters(source(spark, folder), FILTERS)

    return query


def _in_states(*states) -> Query:
    """Births per month of some states, by the codes of their municipalities."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        births = reports.in_states(_warehouse(spark, folder)["fatos_nascidos"], _city_labels(spark, folder), states)
        return reports.births_by_month(births)

    return query


def report_filters_reset(spark: SparkSession, folder: str) -> DataFrame:
    return reports.births_total(reports.apply_filters(_fact(spark, folder), {}))


def _report(source: Query, report: Callable[..., DataFrame], *lookups: Query, **options) -> Query:
    """A report on a source, with the lookups it needs."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        return report(source(spark, folder), *[q(spark, folder) for q in lookups], **options)

    return query


_REGIONS = {"regions": adapter.ADAPTER_REGIONS}


def _cells(name: str = "base", filtered: bool = False) -> Query:
    """A set of the stored cube, with the states that filters choose from if they are to be applied."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        found = cube.cells(read_cube(spark, stored_root(spark, folder)), name)
        if not filtered:
            return found
        cities = _city_labels(spark, folder).withColumnRenamed("id_codmunicipionasc", "id_codmunnasc")
        return reports.apply_filters(attach(found, cities, "id_codmunnasc"), FILTERS)

    return query


def cube_filters_reset(spark: SparkSession, folder: str) -> DataFrame:
    return reports.births_total(reports.apply_filters(_cells()(spark, folder), {}))


QUERIES: dict[str, Query] = {
    "births_dropna": births_dropna,
    "births_parsed_dates": births_parsed_dates,
    "births_lenient_dates": births_lenient_dates,
    "births_filtered": births_filtered,
    "births_clean": _births,
    "births_clean_lenient": births_clean_lenient,
    "births_rejects": births_rejects,
    "births_strict_violations": births_strict_violations,
    "births_sample_exact": births_sample_exact,
    "sample_tied_timestamps": sample_tied_timestamps,
    "codes_beyond_double": codes_beyond_double,
    "births_csv_scan": births_csv_scan,
    "births_csv_rejects": births_csv_rejects,
    "births_csv_lineage": births_csv_lineage,
    "municipality_csv_scan": municipality_csv_scan,
    "occupation_csv_scan": occupation_csv_scan,
    "municipality_prepared": _municipalities,
    "occupation_prepared": _occupations,
    "join_municipality": join_municipality,
    "join_occupation": join_occupation,
    "dim_municipio": dim_municipio,
    "dim_profissao": dim_profissao,
    "dim_escolaridade": _report(_births, star.dim_escolaridade),
    "dim_escolaridade_grouped": dim_escolaridade_grouped,
    "dim_consultas": _report(_births, star.dim_consultas),
    "dim_gestacao": _report(_births, star.dim_gestacao),
    "dim_parto_sexo": _report(_births, star.dim_parto_sexo),
    "dim_mae": _report(_records, star.dim_mae, unique=True),
    "dim_mae_compat": _report(_records, star.dim_mae, compat=True, unique=True),
    "fact_births": _fact,
    "fact_births_compat": _report(_records, star.fact_births, compat=True, unique=True),
    "decode_pregnancy": decode_pregnancy,
    "birth_profile": _profile,
    "births_wide": births_wide,
    "births_wide_from_star": births_wide_from_star,
    "orphan_municipality": orphan_municipality,
    "orphan_occupation": orphan_occupation,
    "dimension_key_check": dimension_key_check,
    "births_total_by_view": births_total_by_view,
    "sink_append_twice": sink_append_twice,
    "sink_append_new_only": sink_append_new_only,
    "sink_overwrite": sink_overwrite,
    "append_two_years": append_two_years,
    "append_new_label": append_new_label,
    "warehouse_tables": warehouse_tables,
    "warehouse_named_tables": warehouse_named_tables,
    **{f"stored_{name}": _stored(name) for name in STAR},
    "stored_registros": _stored(RECORDS),
    "warehouse_sampled": warehouse_sampled,
    "silver_roundtrip": silver_roundtrip,
    "land_if_absent": land_twice,
    "report_births_total": _report(_fact, reports.births_total),
    "report_age_band": _report(_profile_with("dtnascmae"), reports.births_by_age_band),
    "report_mean_age": _report(_profile_with("dtnascmae"), reports.mean_mother_age),
    "report_education": _report(_profile_with("escolaridade"), reports.births_by_education),
    "report_age_children": _report(
        _profile_with("dtnascmae", "qtd_filhovivo", "qtd_filhomorto"), reports.children_by_age
    ),
    "report_occupation": _report(_profile_with("id_codocupmae"), reports.births_by_occupation, _job_labels),
    "report_occupation_top": _report(
        _profile_with("id_codocupmae"), reports.births_by_occupation, _job_labels, top=TOP_OCCUPATIONS
    ),
    "report_employment": _report(
        _profile_with("id_codocupmae"), reports.births_by_employment, adapter.not_employed_codes
    ),
    "report_region": _report(_fact, reports.births_by_region, _city_labels, **_REGIONS),
    "report_place_by_region": _report(_fact, reports.birth_place_by_region, _city_labels, **_REGIONS),
    "report_delivery_by_race": _report(_profile_with("raca_mae", "parto"), reports.deliveries_by_race),
    "report_delivery_by_race_table": _report(
        _profile_with("raca_mae", "parto"), reports.deliveries_by_race_table
    ),
    "report_delivery_totals": _report(_profile_with("parto"), reports.delivery_totals),
    "report_consultations": _report(_fact, reports.births_by_visits),
    "report_marital_status": _report(_profile_with("estado_civil"), reports.births_by_marital_status),
    "report_newborn_race": _report(_fact, reports.births_by_newborn_race),
    "report_month_vs_average": _report(_fact, reports.births_by_month),
    "report_state_pareto": _report(_fact, reports.births_by_state_pareto, _city_labels),
    "report_municipality_pareto": _report(_fact, reports.births_by_code_pareto, code="id_codmunnasc"),
    "report_occupation_pareto": _report(
        _profile_with("id_codocupmae"), reports.births_by_code_pareto, code="id_codocupmae"
    ),
    "report_states_by_month": _in_states("AF", "AS"),
    "report_unknown_states_by_month": _in_states("EU", None),
    "report_filtered": _report(_filtered(), reports.births_by_newborn_race),
    "report_filtered_profile": _report(_filtered("dtnascmae"), reports.births_by_age_band),
    "report_filtered_occupations": _report(
        _filtered("id_codocupmae"), reports.births_by_occupation, _job_labels
    ),
    "report_filtered_health": _report(_filtered("raca_mae"), reports.deliveries_by_race),
    "report_filtered_geography": _report(_filtered(), reports.births_by_month),
    "report_filtered_places": _report(
        _filtered(), reports.birth_place_by_region, _city_labels, **_REGIONS
    ),
    "report_filters_reset": report_filters_reset,
    "append_corrections": append_corrections,
    "append_withdrawals": append_withdrawals,
    "warehouse_failed_run": warehouse_failed_run,
    "label_as_of": label_as_of,
    "cube_after_corrections": cube_after_corrections,
    # The reports again, from the stored counts alone.
    "cube_births_total": _report(_cells(), reports.births_total),
    "cube_age_band": _report(_cells("idade"), reports.births_by_age_band),
    "cube_mean_age": _report(_cells("idade"), reports.mean_mother_age),
    "cube_education": _report(_cells("escolaridade"), reports.births_by_education),
    "cube_age_children": _report(_cells("idade"), reports.children_by_age),
    "cube_occupation": _report(_cells("ocupacao"), reports.births_by_occupation, _job_labels),
    "cube_occupation_top": _report(
        _cells("ocupacao"), reports.births_by_occupation, _job_labels, top=TOP_OCCUPATIONS
    ),
    "cube_employment": _report(_cells("ocupacao"), reports.births_by_employment, adapter.not_employed_codes),
    "cube_region": _report(_cells(), reports.births_by_region, _city_labels, **_REGIONS),
    "cube_place_by_region": _report(_cells("local"), reports.birth_place_by_region, _city_labels, **_REGIONS),
    "cube_delivery_by_race": _report(_cells("raca_mae"), reports.deliveries_by_race),
    "cube_delivery_by_race_table": _report(_cells("raca_mae"), reports.deliveries_by_race_table),
    "cube_delivery_totals": _report(_cells(), reports.delivery_totals),
    "cube_consultations": _report(_cells("consulta"), reports.births_by_visits),
    "cube_marital_status": _report(_cells(), reports.births_by_marital_status),
    "cube_newborn_race": _report(_cells("raca_nascido"), reports.births_by_newborn_race),
    "cube_month_vs_average": _report(_cells("mes"), reports.births_by_month),
    "cube_state_pareto": _report(_cells(), reports.births_by_state_pareto, _city_labels),
    "cube_municipality_pareto": _report(_cells(), reports.births_by_code_pareto, code="id_codmunnasc"),
    "cube_occupation_pareto": _report(_cells("ocupacao"), reports.births_by_code_pareto, code="id_codocupmae"),
    "cube_filtered": _report(_cells("raca_nascido", True), reports.births_by_newborn_race),
    "cube_filtered_profile": _report(_cells("idade", True), reports.births_by_age_band),
    "cube_filtered_occupations": _report(_cells("ocupacao", True), reports.births_by_occupation, _job_labels),
    "cube_filtered_health": _report(_cells("raca_mae", True), reports.deliveries_by_race),
    "cube_filtered_geography": _report(_cells("mes", True), reports.births_by_month),
    "cube_filtered_places": _report(
        _cells("local", True), reports.birth_place_by_region, _city_labels, **_REGIONS
    ),
    "cube_filters_reset": cube_filters_reset,
}
