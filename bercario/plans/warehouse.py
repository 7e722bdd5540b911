"""From the three inputs to the stored star schema.

What is stored: the assessed input of the last run (silver), the records of all runs, each once
(``registros``), the eight star tables, which can be made again from the records, the counts that
reports read (``cubo``), and the dated labels of the reference files. Records, mothers and facts carry
the identity of their record and are partitioned by the year of the birth, all tables by the load
that wrote them. The ledger says which loads count, see ``plans.ledger``.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bercario.operators.checks import records_unique
from bercario.operators.cleaning import (
    ACCEPTED,
    REASON,
    UnreadableBirths,
    assessed_births,
    unreadable,
    unreadable_rows,
)
from bercario.operators.history import SINCE, dated, history_of, new_labels
from bercario.operators.sampling import sample_exact
from bercario.operators.sinks import records_not_in, rows_not_in, write_table
from bercario.plans.cube import CUBE_SCHEMA, counted
from bercario.plans.ledger import Ledger, Load, Store
from bercario.plans.star import municipality_labels, occupation_labels, records, star_tables
from bercario.schemas import (
    BATCH,
    BIRTH_COLUMNS,
    CUBE,
    IDENTITY,
    LABEL_TABLES,
    RECORD_HASH,
    RECORD_KEY,
    RECORDS,
    SOURCE,
    STAR,
    STAR_KEYS,
    YEAR,
    stored_schema,
    table_schema,
)
from bercario.sources.storage import path_exists, scratch_path

# Tables written at a time; each write is its own job and most are small.
WRITERS = 8

# Files per year and load of the records of a catalog table, by hash of the record.
BUCKETS = 16

MODES = ("append", "append_new_only", "overwrite", "correct", "replace")

# Tables whose rows are kept together by place, then by date, within a year.
CLUSTERED = {RECORDS: ["CODMUNNASC", "DTNASC"], "fatos_nascidos": ["id_codmunnasc", "id_calendario"]}


def silver_path(root: str) -> str:
    return f"{root}/silver/births"


def rejected_path(root: str) -> str:
    return f"{root}/silver/births_rejected"


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    """The accepted births of the last run."""
    return _accepted(spark.read.parquet(silver_path(root)))


def _accepted(assessed: DataFrame) -> DataFrame:
    return assessed.filter(F.col(ACCEPTED)).select(*BIRTH_COLUMNS)


def write_silver(raw: DataFrame, root: str, strict: bool = True) -> DataFrame:
    """Store the assessed births and return the accepted ones as stored, see ``write_assessed``."""
    return _accepted(write_assessed(raw, root, strict))


def write_assessed(raw: DataFrame, root: str, strict: bool = True) -> DataFrame:
    """Store all complete births, parsed and with a verdict, and return them as stored.

    The text files are parsed once, with a verdict on every complete row, and counted by the write
    itself. If there are rows that hold a value that cannot be read, they are then listed under ``births_rejected``, implausible ones
    included, and a strict run ends here, before any table is written. Later steps read only
    the columns they need, and a lost executor repeats a Parquet read, not the parsing. A
    previous run's births are replaced; their records stay in the warehouse.
    """
    spark = raw.sparkSession
    assessed = assessed_births(raw)
    seen = Observation("silver")
    observed = assessed.observe(seen, F.count_if(unreadable(assessed)).alias("bad"))
    observed.write.mode("overwrite").parquet(silver_path(root))
    stored = spark.read.schema(assessed.schema).parquet(silver_path(root))
    many = seen.get["bad"]
    # Without any, only the list of an earlier run has to be emptied.
    if many or path_exists(spark, rejected_path(root)):
        unreadable_rows(stored).write.mode("overwrite").parquet(rejected_path(root))
    if many and strict:
        first = spark.read.parquet(rejected_path(root)).first()
        values = "; ".join(f"unreadable {name}: {first[name]}" for name in first[REASON].split(","))
        raise UnreadableBirths(f"{many} rows, listed in {rejected_path(root)}: {values}")
    return stored


def write_records(
    births: DataFrame, root: str, sample: int | None = None, seed: int = 42, source: str = ""
) -> DataFrame:
    """The records of a run, each once, as stored; a sample of them if asked.

    If no number repeats (checked by shuffling it alone) no record does, and none are compared. The
    records are dealt by range of year, place and date, so that the files of all tables hold few
    places each. As the record's hash is part of the range, no place or day is too large for a task.
    """
    spark = births.sparkSession
    found = records(births, records_unique(births)).withColumn(SOURCE, F.lit(source))
    found = found.repartitionByRange(YEAR, *CLUSTERED[RECORDS], RECORD_HASH)
    path = f"{root}/silver/{RECORDS}"
    found.write.mode("overwrite").parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    if sample is None:
        return found
    path = f"{root}/silver/{RECORDS}_sample"
    sample_exact(found, sample, RECORD_KEY, seed).write.mode("overwrite").parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def corrected(
    stored: DataFrame, batch: DataFrame, source: str, whole: bool, root: str | None = None
) -> tuple[list[int], DataFrame, DataFrame]:
    """What a new file of a source changes in the records: the years, the records of those years
    afterwards, and the new ones among them.

    A record of the batch replaces all stored ones of its source and number, in whatever year they
    are. If the file is the ``whole`` source, stored records that it lacks are withdrawn. Records that
    agree in every column are no change, and a year without a change is not touched. Of several
    different records with one number in the batch, all are kept.

    What goes and what is new is found once and stored under ``root``, or else in a new folder, as all tables
    are made from it. The stored records are compared with what goes only if something does.
    """
    path = f"{root or scratch_path(batch.sparkSession, 'corrections')}/silver/{RECORDS}"
    identity = [*IDENTITY[RECORDS], SOURCE]
    batch = batch.withColumn(SOURCE, F.lit(source))
    own = stored.filter(F.col(SOURCE) == source).select(*identity)
    offered = batch.select(*identity)
    if not whole:
        numbers = offered.select(F.col(RECORD_KEY).alias("_number")).distinct()
        own = own.join(numbers, F.col(RECORD_KEY) == F.col("_number"), "left_semi")
    gone = _restored(rows_not_in(own, offered), f"{path}_gone")
    new = rows_not_in(batch, stored.filter(F.col(SOURCE) == source), identity)
    new = _restored(new, f"{path}_new")
    # One row per year of birth.
    changed = gone.select(YEAR).unionByName(new.select(YEAR)).distinct()
    years = sorted(row[0] for row in changed.collect())
    kept = stored.filter(F.col(YEAR).isin(years))
    if not gone.isEmpty():
        kept = _restored(rows_not_in(kept, gone, identity), f"{path}_kept")
    return years, kept.unionByName(new.select(*kept.columns)), new


def unseen(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """The records of a batch that differ from every stored one of their year and number."""
    return records_not_in(batch, stored, RECORD_HASH, [YEAR, RECORD_KEY])


def _restored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_warehouse(
    raw_births: DataFrame,
    municipalities: DataFrame,
    occupations: DataFrame,
    root: str,
    *,
    database: str | None = None,
    mode: str = "append",
    sample: int | None = None,
    seed: int = 42,
    strict: bool = True,
    education_column: str = "ESCMAE",
    compat: bool = False,
    source: str = "",
    labels_since: datetime.date | None = None,
) -> None:
    """Clean the births, optionally sample them, and write the records and the eight star tables.

    The tables go to folders under ``root``, or to the named ``database`` of the catalog; silver is
    always under ``root``. In a catalog the records are bucketed by their hash, so that a later load is
    compared with them without moving them. Readers see nothing of a run before all of it is written, see ``ledger``:
    a failed run can be repeated in any mode.

    ``mode``: ``append`` adds every record, so a repeated run stores everything twice;
    ``append_new_only`` those that differ from every stored one of their year and number in any
    column. ``overwrite`` replaces all earlier loads. ``correct`` and ``replace`` take the births as a
    later file of ``source``, a name for all files that number the same births: each of them replaces
    the stored record of its number, see ``corrected``, and only the years with a change are written
    again. Dimension rows that differ from every stored one are added, or all of them by ``append``:
    nothing is dropped for sharing a key.

    ``labels_since`` is the day from which the labels of the reference files hold, see
    ``read_history``; without it no history is kept.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    spark = raw_births.sparkSession
    store = Store(spark, root, database)
    ledger = Ledger.read(store)
    name_of_load = ledger.next_batch()
    batch = write_records(write_silver(raw_births, root, strict), root, sample, seed, source)
    only_new = mode not in ("append", "overwrite")
    stored = _tables(ledger, compat) if only_new else {}
    years: list[int] = []
    found, described = batch, batch
    if mode == "append_new_only":
        # One row per year of birth.
        own = [row[0] for row in batch.select(YEAR).distinct().collect()]
        found = unseen(batch, stored[RECORDS].filter(F.col(YEAR).isin(own)))
        found = _restored(found, f"{root}/silver/{RECORDS}_new")
    elif only_new:
        years, found, described = corrected(stored[RECORDS], batch, source, mode == "replace", root)

    def tables_of(rows: DataFrame) -> dict[str, DataFrame]:
        return star_tables(
            rows, municipalities, occupations, education_column, compat, unique=True, identity=True
        )

    tables = tables_of(described)
    tables |= {name: table for name, table in tables_of(found).items() if name in IDENTITY}
    tables[RECORDS] = found
    if only_new:
        small = [name for name in STAR if name not in IDENTITY]
        tables |= {name: rows_not_in(tables[name], stored[name]) for name in small}
    tables[CUBE] = counted(found, education_column)
    if labels_since is not None:
        tables |= _offered_labels(ledger, municipalities, occupations, labels_since)

    def write(name: str) -> None:
        by_year = [YEAR] if _by_year(name) else []
        rows = tables[name].withColumn(BATCH, F.lit(name_of_load))
        write_table(
            rows,
            **store.target(name),
            partition_by=[*by_year, BATCH],
            sort_by=CLUSTERED.get(name, []),
            buckets=(BUCKETS, RECORD_HASH) if name == RECORDS else None,
        )

    with ThreadPoolExecutor(WRITERS) as pool:
        for written in [pool.submit(write, name) for name in tables]:
            written.result()
    ledger.commit(Load(name_of_load, mode, source, mode == "overwrite", tuple(years), found.count()))


def _by_year(table: str) -> bool:
    return table in IDENTITY or table == CUBE


def _tables(ledger: Ledger, compat: bool) -> dict[str, DataFrame]:
    return {
        name: ledger.rows(name, stored_schema(name, compat), _by_year(name)).drop(BATCH)
        for name in [*STAR, RECORDS]
    }


def read_warehouse(
    spark: SparkSession, root: str | None = None, compat: bool = False, database: str | None = None
) -> dict[str, DataFrame]:
    """The stored tables by name, from folders or from the catalog: the rows of finished loads.

    Which loads those are is asked once, here, so all tables are of the same state.
    """
    return _tables(Ledger.read(Store(spark, root, database)), compat)


def read_cube(spark: SparkSession, root: str | None = None, database: str | None = None) -> DataFrame:
    """The counts of all finished loads; several rows of a cell add up."""
    ledger = Ledger.read(Store(spark, root, database))
    return ledger.rows(CUBE, CUBE_SCHEMA, by_year=True).drop(BATCH)


def _label_schema(dimension: str) -> str:
    return f"{table_schema(dimension).simpleString()[7:-1].replace(':', ' ')}, {SINCE} date, {BATCH} string"


def _history(ledger: Ledger, dimension: str) -> DataFrame:
    said = ledger.rows(LABEL_TABLES[dimension], _label_schema(dimension), by_year=False)
    return history_of(said.drop(BATCH), STAR_KEYS[dimension])


def _offered_labels(
    ledger: Ledger, municipalities: DataFrame, occupations: DataFrame, since: datetime.date
) -> dict[str, DataFrame]:
    """What the reference files say from a day on, where it is not known yet."""
    offered = {
        "dim_municipio": municipality_labels(municipalities),
        "dim_profissao": occupation_labels(occupations),
    }
    found = {}
    for dimension, labels in offered.items():
        key = STAR_KEYS[dimension]
        found[LABEL_TABLES[dimension]] = new_labels(dated(labels, key, since), _history(ledger, dimension), key)
    return found


def read_history(
    spark: SparkSession, root: str | None = None, database: str | None = None
) -> Mapping[str, DataFrame]:
    """The labels over time of municipalities and occupations, by dimension; see ``history_of``.

    Of the loads that named a day: ``history.attach_as_of`` gives the labels of the day of a birth,
    ``history.labels_as_of`` those of one day or the newest.
    """
    ledger = Ledger.read(Store(spark, root, database))
    return {dimension: _history(ledger, dimension) for dimension in LABEL_TABLES}
