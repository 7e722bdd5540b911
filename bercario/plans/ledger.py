"""The ledger of a warehouse: which loads count, and what each has replaced.

A load writes its rows under a name of its own, the partition ``lote`` of every table. When all tables
are written it adds one row to the ledger, and only then do readers see any of its rows: a run that
dies half way changes no total, and can be repeated without cleaning up. A load may replace all
earlier rows of some years (a correction) or of all tables (an overwrite); the rows it replaces stay
in their files until ``remove_unused``, so a reader that has begun is not disturbed.

One writer at a time. Names of loads sort in the order of their loads; those of two attempts at the
same load differ. The ledger has one row per load, and is read by the driver.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bercario.schemas import BATCH, YEAR
from bercario.sources.storage import folders_below, path_exists, remove_folder

LEDGER = "lotes"
SCHEMA = f"{BATCH} STRING, modo STRING, fonte STRING, tudo BOOLEAN, anos ARRAY<INT>, registros BIGINT"


@dataclass(frozen=True)
class Load:
    """A finished load. ``years`` are those whose earlier rows it replaces."""

    batch: str
    mode: str
    source: str = ""
    everything: bool = False
    years: tuple[int, ...] = ()
    records: int = 0


@dataclass(frozen=True)
class Store:
    """Where the tables of a warehouse are: folders under ``root``, or a ``database``."""

    spark: SparkSession
    root: str | None = None
    database: str | None = None

    def target(self, table: str) -> dict[str, str]:
        """The table, as an argument of ``write_table``."""
        if self.database:
            return {"table": f"{self.database}.{table}"}
        return {"path": f"{self.root}/dw/{table}"}

    def exists(self, table: str) -> bool:
        if self.database:
            return self.spark.catalog.tableExists(f"{self.database}.{table}")
        return path_exists(self.spark, f"{self.root}/dw/{table}")

    def read(self, table: str, schema) -> DataFrame:
        """All rows of a table, of unfinished and replaced loads too; none if it was never written."""
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        if self.database:
            return self.spark.table(f"{self.database}.{table}")
        return self.spark.read.schema(schema).parquet(f"{self.root}/dw/{table}")


@dataclass(frozen=True)
class Ledger:
    """The finished loads in order."""

    store: Store
    loads: tuple[Load, ...] = field(default=())

    @classmethod
    def read(cls, store: Store) -> Ledger:
        rows = store.read(LEDGER, SCHEMA).collect()
        loads = [
            Load(r[BATCH], r["modo"], r["fonte"], r["tudo"], tuple(r["anos"]), r["registros"]) for r in rows
        ]
        return cls(store, tuple(sorted(loads, key=lambda load: load.batch)))

    def next_batch(self) -> str:
        """A name for the next load, or for one more attempt at it."""
        number = int(self.loads[-1].batch.split("-")[0]) + 1 if self.loads else 1
        return f"{number:010d}-{uuid.uuid4().hex[:12]}"

    def valid(self) -> list[str]:
        """The loads since the last one that replaced everything."""
        first = max((i for i, load in enumerate(self.loads) if load.everything), default=0)
        return [load.batch for load in self.loads[first:]]

    def replaced_years(self) -> dict[int, str]:
        """For each year that was ever replaced: the last load that did."""
        return {year: load.batch for load in self.loads for year in load.years}

    def in_force(self, by_year: bool) -> Column:
        """A condition on the partitions of a table, so that other files are not even opened."""
        counts = F.col(BATCH).isin(self.valid())
        if not by_year:
            return counts
        older = [
            ~((F.col(YEAR) == year) & (F.col(BATCH) < batch))
            for year, batch in sorted(self.replaced_years().items())
        ]
        return reduce(and_, older, counts)

    def rows(self, table: str, schema, by_year: bool) -> DataFrame:
        """The rows of a table that count, with the load that wrote each."""
        return self.store.read(table, schema).filter(self.in_force(by_year))

    def commit(self, load: Load) -> None:
        """From now on readers see the rows of the load: the last write, of one file."""
        row = (load.batch, load.mode, load.source, load.everything, list(load.years), load.records)
        frame = self.store.spark.createDataFrame([row], SCHEMA).coalesce(1)
        target = self.store.target(LEDGER)
        if "table" in target:
            frame.write.mode("append").format("parquet").saveAsTable(target["table"])
        else:
            frame.write.mode("append").parquet(target["path"])


def remove_unused(spark: SparkSession, root: str) -> list[str]:
    """Delete the folders of loads that never finished or that later ones replaced; their paths.

    Not while a load or a reader that began before the last load is running.
    """
    ledger = Ledger.read(Store(spark, root))
    valid, replaced = set(ledger.valid()), ledger.replaced_years()
    removed = []
    for path in folders_below(spark, f"{root}/dw", f"{BATCH}=*") + folders_below(
        spark, f"{root}/dw", f"{YEAR}=*/{BATCH}=*"
    ):
        parts = dict(part.split("=", 1) for part in path.split("/") if "=" in part)
        batch, year = parts[BATCH], parts.get(YEAR)
        if batch not in valid or (year is not None and batch < replaced.get(int(year), "")):
            remove_folder(spark, path)
            removed.append(path)
    return sorted(removed)
