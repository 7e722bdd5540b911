"""Builds the unsampled warehouse from millions of births and reports what it took.

    python scale.py [copies] [result file]

The births are those of the adapter over ``$BENCH_SF_DIR``, repeated with other numbers and written as
delimited text first; building reads that text. A third of the births share one occupation. Time,
shuffle bytes and spill of the build come from Spark's event log, in a new scratch folder.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import functions as F

from bercario.plans import cube, reports, star
from bercario.plans.warehouse import build_warehouse, read_cube, read_warehouse
from bercario.schemas import RECORDS
from bercario.session import local_session
from bercario.sources import adapter
from bercario.sources.delimited import prepare_municipalities, prepare_occupations, read_births


def task_totals(folder: Path, begun: float, ended: float) -> dict[str, float]:
    """Sums over the tasks that ended between two times, in milliseconds."""
    totals = dict.fromkeys(("tasks", "task_seconds", "shuffle_mb", "spill_mb", "input_mb"), 0.0)
    for log in folder.rglob("*"):
        if not log.is_file():
            continue
        for line in log.open(errors="replace"):
            if '"SparkListenerTaskEnd"' not in line:
                continue
            event = json.loads(line)
            if not begun <= event["Task Info"]["Finish Time"] <= ended:
                continue
            metrics = event.get("Task Metrics") or {}
            totals["tasks"] += 1
            totals["task_seconds"] += metrics.get("Executor Run Time", 0) / 1e3
            totals["shuffle_mb"] += metrics["Shuffle Write Metrics"]["Shuffle Bytes Written"] / 1e6
            totals["spill_mb"] += metrics["Disk Bytes Spilled"] / 1e6
            totals["input_mb"] += metrics["Input Metrics"]["Bytes Read"] / 1e6
    return {name: round(value, 1) for name, value in totals.items()}


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 20
    result = sys.argv[2] if len(sys.argv) > 2 else "SCALE.json"
    source = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    scratch = Path(tempfile.mkdtemp(prefix="scale-"))
    (scratch / "events").mkdir()
    spark = local_session(
        "scale",
        cores,
        **{
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": str(scratch / "shared"),
            "spark.sql.shuffle.partitions": "64",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{scratch}/events",
            "spark.eventLog.compress": "false",
        },
    )
    raw = adapter.raw_births(spark, source)
    top = raw.agg(F.max("CONTADOR")).first()[0]
    raw = raw.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    raw = raw.withColumn("CONTADOR", F.col("CONTADOR") + F.col("_copy") * top).drop("_copy")
    raw = raw.withColumn("CODOCUPMAE", F.when(F.col("CONTADOR") % 3 == 0, 7).otherwise(F.col("CODOCUPMAE")))
    text = str(scratch / "births")
    raw.repartition(64).write.options(header=True, sep=";", encoding="ISO-8859-1").csv(text)
    cities = prepare_municipalities(adapter.raw_municipalities(spark, source), adapter.ADAPTER_STATES)
    jobs = prepare_occupations(adapter.raw_occupations(spark, source))
    root = str(scratch / "warehouse")

    def measured(work) -> dict:
        begun = time.time()
        work()
        seconds = time.time() - begun
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        log = task_totals(scratch / "events", begun * 1e3, time.time() * 1e3)
        return {"seconds": round(seconds, 1)} | log

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    found = {
        "build": measured(lambda: build_warehouse(read_births(spark, text), cities, jobs, root)),
        "repeat_append_new_only": measured(
            lambda: build_warehouse(read_births(spark, text), cities, jobs, root, mode="append_new_only")
        ),
    }
    # A later file: a hundredth of the births of one year with another education, the others again.
    texts = read_births(spark, text)
    year = texts.filter(F.col("DTNASC").cast("bigint") % 10_000 == 1996)
    changed = F.when(F.col("CONTADOR").cast("bigint") % 100 == 0, "9").otherwise(F.col("ESCMAE"))
    found["correct_one_year"] = measured(
        lambda: build_warehouse(year.withColumn("ESCMAE", changed), cities, jobs, root, mode="correct")
    )
    tables = read_warehouse(spark, root)
    found["births_wide_from_star"] = measured(lambda: noop(star.births_wide_from_star(tables)))
    profile = star.birth_profile(tables[RECORDS], unique=True, only=["escolaridade"])
    found["report_education"] = measured(lambda: noop(reports.births_by_education(profile)))
    by_label = cube.cells(read_cube(spark, root), "escolaridade")
    found["cube_education"] = measured(lambda: noop(reports.births_by_education(by_label)))
    rows = {name: df.count() for name, df in tables.items()}
    made = {"raw_births": raw.count(), "cores": int(cores), "rows": rows, "steps": found}
    spark.stop()
    Path(result).write_text(json.dumps(made, indent=2) + "\n")
    print(json.dumps(made))


if __name__ == "__main__":
    main()
