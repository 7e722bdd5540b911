"""Loads of a warehouse: the ledger, corrections, dated labels and the stored counts."""

import datetime
import random
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bercario.catalog import queries as q
from bercario.operators import lookups
from bercario.operators.history import attach_as_of, dated, history_of, labels_as_of, new_labels
from bercario.plans import cube, reports, star, warehouse
from bercario.plans.ledger import Ledger, Load, Store, remove_unused
from bercario.plans.warehouse import (
    build_warehouse,
    corrected,
    read_cube,
    read_history,
    read_warehouse,
)
from bercario.schemas import DATE_COLUMNS, RECORDS, SOURCE, YEAR
from bercario.sources.storage import scratch_path, written_files

from tests.test_plans import explained, shuffles
from tests.test_star import births, municipalities, occupations, rows

DAY = datetime.date


def raw(spark, *changes):
    """Raw births: the dates of the changes as ddMMyyyy numbers."""
    found = births(spark, *changes)
    return found.withColumns({c: F.date_format(c, "ddMMyyyy").cast("bigint") for c in DATE_COLUMNS})


def load(spark, root, *changes, **options):
    build_warehouse(raw(spark, *changes), municipalities(spark), occupations(spark), root, **options)


def numbers(spark, root, *columns):
    return rows(read_warehouse(spark, root)[RECORDS].select("CONTADOR", *columns))


# The ledger -----------------------------------------------------------------------------------


def ledger_of(spark, *loads):
    return Ledger(Store(spark, "nowhere"), tuple(loads))


def test_which_rows_are_in_force(spark):
    ledger = ledger_of(
        spark,
        Load("0000000001-a", "append"),
        Load("0000000002-b", "correct", years=(2000, 2001)),
        Load("0000000003-c", "append"),
        Load("0000000004-d", "correct", years=(2001,)),
    )
    stored = [(batch, year) for batch in ("0000000001-a", "0000000002-b", "0000000002-x", "0000000003-c", "0000000004-d") for year in (1999, 2000, 2001)]
    frame = spark.createDataFrame(stored, f"lote STRING, {YEAR} INT")
    assert rows(frame.filter(ledger.in_force(by_year=True))) == [
        ("0000000001-a", 1999),
        ("0000000002-b", 1999), ("0000000002-b", 2000),
        ("0000000003-c", 1999), ("0000000003-c", 2000),
        ("0000000004-d", 1999), ("0000000004-d", 2000), ("0000000004-d", 2001),
    ]
    assert frame.filter(ledger.in_force(by_year=False)).count() == 12
    anew = ledger_of(spark, *ledger.loads, Load("0000000005-e", "overwrite", everything=True))
    assert frame.filter(anew.in_force(by_year=True)).count() == 0
    assert frame.filter(ledger_of(spark).in_force(by_year=True)).count() == 0


def test_names_of_loads_sort_and_differ(spark):
    ledger = ledger_of(spark, Load("0000000009-f", "append"))
    first, again = ledger.next_batch(), ledger.next_batch()
    assert first != again and "0000000009-f" < min(first, again)
    assert {name.split("-")[0] for name in (first, again)} == {"0000000010"}


def broken(spark):
    title = F.when(F.col("CODIGO") < 0, "").otherwise(F.raise_error(F.lit("no title")))
    return occupations(spark).withColumn("TITULO", title)


@pytest.mark.parametrize("mode", ["append_new_only", "overwrite", "correct"])
def test_a_broken_load_changes_nothing_and_can_be_repeated(spark, mode):
    root = scratch_path(spark, "broken")
    load(spark, root, {}, {"CONTADOR": 2}, source="a")
    before = {name: rows(df) for name, df in read_warehouse(spark, root).items()}
    counts = rows(read_cube(spark, root))
    changes = raw(spark, {"ESCMAE": 7}, {"CONTADOR": 3})
    for _ in range(2 if mode == "correct" else 1):
        with pytest.raises(Exception, match="no title"):
            build_warehouse(changes, municipalities(spark), broken(spark), root, mode=mode, source="a")
        assert {name: rows(df) for name, df in read_warehouse(spark, root).items()} == before
        assert rows(read_cube(spark, root)) == counts
    build_warehouse(changes, municipalities(spark), occupations(spark), root, mode=mode, source="a")
    expected = {
        "append_new_only": [(1, 4), (1, 7), (2, 4), (3, 4)],
        "overwrite": [(1, 7), (3, 4)],
        "correct": [(1, 7), (2, 4), (3, 4)],
    }
    assert numbers(spark, root, "ESCMAE") == expected[mode]
    tables = read_warehouse(spark, root)
    assert tables["dim_mae"].count() == tables["fatos_nascidos"].count() == len(expected[mode])
    total = cube.cells(read_cube(spark, root)).agg(F.sum(cube.COUNT)).first()[0]
    assert total == len(expected[mode])


def test_a_first_load_that_breaks_leaves_an_empty_warehouse(spark):
    root = scratch_path(spark, "first")
    with pytest.raises(Exception, match="no title"):
        build_warehouse(raw(spark, {}), municipalities(spark), broken(spark), root)
    assert all(df.isEmpty() for df in read_warehouse(spark, root).values())
    assert read_cube(spark, root).isEmpty()
    assert remove_unused(spark, root)
    load(spark, root, {})
    assert numbers(spark, root) == [(1,)]
    assert remove_unused(spark, root) == []


def test_unused_folders_are_removed_and_no_others(spark):
    root = scratch_path(spark, "unused")
    load(spark, root, {}, {"CONTADOR": 2, "DTNASC": DAY(2021, 5, 5)}, source="a")
    load(spark, root, {"ESCMAE": 7}, mode="correct", source="a")
    with pytest.raises(Exception, match="no title"):
        build_warehouse(raw(spark, {"ESCMAE": 1}), municipalities(spark), broken(spark), root)
    before = {name: rows(df) for name, df in read_warehouse(spark, root).items()}
    counts = rows(read_cube(spark, root))
    removed = remove_unused(spark, root)
    replaced = [path for path in removed if "lote=0000000001" in path]
    assert replaced and all(f"{YEAR}=2022" in path for path in replaced)
    assert not any("lote=0000000002" in path for path in removed)
    assert {name: rows(df) for name, df in read_warehouse(spark, root).items()} == before
    assert rows(read_cube(spark, root)) == counts


def test_an_unknown_mode(spark):
    with pytest.raises(ValueError, match="unknown mode"):
        load(spark, scratch_path(spark, "mode"), {}, mode="merge")


# Corrections ----------------------------------------------------------------------------------


def test_a_year_without_a_correction_is_not_written_again(spark):
    root = scratch_path(spark, "years")
    load(spark, root, {}, {"CONTADOR": 2, "DTNASC": DAY(2021, 5, 5)}, {"CONTADOR": 3, "DTNASC": DAY(2020, 1, 1)}, source="a")
    files = written_files(spark, f"{root}/dw/fatos_nascidos/{YEAR}=2021")
    # Number 1 moves from 2022 to 2020; number 2 comes again as it was.
    load(spark, root, {"DTNASC": DAY(2020, 7, 7)}, {"CONTADOR": 2, "DTNASC": DAY(2021, 5, 5)}, mode="correct", source="a")
    assert written_files(spark, f"{root}/dw/fatos_nascidos/{YEAR}=2021") == files
    assert numbers(spark, root, YEAR) == [(1, 2020), (2, 2021), (3, 2020)]
    assert Ledger.read(Store(spark, root)).loads[-1].years == (2020, 2022)
    # The same file once more changes nothing.
    load(spark, root, {"DTNASC": DAY(2020, 7, 7)}, {"CONTADOR": 2, "DTNASC": DAY(2021, 5, 5)}, mode="correct", source="a")
    assert Ledger.read(Store(spark, root)).loads[-1].years == ()
    assert numbers(spark, root, YEAR) == [(1, 2020), (2, 2021), (3, 2020)]


def test_sources_do_not_correct_each_other(spark):
    root = scratch_path(spark, "sources")
    for source in ("a", "b"):
        load(spark, root, {}, {"CONTADOR": 2}, mode="correct", source=source)
    load(spark, root, {"ESCMAE": 9}, mode="correct", source="b")
    assert numbers(spark, root, "ESCMAE", SOURCE) == [(1, 4, "a"), (1, 9, "b"), (2, 4, "a"), (2, 4, "b")]
    load(spark, root, {"CONTADOR": 2}, mode="replace", source="a")
    assert numbers(spark, root, "ESCMAE", SOURCE) == [(1, 9, "b"), (2, 4, "a"), (2, 4, "b")]
    # Records that were distinct when stored: the wide view and the cube count the same.
    tables = read_warehouse(spark, root)
    assert star.births_wide_from_star(tables).count() == 3


def plain_corrected(stored, batch, source, whole):
    """Records as (year, number, education, source)."""
    offered = {number for _, number, _ in batch}
    gone = {r for r in stored if r[3] == source and (whole or r[1] in offered)} - {(*r, source) for r in batch}
    new = {(*r, source) for r in batch} - set(stored)
    years = sorted({r[0] for r in gone | new})
    return years, sorted(r for r in (set(stored) - gone) | new if r[0] in years)


@pytest.mark.parametrize("seed", range(3))
def test_corrections_equal_plain_ones(spark, seed):
    rng = random.Random(seed)

    def some(many, *sources):
        return sorted({(rng.randint(2000, 2004), rng.randint(1, 12), rng.randint(1, 3), *[rng.choice(x) for x in sources]) for _ in range(many)})

    def frame(found, source):
        changes = [{"CONTADOR": r[1], "ESCMAE": r[2], "DTNASC": DAY(r[0], 3, 3)} for r in found]
        return star.records(births(spark, *changes), unique=True).withColumn(SOURCE, F.lit(source))

    stored, batch = some(25, "ab"), some(8)
    frames = frame([r for r in stored if r[3] == "a"], "a").unionByName(frame([r for r in stored if r[3] == "b"], "b"))
    for whole in (False, True):
        years, after, new = corrected(frames, frame(batch, "a"), "a", whole)
        expected_years, expected = plain_corrected(stored, batch, "a", whole)
        assert years == expected_years
        assert rows(after.select(YEAR, "CONTADOR", "ESCMAE", SOURCE)) == sorted(expected, key=repr)
        assert new.count() == len({(*r, "a") for r in batch} - set(stored))


def test_an_empty_correction_and_an_empty_warehouse(spark):
    root = scratch_path(spark, "empty")
    none = raw(spark, {}).filter("CONTADOR < 0")
    for mode in ("correct", "append_new_only", "replace"):
        build_warehouse(none, municipalities(spark), occupations(spark), root, mode=mode, source="a")
        assert numbers(spark, root) == []
    load(spark, root, {}, mode="correct", source="a")
    build_warehouse(none, municipalities(spark), occupations(spark), root, mode="correct", source="a")
    assert numbers(spark, root) == [(1,)]
    build_warehouse(none, municipalities(spark), occupations(spark), root, mode="replace", source="a")
    assert numbers(spark, root) == []


def test_readers_open_only_partitions_in_force(spark):
    root = scratch_path(spark, "pruned")
    load(spark, root, {}, source="a")
    load(spark, root, {"ESCMAE": 7}, mode="correct", source="a")
    plan = explained(read_warehouse(spark, root)["fatos_nascidos"], "formatted")
    assert "PartitionFilters: [" in plan and "lote" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert shuffles(read_warehouse(spark, root)["fatos_nascidos"]) == []


# Labels over time -----------------------------------------------------------------------------


def said(spark, *found):
    return spark.createDataFrame(list(found), "code BIGINT, label STRING, state STRING, desde DATE")


def plain_label(found, code, day, earliest=True):
    known = sorted((since, label, state) for c, label, state, since in found if c == code)
    days = {}
    for since, label, state in known:
        days.setdefault(since, (label, state))
    past = [since for since in days if since <= day]
    if past:
        return days[max(past)]
    return days[min(days)] if days and earliest else (None, None)


def test_labels_of_a_day_equal_plain_ones(spark, monkeypatch):
    rng = random.Random(4)
    found = [(rng.randint(1, 6), rng.choice("abc"), rng.choice(["x", None]), DAY(2000, rng.randint(1, 12), 1)) for _ in range(40)]
    found = [r for r in found if r[2]] + [(7, "only", None, DAY(2000, 5, 1))]
    history = history_of(said(spark, *found), "code")
    asked = [(code, DAY(2000, month, 15)) for code in (*range(1, 9), None) for month in range(1, 13)]
    frame = spark.createDataFrame(asked, "code BIGINT, born DATE")
    for few in (100_000, 2):
        monkeypatch.setattr(lookups, "BROADCAST_ROWS", few)
        for earliest in (True, False):
            got = attach_as_of(frame, history, "code", F.col("born"), earliest)
            assert rows(got) == sorted(((c, d, *plain_label(found, c, d, earliest)) for c, d in asked), key=repr)
    for day in (DAY(1999, 1, 1), DAY(2000, 5, 1), DAY(2001, 1, 1)):
        expected = {(c, *plain_label(found, c, day, False)) for c in range(1, 8)}
        assert set(rows(labels_as_of(history, day))) == {r for r in expected if r[1] is not None}
    assert rows(labels_as_of(history)) == rows(labels_as_of(history, DAY(2050, 1, 1)))


def test_intervals_join_and_do_not_overlap(spark):
    found = [(1, "a", "x", DAY(2000, 1, 1)), (1, "a", "x", DAY(2001, 1, 1)), (1, "b", "x", DAY(2002, 1, 1)), (1, "a", "x", DAY(2003, 1, 1))]
    expected = [
        (1, "a", "x", DAY(2000, 1, 1), DAY(2002, 1, 1)), (1, "a", "x", DAY(2003, 1, 1), None),
        (1, "b", "x", DAY(2002, 1, 1), DAY(2003, 1, 1)),
    ]
    history = history_of(said(spark, *found), "code")
    assert rows(history) == expected
    # What is known already is not new; what a day in between says is.
    offered = said(spark, (1, "a", "x", DAY(2001, 6, 6)), (1, "c", "x", DAY(2002, 6, 6)), (2, "z", None, DAY(2000, 1, 1)))
    assert rows(new_labels(offered, history, "code")) == [(1, "c", "x", DAY(2002, 6, 6)), (2, "z", None, DAY(2000, 1, 1))]
    assert rows(new_labels(offered, history_of(said(spark), "code"), "code")) == rows(offered)
    twice = spark.createDataFrame([(1, "b"), (1, "a"), (None, "n")], "code BIGINT, label STRING")
    assert rows(dated(twice, "code", DAY(2000, 1, 1))) == [(1, "a", DAY(2000, 1, 1))]


def test_files_in_any_order_of_their_days(spark):
    """The later file is loaded first; a file that says nothing new adds no row."""
    histories = []
    for days in ((DAY(2010, 1, 1), DAY(2000, 1, 1)), (DAY(2000, 1, 1), DAY(2010, 1, 1), DAY(2015, 1, 1))):
        root = scratch_path(spark, "order")
        for day in days:
            old = day == DAY(2000, 1, 1)
            jobs = spark.createDataFrame([(10105, "Antigo" if old else "Novo")], "CODIGO BIGINT, TITULO STRING")
            build_warehouse(raw(spark, {}), municipalities(spark), jobs, root, mode="append_new_only", labels_since=day)
        histories.append(rows(read_history(spark, root)["dim_profissao"]))
        assert rows(read_history(spark, root)["dim_municipio"])[0][:3] == (350950, "Campinas", "SP")
    assert histories[0] == histories[1] == [
        (10105, "Antigo", DAY(2000, 1, 1), DAY(2010, 1, 1)), (10105, "Novo", DAY(2010, 1, 1), None),
    ]


# The stored counts ----------------------------------------------------------------------------


def test_cube_of_hand_written_births(spark):
    changes = [{}, {"CONTADOR": 2, "RACACOR": 9}, {"CONTADOR": 3, "PARTO": 1, "QTDFILVIVO": 4, "DTNASC": DAY(2021, 2, 2)}]
    counts = cube.counted(star.records(births(spark, *changes), unique=True))
    assert Counter(r["conjunto"] for r in counts.collect()) == {
        "base": 2, "idade": 2, "escolaridade": 2, "ocupacao": 2, "local": 2, "raca_mae": 2,
        "raca_nascido": 3, "consulta": 2, "mes": 2,
    }
    assert rows(reports.births_by_newborn_race(cube.cells(counts, "raca_nascido"))) == [("Amarela", 2), ("Desconhecido", 1)]
    assert rows(reports.births_by_month(cube.cells(counts, "mes")).select("mes", "nascimentos")) == [
        (DAY(2021, 2, 1), 1), (DAY(2022, 1, 1), 2),
    ]
    assert rows(reports.children_by_age(cube.cells(counts, "idade")).select("idade", "filhos_vivos")) == [(30, 4), (31, 2)]


def test_reports_of_an_empty_cube(spark):
    none = cube.counted(star.records(births(spark, {}).limit(0), unique=True))
    assert rows(reports.births_total(cube.cells(none))) == [(0,)]
    assert rows(reports.delivery_totals(cube.cells(none))) == [(0, 0, 0)]
    assert rows(reports.births_by_age_band(cube.cells(none, "idade"))) == []


def test_reports_from_the_cube_read_no_record(spark, folder):
    for name in (n for n in q.QUERIES if n.startswith("cube_") and n != "cube_after_corrections"):
        tables = {file.split("/dw/")[-1].split("/")[0] for file in q.QUERIES[name](spark, folder).inputFiles()}
        # Running totals are stored in between, made from the counts.
        assert "cubo" in tables or name.endswith(("municipality_pareto", "occupation_pareto"))
        assert not any(name in file for file in tables for name in ("registros", "fatos", "dim_mae", "orders"))


def test_records_are_counted_in_one_pass(spark, folder):
    plan = explained(cube.counted(q._records(spark, folder)))
    assert plan.count("FileScan parquet") == 1 and plan.count("Expand") == 1
    assert "partial_count(1)" in plan and shuffles(cube.counted(q._records(spark, folder))) == ["hashpartitioning"]


def test_silver_is_assessed_and_counted_in_one_pass(spark, tmp_path):
    """The write counts unreadable rows itself: without any, the stored rows are not looked at."""
    root = str(tmp_path / "silver")
    load(spark, root, {})
    assert not Path(root, "silver", "births_rejected").exists()


# Files kept together by place -----------------------------------------------------------------


def rows_scanned(df):
    """Rows that the file scan of a frame gives to the rest of the plan."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plans, found = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            plans.append(plan.executedPlan())
        if plan.nodeName().startswith("Scan parquet"):
            found += plan.metrics().apply("numOutputRows").value()
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
        if plan.nodeName().endswith("QueryStage"):
            plans.append(plan.plan())
    return found


def test_a_filter_on_place_reads_few_rows(spark):
    root = scratch_path(spark, "clustered")
    many, place = 60_000, 110_000 + (F.col("id") * 7919) % 60
    changes = {"CONTADOR": F.col("id"), "CODMUNNASC": place, "DTNASC": F.lit(1012022), "DTNASCMAE": F.lit(1011990)}
    one = raw(spark, {}).drop(*changes)
    births_ = spark.range(many).crossJoin(one).select(*one.columns, *[c.cast("bigint").alias(n) for n, c in changes.items()])
    cities = spark.createDataFrame(
        [(str(110_000 + i), f"c{i}", "SP" if i < 3 else "RJ") for i in range(60)],
        "Codigo_Municipio_Completo STRING, Nome_Municipio STRING, UF STRING",
    )
    build_warehouse(births_, cities, occupations(spark), root)
    fact = read_warehouse(spark, root)["fatos_nascidos"]
    chosen = reports.in_states(fact, star.municipality_labels(cities), ["SP"])
    assert chosen.count() == many // 20
    assert rows_scanned(fact.select("id_mae")) == many
    assert rows_scanned(chosen.select("id_mae")) <= many // 4
    rest = reports.in_states(fact, star.municipality_labels(cities), ["RJ", None])
    assert rest.count() == many - many // 20


# Bucketed records -----------------------------------------------------------------------------


def test_stored_records_of_a_catalog_are_not_moved(spark, monkeypatch):
    path = scratch_path(spark, "bucketed")
    name = "d" + path[-32:]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    monkeypatch.setattr(warehouse, "BUCKETS", 3)
    first = [{}, {"CONTADOR": 2}, {"CONTADOR": 3, "DTNASC": DAY(2021, 5, 5)}]
    second = [{}, {"CONTADOR": 2, "ESCMAE": 8}, {"CONTADOR": 4}]
    for changes in (first, second, second):
        load(spark, scratch_path(spark, "root"), *changes, database=name, mode="append_new_only")
    stored = read_warehouse(spark, database=name)[RECORDS]
    assert rows(stored.select("CONTADOR", "ESCMAE")) == [(1, 4), (2, 4), (2, 8), (3, 4), (4, 4)]
    batch = star.records(births(spark, *second), unique=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = explained(warehouse.unseen(batch, stored))
        assert warehouse.unseen(batch, stored).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan or "SelectedBucketsCount: 3 out of 3" in plan
    # One exchange: that of the batch.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_what_a_correction_changes_is_found_once(spark):
    def recorded(*changes):
        return star.records(births(spark, *changes), True).withColumn(SOURCE, F.lit("a"))

    stored = recorded({}, {"CONTADOR": 2})
    for change in ({"CONTADOR": 3}, {"ESCMAE": 9}):
        _, after, new = corrected(stored, recorded(change), "a", False)
        for found in (after, new):
            assert "Join" not in explained(found)
    assert rows(after.select("CONTADOR", "ESCMAE")) == [(1, 9), (2, 4)]
