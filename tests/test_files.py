"""Delimited inputs written by hand, cleaning on them, landing and table writes."""

import datetime
import itertools

import pytest
from pyspark.errors import PySparkException

from bercario.functions.codes import STATES
from bercario.operators.cleaning import (
    UnreadableBirths,
    assessed_births,
    clean_births,
    rejected_births,
    unreadable_rows,
)
from bercario.operators.sinks import write_table
from bercario.schemas import BIRTH_COLUMNS
from bercario.sources.delimited import (
    MISSING,
    read_births,
    read_municipalities,
    read_occupations,
    rejected_lines,
    split_births,
)
from bercario.sources.landing import land_if_absent
from bercario.sources.storage import is_complete, scratch_path

RECORD = {
    "CONTADOR": "1", "CODMUNNASC": "350950", "LOCNASC": "1", "ESTCIVMAE": "2", "ESCMAE": "4",
    "CODOCUPMAE": "10105", "QTDFILVIVO": "1", "QTDFILMORT": "0", "GESTACAO": "5", "PARTO": "1",
    "CONSULTAS": "4", "DTNASC": "5012022", "SEXO": "1", "RACACOR": "1", "DTNASCMAE": "1011990",
    "RACACORMAE": "1", "ESCMAEAGR1": "6",
}


def write_births(path, *changes, columns=BIRTH_COLUMNS):
    lines = [";".join(f'"{name}"' for name in columns)]
    for change in changes:
        record = RECORD | change
        lines.append(";".join(record[name] for name in columns))
    path.write_text("\n".join(lines) + "\n", encoding="latin-1")
    return str(path)


def counters(df):
    return sorted(row["CONTADOR"] for row in df.collect())


@pytest.fixture
def births(spark, tmp_path):
    numbers = itertools.count()

    def read(*changes, **options):
        return read_births(spark, write_births(tmp_path / f"{next(numbers)}.csv", *changes, **options))

    return read


def test_values_are_typed(births):
    row = clean_births(births({})).first().asDict()
    assert row["DTNASC"] == datetime.date(2022, 1, 5)
    assert row["DTNASCMAE"] == datetime.date(1990, 1, 1)
    assert {type(v) for k, v in row.items() if not k.startswith("DT")} == {int}
    assert list(row) == BIRTH_COLUMNS


def test_header_order_and_extra_columns_do_not_matter(births):
    other = ["SEXO", *[c for c in reversed(BIRTH_COLUMNS) if c != "SEXO"]]
    expected = clean_births(births({})).collect()
    assert clean_births(births({}, columns=other)).collect() == expected
    wider = ["EXTRA", *other]
    assert clean_births(births({"EXTRA": "x"}, columns=wider)).collect() == expected


def test_listed_paths_may_differ_in_column_order(spark, tmp_path):
    first = write_births(tmp_path / "a.csv", {"CONTADOR": "1"})
    second = write_births(tmp_path / "b.csv", {"CONTADOR": "2"}, columns=BIRTH_COLUMNS[::-1])
    both = clean_births(read_births(spark, [first, second]))
    assert counters(both) == [1, 2]
    assert both.select(*BIRTH_COLUMNS[1:]).distinct().count() == 1


def test_a_folder_with_two_headers_is_an_error(spark, tmp_path):
    write_births(tmp_path / "a.csv", {})
    write_births(tmp_path / "b.csv", {}, columns=BIRTH_COLUMNS[::-1])
    with pytest.raises(Exception, match="(?i)header"):
        clean_births(read_births(spark, str(tmp_path))).collect()


@pytest.mark.parametrize("missing", ["", '""', "NA", "null", '"NaN"', "#N/A"])
def test_missing_markers_drop_the_row(births, missing):
    changes = [{"CONTADOR": str(i), name: missing} for i, name in enumerate(BIRTH_COLUMNS, 100)]
    changes = [c for c in changes if c["CONTADOR"] != missing]
    assert counters(clean_births(births({}, *changes))) == [1]


def test_all_missing_markers_are_listed():
    assert len(MISSING) == len(set(MISSING)) == 18


def test_codes_written_as_decimals(births):
    row = clean_births(births({"SEXO": "2.0", "DTNASC": "31122022.0", "CODMUNNASC": "350950.0"})).first()
    assert (row["SEXO"], row["CODMUNNASC"]) == (2, 350950)
    assert row["DTNASC"] == datetime.date(2022, 12, 31)


def test_range_of_the_mother_and_her_children(births):
    kept = [{"DTNASCMAE": "1011950"}, {"DTNASCMAE": "31122013"}, {"QTDFILVIVO": "10", "QTDFILMORT": "10"}]
    dropped = [
        {"DTNASCMAE": "31121949"}, {"DTNASCMAE": "1012014"},
        {"QTDFILVIVO": "11"}, {"QTDFILMORT": "11"}, {"QTDFILVIVO": "100"}, {"QTDFILMORT": "10.5"},
    ]
    rows = [change | {"CONTADOR": str(i)} for i, change in enumerate(kept + dropped)]
    assert counters(clean_births(births(*rows))) == [0, 1, 2]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    ("column", "value"),
    [
        ("DTNASC", "111990"), ("DTNASC", "311219901"), ("DTNASCMAE", "32011990"),
        ("DTNASCMAE", "soon"), ("SEXO", "M"),
    ],
)
def test_unreadable_values(spark, births, column, value, ansi):
    raw = births({}, {"CONTADOR": "2", column: value}, {"CONTADOR": "3", column: value, "SEXO": ""})
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(UnreadableBirths, match=f"unreadable {column}: {value}"):
            clean_births(raw)
        assert counters(clean_births(raw, strict=False)) == [1]
        rejected = rejected_births(raw).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    # The third row is incomplete, so it is dropped and not rejected (unless it lost the bad value).
    assert [(r["CONTADOR"], r[column], r["motivo"]) for r in rejected] == [("2", value, column)]
    assert unreadable_rows(assessed_births(raw)).select(column, "motivo").collect() == [(value, column)]


def test_a_strict_run_ends_whatever_else_is_wrong_with_the_row(births):
    raw = births({}, {"CONTADOR": "2", "DTNASC": "32011990", "DTNASCMAE": "1011900", "QTDFILVIVO": "99"})
    with pytest.raises(UnreadableBirths, match="unreadable DTNASC: 32011990"):
        clean_births(raw)
    assert counters(clean_births(raw, strict=False)) == [1]


def test_long_codes_keep_their_digits(births):
    rows = births({"CONTADOR": "9007199254740992"}, {"CONTADOR": "9007199254740993"})
    assert counters(clean_births(rows)) == [9007199254740992, 9007199254740993]


def test_lines_with_too_many_or_too_few_fields(spark, tmp_path):
    path = tmp_path / "broken.csv"
    good = ";".join(RECORD[name] for name in BIRTH_COLUMNS)
    long = good.replace("350950", "350;950", 1)
    quoted = good.replace("350950", '"350;950"', 1)
    short = good.rsplit(";", 2)[0]
    path.write_text("\n".join([";".join(BIRTH_COLUMNS), good, long, short, quoted]) + "\n")
    assert counters(clean_births(read_births(spark, str(path)), strict=False)) == [1]
    lines = [tuple(r) for r in rejected_lines(spark, str(path)).collect()]
    assert lines == [("1", long, "campos demais")]


def test_lines_split_by_verdict_in_one_read(spark, tmp_path, monkeypatch):
    good = ";".join(RECORD[name] for name in BIRTH_COLUMNS)
    long, short = good.replace("350950", "350;950", 1), good.rsplit(";", 2)[0]
    for name, lines in (("a.csv", [good, long]), ("b.csv", [short, good, good])):
        (tmp_path / name).write_text("\n".join([";".join(BIRTH_COLUMNS), *lines]) + "\n")
    found = split_births(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], str(tmp_path / "split"))

    def files(df):
        return sorted((r["arquivo"].rsplit("/", 1)[1], r["bloco"]) for r in df.collect())

    assert files(found["completa"]) == [("a.csv", 0), ("b.csv", 0), ("b.csv", 0)]
    assert files(found["incompleta"]) == [("b.csv", 0)]
    assert [(r["linha"], r["CONTADOR"]) for r in found["campos demais"].collect()] == [(long, "1")]
    assert counters(clean_births(found["completa"])) == [1, 1, 1]
    # Each verdict is a folder of its own; the text files are not opened again.
    for df in found.values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(veredito" in plan and "csv" not in plan
    empty = tmp_path / "empty.csv"
    empty.write_text(";".join(BIRTH_COLUMNS) + "\n")
    assert all(df.isEmpty() for df in split_births(spark, str(empty), str(tmp_path / "none")).values())


def test_a_lookup_line_with_too_many_fields_is_an_error(spark, tmp_path):
    cities, jobs = tmp_path / "cities.csv", tmp_path / "jobs.csv"
    cities.write_text("Codigo_Municipio_Completo;Nome_Municipio;Nome_UF\n3509502;Camp;inas;São Paulo\n")
    jobs.write_text("CODIGO;TITULO\n1;a;b\n")
    for df in (read_municipalities(spark, str(cities)), read_occupations(spark, str(jobs))):
        for columns in (df.columns, df.columns[:1], df.columns[1:]):
            with pytest.raises(PySparkException, match="too many fields"):
                df.select(*columns).collect()


def test_municipalities(spark, tmp_path):
    path = tmp_path / "cities.csv"
    path.write_text(
        "Nome_UF;Nome_Municipio;Codigo_Municipio_Completo;Outro\n"
        "São Paulo;Campinas;3509502;x\nAtlantis;Nowhere;9999999;x\nsão paulo;Lower;3509601;x\n",
        encoding="utf-8",
    )
    rows = read_municipalities(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [
        ("350950", "Campinas", "SP"), ("999999", "Nowhere", None), ("350960", "Lower", None),
    ]
    assert STATES["São Paulo"] == "SP"


def test_occupations(spark, tmp_path):
    path = tmp_path / "jobs.csv"
    path.write_bytes("CODIGO;TITULO\n010105;Oficial general da aeronáutica\n".encode("latin-1"))
    rows = read_occupations(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [(10105, "Oficial general da aeronáutica")]


def test_quotes_backslashes_and_separators_in_text(spark, tmp_path):
    path = tmp_path / "jobs.csv"
    path.write_bytes(b'CODIGO;TITULO\n1;"a ""b""; c"\n2;"ends in \\"\n3;"plain"\n')
    rows = read_occupations(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [(1, 'a "b"; c'), (2, "ends in \\"), (3, "plain")]


def status(row):
    return row.first()["status"]


def test_landing_never_replaces(spark):
    path = scratch_path(spark, "land")
    assert status(land_if_absent(spark.range(3), path)) == "created"
    assert status(land_if_absent(spark.range(9), path)) == "exists"
    assert spark.read.parquet(path).count() == 3


def test_landing_on_a_failed_write(spark, tmp_path):
    folder = tmp_path / "half"
    folder.mkdir()
    (folder / "part-0.parquet").write_bytes(b"PAR1")
    assert status(land_if_absent(spark.range(3), str(folder))) == "error"
    assert [f.name for f in folder.iterdir()] == ["part-0.parquet"]


def test_landing_errors_are_reported(spark):
    path = scratch_path(spark, "land")
    bad = spark.range(3).selectExpr("raise_error('broken source') AS x")
    row = land_if_absent(bad, path).first()
    assert row["status"] == "error"
    assert "broken source" in row["message"]
    assert not is_complete(spark, path)
    assert status(land_if_absent(spark.range(3), "")) == "error"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("target", ["path", "table"])
def test_write_modes(spark, target):
    def name(label):
        return {"path": scratch_path(spark, label)} if target == "path" else {"table": f"t_{label}"}

    def read(where):
        return spark.read.parquet(where["path"]) if target == "path" else spark.table(where["table"])

    first = spark.createDataFrame([(1, "a"), (2, "b")], "id BIGINT, label STRING")
    second = spark.createDataFrame([(2, "other"), (3, "c")], "id BIGINT, label STRING")
    expected = {
        "append": [(1, "a"), (2, "b"), (2, "other"), (3, "c")],
        "append_new_only": [(1, "a"), (2, "b"), (3, "c")],
        "overwrite": [(2, "other"), (3, "c")],
    }
    for mode, rows in expected.items():
        where = name(mode)
        for df in (first, second):
            write_table(df, **where, mode=mode, key="id")
        assert rows_of(read(where)) == rows


def test_new_only_by_whole_row_keeps_another_label(spark):
    path = scratch_path(spark, "rows")
    first = spark.createDataFrame([(1, "a"), (2, None)], "id BIGINT, label STRING")
    second = spark.createDataFrame([(1, "other"), (2, None), (1, "a")], "id BIGINT, label STRING")
    for df in (first, second, second):
        write_table(df, path, mode="append_new_only")
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=repr) == [
        (1, "a"), (1, "other"), (2, None),
    ]


def test_new_rows_after_a_failed_first_write(spark, tmp_path):
    folder = tmp_path / "table"
    folder.mkdir()
    write_table(spark.range(2), str(folder), mode="append_new_only", key="id")
    assert rows_of(spark.read.parquet(str(folder))) == [(0,), (1,)]


def test_partitioned_write(spark):
    path = scratch_path(spark, "parts")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id BIGINT, part STRING")
    for _ in range(2):
        write_table(df, path, mode="append_new_only", key="id", partition_by=["part"])
    assert rows_of(spark.read.parquet(path)) == [(1, "x"), (2, "y")]


def test_write_arguments_are_checked(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="path or a table"):
        write_table(df)
    with pytest.raises(ValueError, match="unknown mode"):
        write_table(df, "x", mode="merge")
