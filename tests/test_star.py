"""The star schema on hand-written births, and its properties on the driver tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from bercario.catalog import queries as q
from bercario.operators import lookups
from bercario.operators.cleaning import UnreadableBirths
from bercario.plans import reports, star
from bercario.plans.warehouse import build_warehouse, read_warehouse
from bercario.schemas import BIRTH_COLUMNS, DATE_COLUMNS, RECORDS, STAR, STAR_KEYS, table_schema
from bercario.sources import adapter
from bercario.sources.storage import path_exists, scratch_path

DAY = datetime.date
BIRTH = {
    "CONTADOR": 1, "CODMUNNASC": 350950, "LOCNASC": 2, "ESTCIVMAE": 5, "ESCMAE": 4,
    "CODOCUPMAE": 10105, "QTDFILVIVO": 1, "QTDFILMORT": 0, "GESTACAO": 5, "PARTO": 2,
    "CONSULTAS": 1, "DTNASC": DAY(2022, 1, 30), "SEXO": 0, "RACACOR": 3,
    "DTNASCMAE": DAY(1990, 10, 20), "RACACORMAE": 4, "ESCMAEAGR1": 6,
}


def births(spark, *changes):
    schema = ", ".join(f"{c} {'DATE' if c in DATE_COLUMNS else 'BIGINT'}" for c in BIRTH_COLUMNS)
    rows = [tuple((BIRTH | change)[c] for c in BIRTH_COLUMNS) for change in changes]
    return spark.createDataFrame(rows, schema)


def municipalities(spark):
    return spark.createDataFrame(
        [("350950", "Campinas", "SP"), ("350950", "Campinas", "SP"), ("999999", "Unused", "RJ")],
        "Codigo_Municipio_Completo STRING, Nome_Municipio STRING, UF STRING",
    )


def occupations(spark):
    return spark.createDataFrame(
        [(10105, "Oficial"), (10105, "Outro título"), (20000, "Unused")], "CODIGO BIGINT, TITULO STRING"
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_fact_is_corrected_by_default(spark):
    assert rows(star.fact_births(births(spark, {}))) == [
        (1, DAY(2022, 1, 30), 350950, 20, 1, "Amarela", "Outros estabelecimentos de saúde")
    ]


def test_fact_in_compatible_mode(spark):
    assert rows(star.fact_births(births(spark, {}), compat=True)) == [
        (1, "2022-01-3", 350950, 20, 1, "Branca", "Domicílio")
    ]


def test_mother(spark):
    expected = (1, 4, 10105, DAY(1990, 10, 20), 5, "Parda", "União estável", 1, 0)
    assert rows(star.dim_mae(births(spark, {}))) == [expected]
    compat = [*expected[:3], "1990-10-2", *expected[4:]]
    assert rows(star.dim_mae(births(spark, {}), compat=True)) == [tuple(compat)]
    grouped = [expected[0], 6, *expected[2:]]
    assert rows(star.dim_mae(births(spark, {}), "ESCMAEAGR1")) == [tuple(grouped)]


def test_unknown_codes_have_no_label(spark):
    odd = births(spark, {"ESCMAE": 13, "LOCNASC": 9, "RACACOR": 9, "PARTO": 1, "SEXO": 10})
    assert rows(star.dim_escolaridade(odd)) == [(13, None)]
    assert rows(star.dim_parto_sexo(odd)) == [(110, None, "Vaginal")]
    assert rows(star.fact_births(odd))[0][5:] == (None, None)


def test_births_are_distinct_records(spark):
    again = births(spark, {}, {}, {"ESCMAE": 5}, {"LOCNASC": 3})
    for compat in (False, True):
        assert star.fact_births(again, compat=compat).count() == 3
        assert star.dim_mae(again, compat=compat).count() == 3
    assert star.birth_profile(again, only=[]).count() == 3


def test_every_view_counts_the_same_births(spark):
    """Records that share a number are different births, each with its own mother."""
    later = {"DTNASC": DAY(2023, 1, 30), "DTNASCMAE": DAY(1970, 1, 1)}
    rows_ = star.records(births(spark, {}, {}, later, {"ESCMAE": 5}))
    tables = star.star_tables(rows_, municipalities(spark), occupations(spark), unique=True)
    wide = star.births_wide_from_star(tables | {RECORDS: rows_})
    assert wide.count() == tables["fatos_nascidos"].count() == tables["dim_mae"].count() == 3
    mothers = {(r["id_calendario"], r["id_escmae"]): r["dtnascmae"] for r in wide.collect()}
    assert mothers == {
        (DAY(2022, 1, 30), 4): DAY(1990, 10, 20), (DAY(2022, 1, 30), 5): DAY(1990, 10, 20),
        (DAY(2023, 1, 30), 4): DAY(1970, 1, 1),
    }


def test_reference_dimensions_keep_what_occurs(spark):
    one = births(spark, {}, {"CONTADOR": 2})
    assert rows(star.dim_municipio(one, municipalities(spark))) == [(350950, "Campinas", "SP")]
    titles = [(10105, "Oficial"), (10105, "Outro título")]
    assert rows(star.dim_profissao(one, occupations(spark))) == titles
    assert star.join_municipalities(one, municipalities(spark)).count() == 4


def test_a_code_with_two_titles_does_not_multiply_births(spark):
    one = births(spark, {}, {"CONTADOR": 2}, {"CONTADOR": 3, "CODMUNNASC": 1})
    wide = star.births_wide(one, municipalities(spark), occupations(spark))
    assert sorted((r["id_mae"], r["cidade"], r["ocupacao"]) for r in wide.collect()) == [
        (1, "Campinas", "Oficial"), (2, "Campinas", "Oficial"), (3, None, "Oficial"),
    ]


def test_star_schemas(spark):
    for compat in (False, True):
        tables = star.star_tables(
            births(spark, {}), municipalities(spark), occupations(spark), compat=compat
        )
        assert list(tables) == list(STAR)
        for name, df in tables.items():
            found = [(f.name, f.dataType) for f in df.schema]
            assert found == [(f.name, f.dataType) for f in table_schema(name, compat)]


@pytest.mark.parametrize("unique", [False, True])
def test_wide_views_agree(spark, folder, unique):
    clean = q._births(spark, folder)
    cities, jobs = q._municipalities(spark, folder), q._occupations(spark, folder)
    direct = star.births_wide(clean, cities, jobs, unique=unique)
    tables = star.star_tables(clean, cities, jobs, unique=unique)
    joined = star.births_wide_from_star(tables | {RECORDS: star.records(clean, unique)})
    assert set(joined.columns) == set(direct.columns)
    assert rows(joined.select(*direct.columns)) == rows(direct)


def test_a_profile_of_some_columns(spark, folder):
    clean = q._births(spark, folder)
    full = star.birth_profile(clean)
    fact = star.fact_births(clean).columns
    assert star.birth_profile(clean, only=[]).columns == fact
    for name in [c for c in full.columns if c not in fact]:
        assert rows(star.birth_profile(clean, only=[name])) == rows(full.select(*fact, name))


@pytest.mark.parametrize("broadcast", [0, 20])
def test_wide_view_without_broadcast(spark, folder, monkeypatch, broadcast):
    expected = rows(q.births_wide(spark, folder))
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(lookups, "LEAST_HOT", 40)
    assert rows(q.births_wide(spark, folder)) == expected


def test_every_fact_pair_is_in_its_dimension(spark, folder):
    clean = q._births(spark, folder)
    pairs = star.dim_parto_sexo(clean)
    assert star.fact_births(clean).join(pairs, "id_parto_sexo", "left_anti").isEmpty()
    assert pairs.agg(F.min("id_parto_sexo"), F.max("id_parto_sexo"), F.count("*")).first() == (10, 92, 9)


def test_where_compatible_output_differs(spark, folder):
    clean = q._births(spark, folder)
    good = star.fact_births(clean).alias("g")
    compat = star.fact_births(clean, compat=True).alias("c")
    both = good.join(compat, "id_mae").join(clean, F.col("id_mae") == F.col("CONTADOR"))
    counted = both.agg(
        F.count_if(F.col("g.id_calendario").cast("string") != F.col("c.id_calendario")),
        F.count_if(F.dayofmonth("DTNASC").isin(10, 20, 30)),
        F.count_if(~F.col("g.raca_nascidos").eqNullSafe(F.col("c.raca_nascidos"))),
        F.count_if(F.col("CONSULTAS") != F.col("RACACOR")),
    ).first()
    changed_days, days, changed_races, races = counted
    assert changed_days == days > 0
    assert changed_races == races > 0


def test_known_counts(spark):
    counts = {"sf0.001": (1500, 1448, 1041, 71586), "sf0.01": (15000, 14482, 10401, 694373)}
    for folder, known in counts.items():
        path = f"/root/testdata/{folder}"
        clean = q._births(spark, path)
        sample = q.sample_exact(clean, 100, "CONTADOR")
        found = (
            adapter.raw_births(spark, path).count(),
            q.births_dropna(spark, path).count(),
            clean.count(),
            sample.agg(F.sum("CONTADOR")).first()[0],
        )
        assert found == known


@pytest.mark.parametrize("mode", ["append", "append_new_only"])
def test_a_repeated_build(spark, mode):
    raw = births(spark, {}, {"CONTADOR": 2}, {"CONTADOR": 2, "ESCMAE": 6}).drop(*DATE_COLUMNS)
    raw = raw.withColumns({c: F.lit(1011990).cast("bigint") for c in DATE_COLUMNS})
    root = scratch_path(spark, "repeat")
    counts = []
    for _ in range(2):
        build_warehouse(raw, municipalities(spark), occupations(spark), root, mode=mode)
        counts.append({name: df.count() for name, df in read_warehouse(spark, root).items()})
    expected = {
        "dim_municipio": 1, "dim_profissao": 2, "dim_escolaridade": 2, "dim_consultas": 1,
        "dim_parto_sexo": 1, "dim_gestacao": 1, "dim_mae": 3, "fatos_nascidos": 3, "registros": 3,
    }
    assert counts[0] == expected
    factor = 2 if mode == "append" else 1
    assert counts[1] == {name: factor * n for name, n in expected.items()}


def test_lenient_build_stores_the_rejects(spark):
    raw = births(spark, {}, {"CONTADOR": 2}).drop(*DATE_COLUMNS)
    spoiled = F.when(F.col("CONTADOR") == 2, 32011990).otherwise(1011990).cast("bigint")
    raw = raw.withColumns({"DTNASC": spoiled, "DTNASCMAE": F.lit(1011990).cast("bigint")})
    root = scratch_path(spark, "lenient")
    with pytest.raises(UnreadableBirths, match="1 rows.*unreadable DTNASC: 32011990"):
        build_warehouse(raw, municipalities(spark), occupations(spark), root)
    assert not path_exists(spark, f"{root}/dw")
    build_warehouse(raw, municipalities(spark), occupations(spark), root, strict=False)
    rejected = spark.read.parquet(f"{root}/silver/births_rejected").collect()
    assert [(r["CONTADOR"], r["DTNASC"], r["motivo"]) for r in rejected] == [("2", "32011990", "DTNASC")]
    assert read_warehouse(spark, root)["fatos_nascidos"].count() == 1


def test_reports_on_a_stored_warehouse(spark, folder):
    tables = read_warehouse(spark, q._stored_warehouse(spark, folder))
    wide = star.births_wide_from_star(tables)
    regions = adapter.ADAPTER_REGIONS
    found = {
        "report_month_vs_average": reports.births_by_month(tables["fatos_nascidos"]),
        "report_region": reports.births_by_region(wide, tables["dim_municipio"], regions),
        "report_occupation": reports.births_by_occupation(wide, tables["dim_profissao"]),
        "report_age_children": reports.children_by_age(wide),
        "report_delivery_by_race": reports.deliveries_by_race(wide),
    }
    for name, df in found.items():
        assert rows(df) == rows(q.QUERIES[name](spark, folder))


def test_keys_are_the_first_columns():
    assert STAR_KEYS["dim_mae"] == STAR_KEYS["fatos_nascidos"] == "id_mae"


def test_a_record_key_on_many_births_is_spread(spark, monkeypatch):
    """A third of the facts share one record key; each stays one row, in no single task."""
    days = F.date_add(F.lit(DAY(2000, 1, 1)), F.col("id").cast("int"))
    shared = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    fact = spark.range(3000).select(shared.alias("id_mae"), days.alias("id_calendario"))
    mothers = fact.select("id_mae", F.lit("Parda").alias("raca_mae")).distinct()
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 100)
    monkeypatch.setattr(lookups, "LEAST_HOT", 100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookups.attach(fact, mothers, "id_mae", unique=True)
        assert joined.filter("raca_mae = 'Parda'").count() == 3000
        hot = joined.filter("id_mae = 0").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(hot) == 4
    assert max(row["count"] for row in hot) < 1000 / 4 * 1.4
