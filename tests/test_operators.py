"""Sampling, lookups, checks and reports on small frames, skewed ones included."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from bercario.operators import lookups, sampling
from bercario.operators.checks import duplicate_keys, key_summary, orphans, records_unique
from bercario.operators.running import running_totals
from bercario.operators.sampling import sample_exact
from bercario.plans import reports


def numbered(spark, n):
    return spark.range(1, n + 1).select(F.col("id").alias("CONTADOR"), (F.col("id") % 7).alias("x"))


def keys(df):
    return sorted(row["CONTADOR"] for row in df.collect())


def smallest_hashes(n, total, seed):
    def order(k):
        return hashlib.md5(f"{seed}|{k}".encode()).hexdigest()

    return sorted(sorted(range(1, total + 1), key=order)[:n])


@pytest.mark.parametrize("n", [1, 100, 999, 1000])
@pytest.mark.parametrize("few", [0, 3, 50_000])
def test_sample_is_exact_for_every_way_to_find_the_cut(spark, monkeypatch, n, few):
    monkeypatch.setattr(sampling, "_FEW", few)
    population = numbered(spark, 1000)
    assert keys(sample_exact(population, n, "CONTADOR")) == smallest_hashes(n, 1000, 42)


def test_sample_does_not_depend_on_partitions(spark):
    population = numbered(spark, 2000)
    once = keys(sample_exact(population, 300, "CONTADOR", seed=7))
    again = keys(sample_exact(population.repartition(13), 300, "CONTADOR", seed=7))
    assert once == again == smallest_hashes(300, 2000, 7)
    assert once != keys(sample_exact(population, 300, "CONTADOR", seed=8))


def test_sample_larger_than_the_population(spark):
    population = numbered(spark, 10)
    with pytest.raises(ValueError, match="11 rows out of 10"):
        sample_exact(population, 11, "CONTADOR")
    assert sample_exact(population, 11, "CONTADOR", allow_fewer=True).count() == 10
    assert sample_exact(population, 0, "CONTADOR").count() == 0
    with pytest.raises(ValueError, match="-1"):
        sample_exact(population, -1, "CONTADOR")


@pytest.mark.parametrize("n", [1, 2000, 3500, 5999, 6000])
@pytest.mark.parametrize("few", [0, 50_000])
def test_sample_with_a_key_on_half_of_the_rows(spark, monkeypatch, n, few):
    monkeypatch.setattr(sampling, "_FEW", few)
    monkeypatch.setattr(sampling, "_COPIES_PER_ROW", 100)
    hot = spark.range(3000).select(F.lit(5).cast("bigint").alias("CONTADOR"), (F.col("id") % 3).alias("x"))
    population = numbered(spark, 3000).unionByName(hot)
    first = sample_exact(population, n, "CONTADOR")
    assert first.count() == n
    rows = sorted(map(tuple, first.collect()))
    assert rows == sorted(map(tuple, sample_exact(population.repartition(5), n, "CONTADOR").collect()))
    # A sample without replacement has no row more often than the population.
    assert first.exceptAll(population).isEmpty()


def skewed(spark, n=6000):
    """A third of the rows has one key; some keys have no label, some rows no key."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 500)
    return spark.range(n).select(F.col("id").alias("record"), key.cast("bigint").alias("key"))


def labels(spark):
    return spark.range(400).select(F.col("id").alias("key"), F.concat(F.lit("label "), "id").alias("label"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("least", [1, 20, 10**9])
@pytest.mark.parametrize("broadcast", [0, 100, 100_000])
def test_attach_is_a_left_join_either_way(spark, monkeypatch, least, broadcast):
    monkeypatch.setattr(lookups, "LEAST_HOT", least)
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", broadcast)
    left, right = skewed(spark), labels(spark)
    expected = rows(left.join(right, "key", "left").select("record", "key", "label"))
    assert len(expected) == 6000
    twice = right.unionByName(right)
    assert rows(lookups.attach(left, twice, "key")) == expected
    assert rows(lookups.attach(left, right, "key", unique=True)) == expected


@pytest.mark.parametrize("equal", [False, True])
def test_attach_spreads_a_frequent_key(spark, monkeypatch, equal):
    """Rows of a frequent key stay where they are, also if nothing tells them apart."""
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 100)
    monkeypatch.setattr(lookups, "LEAST_HOT", 100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = skewed(spark).select("key") if equal else skewed(spark)
    try:
        joined = lookups.attach(left, labels(spark), "key").filter("key = 7")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        plain = left.join(labels(spark), "key", "left")
        before = [r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) >= 2000 and sum(before) == 6000
    assert len(sizes) == 4 and max(sizes) < 2000 / 4 * 1.2
    assert max(before) > 6000 / 4 * 1.5


def test_attach_broadcasts_only_what_is_small(spark):
    assert lookups.fits_broadcast(labels(spark))
    assert lookups.fits_broadcast(labels(spark).limit(0))
    assert not lookups.fits_broadcast(labels(spark), most_rows=399)
    assert not lookups.fits_broadcast(labels(spark), most_bytes=400)


def test_frequent_keys(spark, monkeypatch):
    monkeypatch.setattr(lookups, "LEAST_HOT", 100)
    hot = lookups.frequent_keys(skewed(spark), "key")
    assert [row["key"] for row in hot.collect()] == [7]


@pytest.mark.parametrize("n", [1, 3, 5, 9])
def test_sample_of_rows_that_differ_by_microseconds(spark, n):
    times = spark.range(10).select(
        F.lit(1).cast("bigint").alias("CONTADOR"), F.expr("timestamp_micros(1000000 + id)").alias("t")
    )
    assert sample_exact(times, n, "CONTADOR").distinct().count() == n


def test_one_row_per_key_keeps_labels_of_one_row(spark):
    df = spark.createDataFrame(
        [(1, "b", "x"), (1, "a", "z"), (2, "c", None)], "k BIGINT, city STRING, state STRING"
    )
    assert rows(lookups.one_row_per_key(df, "k")) == [(1, "a", "z"), (2, "c", None)]


def test_key_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id_mae BIGINT")
    assert rows(duplicate_keys(df, "id_mae")) == [(1, 2)]
    assert rows(key_summary({"dim_mae": df})) == [("dim_mae", 3, 2, 1)]
    empty = key_summary({"dim_mae": df.limit(0)})
    assert rows(empty) == [("dim_mae", 0, 0, 0)]
    dimension = spark.createDataFrame([(2,)], "id BIGINT")
    assert rows(orphans(df, "id_mae", dimension, "id")) == [(1, 2)]
    records = df.withColumnRenamed("id_mae", "CONTADOR")
    assert not records_unique(records)
    assert records_unique(records.distinct())


def test_filters(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), (None, 2)], "x STRING, y INT")
    assert rows(reports.apply_filters(df, {})) == rows(df)
    assert rows(reports.apply_filters(df, {"x": ["a", "b"], "y": [1]})) == [("a", 1), ("b", 1)]
    assert rows(reports.apply_filters(df, {"x": ["a", None]})) == rows(df.filter("x = 'a' OR x IS NULL"))
    assert rows(reports.apply_filters(df, {"x": [None]})) == [(None, 2)]
    assert rows(reports.apply_filters(df, {"x": []})) == []


def test_employment_takes_a_list_or_a_frame(spark):
    births = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id_codocupmae BIGINT")
    expected = [(False, 3), (True, 1)]
    assert rows(reports.births_by_employment(births, [2, 3])) == expected
    frame = spark.createDataFrame([(2,), (3,), (3,)], "code BIGINT")
    assert rows(reports.births_by_employment(births, frame)) == expected
    assert rows(reports.births_by_employment(births, [])) == [(True, 4)]


def test_pareto(spark):
    births = spark.createDataFrame([(c,) for c in [1] * 5 + [2] * 3 + [3] * 3 + [9]], "id_codmunnasc BIGINT")
    cities = spark.createDataFrame(
        [(1, "a", "SP"), (1, "a again", "SP"), (2, "b", "RJ"), (3, "c", "MG")],
        "id_codmunicipionasc BIGINT, cidade STRING, estado STRING",
    )
    found = reports.births_by_state_pareto(births, cities).orderBy("acumulado").collect()
    assert [(r["estado"], r["nascimentos"]) for r in found] == [
        ("SP", 5), ("MG", 3), ("RJ", 3), ("Desconhecido", 1),
    ]
    assert [r["acumulado"] for r in found] == [5 / 12, 8 / 12, 11 / 12, 1.0]


def test_months_against_the_mean(spark):
    births = spark.createDataFrame(
        [(d,) for d in ["2022-01-05", "2022-01-31", "2022-01-10", "2022-02-01", "2022-03-01", "2022-03-02"]],
        "d STRING",
    ).select(F.col("d").cast("date").alias("id_calendario"))
    months = reports.births_by_month(births).collect()
    found = {str(r["mes"]): (r["nascimentos"], r["situacao"]) for r in months}
    assert found == {"2022-01-01": (3, "acima"), "2022-02-01": (1, "abaixo"), "2022-03-01": (2, "igual")}


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("many", [0, 1, 500])
def test_running_totals_equal_plain_ones(spark, many, adaptive):
    rng = random.Random(many)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    found = [(i if i % 9 else None, rng.choice([0, 1, 1, 7, 50, -3])) for i in range(many)][: max(many, 1)]
    found = [row for at, row in enumerate(found) if row[0] is not None or at == 0]
    df = spark.createDataFrame(found, "code BIGINT, n BIGINT").repartition(5)
    order = [F.desc("n"), F.asc_nulls_last("code")]
    spark.conf.set(setting, adaptive)
    try:
        got = [tuple(r) for r in running_totals(df, "n", order).orderBy(*order).collect()]
    finally:
        spark.conf.set(setting, "true")
    ranked = sorted(found, key=lambda r: (-r[1], r[0] is None, r[0]))
    total = sum(n for _, n in found)
    expected, so_far = [], 0
    for code, n in ranked:
        so_far += n
        expected.append((code, n, so_far, total))
    assert got == expected


def test_no_task_sees_all_rows_of_a_running_total(spark):
    """The only window without partition is over the sums of the ranges."""
    df = spark.range(1_000).select(F.col("id").alias("code"), (F.col("id") % 7).alias("n"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        totals = running_totals(df, "n", [F.desc("n"), F.asc("code")])
    finally:
        spark.conf.set(setting, "true")
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    for window in re.findall(r"Window \[[^\n]*", plan):
        assert "_sum" in window or "_range" in window.split("], [")[1]
    sizes = spark.read.parquet(totals.inputFiles()[0].rsplit("/", 1)[0]).groupBy("_range").count().collect()
    assert len(sizes) >= 2 and max(r["count"] for r in sizes) < 900
