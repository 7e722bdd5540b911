"""What the physical plans must and must not contain."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from bercario.catalog import queries as q
from bercario.operators import lookups
from bercario.operators.cleaning import assessed_births, clean_births, rejected_births
from bercario.operators.lookups import attach
from bercario.plans import reports, star
from bercario.schemas import BIRTH_COLUMNS
from bercario.sources import adapter
from bercario.sources.delimited import read_births

# The JVM only interprets, and never compiles, a method with more bytes of code than this.
JIT_LIMIT = 8_000

STORING = ("sink_", "warehouse_", "silver_", "land_", "dimension_key_check", "births_total_by_view")


def explained(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def shuffles(df):
    return re.findall(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning)", explained(df))


def largest_method(spark, df):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = df.select("*")
        return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", explained(again, "codegen"))))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("name", [n for n in q.QUERIES if not n.startswith(STORING)])
def test_plans_are_native_and_without_pairs(spark, folder, name):
    df = q.QUERIES[name](spark, folder)
    assert not re.search(r"Python|ArrowEval|MapInPandas|NestedLoop|Cartesian", explained(df))
    assert largest_method(spark, df) < JIT_LIMIT


def test_cleaning_of_text_files_is_compiled(spark, tmp_path):
    path = tmp_path / "births.csv"
    path.write_text(";".join(BIRTH_COLUMNS) + "\n")
    texts = read_births(spark, str(path))
    cleaned = (clean_births(texts), clean_births(texts, strict=False), assessed_births(texts))
    for df in (*cleaned, rejected_births(texts)):
        assert largest_method(spark, df) < JIT_LIMIT
        assert shuffles(df) == []


def test_cleaning_does_not_shuffle(spark, folder):
    assert shuffles(clean_births(adapter.raw_births(spark, folder))) == []
    assert shuffles(q._births(spark, folder)) == []


def test_strict_queries_parse_once(spark, folder, monkeypatch):
    """No strict query looks at the raw births before it stores them: one write reads them."""
    from bercario.operators import cleaning

    def looked(raw):
        raise AssertionError("the raw births are read a second time")

    monkeypatch.setattr(cleaning, "require_readable", looked)
    for name in ("births_parsed_dates", "births_filtered", "births_clean", "births_csv_scan", "dim_municipio"):
        files = q.QUERIES[name](spark, folder).inputFiles()
        assert files and not any("orders.parquet" in file or ".csv" in file for file in files)


def test_large_tables_shuffle_once_or_never(spark, folder):
    births = q._births(spark, folder)
    for build in (star.fact_births, star.dim_mae, star.birth_profile):
        assert shuffles(build(births)) == ["hashpartitioning"]
        assert shuffles(build(births, unique=True)) == []


def test_reports_read_few_columns_of_stored_records_and_move_only_counts(spark, folder):
    plan = explained(q.QUERIES["report_education"](spark, folder))
    assert "ReadSchema: struct<ESCMAE:bigint>" in plan
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", plan) == ["escolaridade"]
    for name in (n for n in q.QUERIES if n.startswith("report_") and "filtered" not in n):
        plan = explained(q.QUERIES[name](spark, folder))
        assert "CONTADOR" not in "".join(re.findall(r"Exchange hashpartitioning\(.*", plan))
        assert "orders.parquet" not in plan


def test_a_wide_view_does_not_join_its_large_tables(spark, folder):
    plan = explained(q.births_wide_from_star(spark, folder))
    assert "SortMergeJoin" not in plan and "dim_mae" not in plan
    assert not re.search(r"SortAggregate.*dtnascmae", plan)


def test_scans_are_pruned_and_filtered(spark, folder):
    births = clean_births(adapter.raw_births(spark, folder))
    plan = explained(reports.births_by_visits(star.fact_births(births, unique=True)))
    assert "PushedFilters: [IsNotNull(o_orderkey)" in plan
    assert "o_totalprice" not in plan and "c_name" not in plan and "c_acctbal" not in plan


def test_stored_births_are_read_by_column(spark, folder, tmp_path):
    q._births(spark, folder).write.parquet(str(tmp_path / "births"))
    births = spark.read.parquet(str(tmp_path / "births"))
    assert "ReadSchema: struct<GESTACAO:bigint>" in explained(star.dim_gestacao(births))


def test_reports_count_before_they_join(spark, folder):
    fact = star.fact_births(q._births(spark, folder), unique=True)
    plan = explained(reports.births_by_state_pareto(fact, q._city_labels(spark, folder)))
    # Read from the top: the labels are joined above the count of births per municipality.
    join = plan.index("LeftOuter")
    assert join < plan.index("partial_count(1)")


def test_a_measured_lookup_is_broadcast_and_a_large_one_spread(spark, monkeypatch):
    df = spark.range(100).select("id", (F.col("id") % 5).alias("key"))
    lookup = spark.range(5).select(F.col("id").alias("key"), F.lit("x").alias("label"))
    assert shuffles(attach(df, lookup, "key", unique=True)) == []
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 4)
    monkeypatch.setattr(lookups, "LEAST_HOT", 10)
    spread = explained(attach(df, lookup, "key"))
    # The keys that are frequent are sent to all tasks; the rows are read and moved once.
    assert "BroadcastHashJoin" in spread and "SortMergeJoin" in spread and "Union" not in spread
    assert len(re.findall(r"Range \(0, 100,", spread)) == 1


def test_unused_labels_are_not_joined(spark, folder):
    wide = q.births_wide(spark, folder)
    plan = explained(reports.births_total(wide))
    assert "LeftOuter" not in plan
