"""Folds over long arrays against plain loops."""

import itertools

import pytest
from pyspark.sql import functions as F

from bercario.llm import folding


@pytest.mark.parametrize("many", [0, 1, 255, 256, 257, 1_000])
def test_running_sums(spark, many):
    numbers = [(7 * i) % 13 for i in range(many)]
    df = spark.createDataFrame([(numbers,)], "numbers array<int>")
    assert df.select(folding.running_sums(F.col("numbers"))).first()[0] == list(itertools.accumulate(numbers))
    assert df.select(folding.indices(F.col("numbers"))).first()[0] == list(range(many))


def test_a_fold_that_keeps_some(spark):
    """Of numbers, those above the last one kept."""
    numbers = [(i * 37) % 1_009 for i in range(900)]
    df = spark.createDataFrame([(numbers,)], "numbers array<int>")

    def step(last, number):
        kept = F.when(number > last, F.array(number)).otherwise(F.array().cast("array<int>"))
        return kept, F.greatest(last, number)

    got = df.select(folding.folded(F.col("numbers"), F.lit(-1), "array<int>", step)).first()[0]
    best = list(itertools.accumulate(numbers, max))
    assert got == sorted(set(best))
