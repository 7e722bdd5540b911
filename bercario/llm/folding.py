"""Folds over long arrays, as column expressions that take time in proportion to the array.

``aggregate`` copies a result that grows with every element. Here it grows in blocks: each element
copies at most its block, and each block the list of blocks before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements of a block. 100,000 elements make 391 blocks.
BLOCK = 256


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def folded(
    items: Column, state: Column, out: str, step: Callable[[Column, Column], tuple[Column, Column]]
) -> Column:
    """What ``step(state, item)`` adds, for each item in order, as one array.

    ``step`` gives an array of type ``out`` to be added, and the next state.
    """

    def add(done: Column, item: Column) -> Column:
        added, after = step(done["state"], item)
        return F.struct(F.concat(done["out"], added).alias("out"), after.alias("state"))

    def over(rows: Column) -> Column:
        def block(done: Column, number: Column) -> Column:
            part = F.slice(rows, number * BLOCK + 1, F.lit(BLOCK))
            nothing = F.struct(F.array().cast(out).alias("out"), done["state"].alias("state"))
            return bound(
                F.aggregate(part, nothing, add),
                lambda made: F.struct(
                    F.concat(done["blocks"], F.array(made["out"])).alias("blocks"), made["state"].alias("state")
                ),
            )

        start = F.struct(F.array().cast(f"array<{out}>").alias("blocks"), state.alias("state"))
        numbers = F.sequence(F.lit(0), F.ceil(F.size(rows) / BLOCK).cast("int") - 1)
        made = F.flatten(F.aggregate(numbers, start, block)["blocks"])
        return F.when(F.size(rows) > 0, made).otherwise(F.array().cast(out))

    return bound(items, over)


def running_sums(numbers: Column) -> Column:
    """For each number of an array of ints, the sum of it and those before."""

    def step(total: Column, number: Column) -> tuple[Column, Column]:
        return F.array(total + number), total + number

    return folded(numbers, F.lit(0), "array<int>", step)


def indices(array: Column) -> Column:
    """0, 1, ... for the elements of an array; none for an empty one."""
    some = F.sequence(F.lit(0), F.size(array) - 1)
    return F.when(F.size(array) > 0, some).otherwise(F.array().cast("array<int>"))
