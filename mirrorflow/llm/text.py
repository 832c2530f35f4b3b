"""Column expressions on words and positions that several operators use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Runs of anything but space and the characters 9 to 13; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def _summed(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda acc, x: acc + x)


def prefix_sums(numbers: Column) -> Column:
    """Inclusive running sums of an array of longs, in blocks of about the root of its size.

    ``numbers`` is used several times and should be a column, not an expensive expression.
    """
    n = F.size(numbers)
    width = F.ceil(F.sqrt(n)).cast("int")

    def block(b: Column) -> Column:
        return F.slice(numbers, b * width + 1, width)

    def run(b: Column, before: Column) -> Column:
        return F.transform(block(b), lambda _, j: before + _summed(F.slice(block(b), F.lit(1), j + 1)))

    blocks = F.sequence(F.lit(0), F.floor((n - 1) / width).cast("int"))
    totals = F.transform(blocks, lambda b: _summed(block(b)))
    running = F.flatten(
        F.transform(blocks, lambda b: run(b, _summed(F.slice(totals, F.lit(1), b))))
    )
    return F.when(n > 0, running).otherwise(F.expr("array()").cast("array<bigint>"))
