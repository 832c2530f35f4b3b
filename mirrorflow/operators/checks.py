"""Data-quality checks and row accounting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorflow.functions import semantics as S
from mirrorflow.operators import flows as FL


class CheckFailed(ValueError):
    """A table breaks a rule the next step relies on."""


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per year: rows and distinct keys."""
    per_key = df.groupBy("year", *[k for k in keys if k != "year"]).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("year").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys")
    )


def assert_empty(df: DataFrame, message: str) -> None:
    """Raise if ``df`` has any row; the first few are shown."""
    found = df.limit(5).collect()
    if found:
        raise CheckFailed(f"{message}: {[r.asDict() for r in found]}")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    assert_empty(repeated_keys(df, keys), f"{', '.join(keys)} not unique")


def remaining_share(
    mirror_old: DataFrame, mirror_new: DataFrame, crosswalk: DataFrame, passes: Column | None = None
) -> DataFrame:
    """Per year: mirror rows, rows left after the kilogram filter and conversion, their share.

    Both counts come from one pass: a converted group is left if any of its rows passes the
    filter. Gravity joins, which drop more rows, are not part of the share. ``passes`` says whether a
    row passes where the mirror rows do not hold what the filter looks at.
    """
    passes = F.coalesce(FL.kg_condition() if passes is None else passes, F.lit(False))
    n = F.count(F.lit(1))

    old = (
        FL.to_new_codes(mirror_old, crosswalk)
        .groupBy(*FL.TRAINING_GROUP)
        .agg(n.alias("n"), F.max(passes).alias("left"))
        .groupBy("year")
        .agg(F.sum("n").alias("n_total"), F.count_if("left").alias("n_remaining"))
    )
    new = mirror_new.groupBy("year").agg(n.alias("n_total"), F.count_if(passes).alias("n_remaining"))
    both = old.unionByName(new)
    return both.withColumn(
        "prop_rows_after_filtering", S.ieee_div("n_remaining", "n_total")
    )


def remaining_share_of(mirror: DataFrame, remaining: DataFrame) -> DataFrame:
    """The same share from two tables already at hand."""
    a = mirror.groupBy("year").agg(F.count(F.lit(1)).alias("n_total"))
    b = remaining.groupBy("year").agg(F.count(F.lit(1)).alias("n_remaining"))
    both = a.join(b, "year", "left").select(
        "year", "n_total", F.coalesce("n_remaining", F.lit(0).cast("long")).alias("n_remaining")
    )
    return both.withColumn("prop_rows_after_filtering", S.ieee_div("n_remaining", "n_total"))
