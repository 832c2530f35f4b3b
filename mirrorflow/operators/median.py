"""Exact medians per group, without holding a group in one task.

The built-in exact median keeps a map of all distinct values of a group in one task, which a
commodity holding a large part of the rows would overflow. Here a first scan sums up each group in a
mergeable quantile sketch whose ranks are off by a bounded share of the group. It names two values
that bracket the middle ranks. The second scan counts what is below them and orders the distinct values
between them, with their counts, so the result is exact. It also tells whether a bracket has missed; such
groups are looked at again with a wider one, in the end with all their values. The steps are the same for
every size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorflow.functions import semantics as S
from mirrorflow.sources.scratch import materialise

Stage = Callable[[DataFrame, str], DataFrame]

ACCURACY = 500  # ranks of the sketch are off by a group's rows over this
MARGIN = 1.5 / ACCURACY  # of the rows, to either side of the middle
WIDER = 8


def _brackets(rows: DataFrame, keys: Sequence[str], accuracy: int, margin: float) -> DataFrame:
    """Per group its middle ranks ``_lo`` and ``_hi``, and values ``_low`` and ``_high`` about them."""
    n = F.count(F.lit(1))
    marks = F.percentile_approx("_v", [max(0.0, 0.5 - margin), min(1.0, 0.5 + margin)], accuracy)
    ends = [F.min("_v"), F.max("_v")] if margin >= 0.5 else [F.get(marks, F.lit(0)), F.get(marks, F.lit(1))]
    return rows.groupBy(*keys).agg(
        F.floor((n + 1) / 2).alias("_lo"), F.floor((n + 2) / 2).alias("_hi"),
        ends[0].alias("_low"), ends[1].alias("_high"),
    )


def _middle(rows: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per group the values at the middle ranks, NULL where the bracket does not hold them."""
    on = S.same_key("v", "p", [(k, k) for k in keys])
    near = rows.alias("v").join(brackets.alias("p"), on & (F.col("v._v") <= F.col("p._high")))
    # values below the bracket are one, counted and not told apart
    value = F.when(F.col("v._v") >= F.col("p._low"), F.col("v._v"))
    places = [*keys, "_lo", "_hi"]
    values = near.select(*[f"p.{c}" for c in places], value.alias("_v")).groupBy(*places, "_v")
    values = values.agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first()))
    ranked = values.withColumn("_upto", upto).withColumn("_from", F.col("_upto") - F.col("_n"))

    def at(rank: str) -> Column:
        held = (F.col("_from") < F.col(rank)) & (F.col("_upto") >= F.col(rank))
        return F.max(F.when(held, F.col("_v")))

    return ranked.groupBy(*keys).agg(at("_lo").alias("_a"), at("_hi").alias("_z"))


def grouped_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str,
    stage: Stage = materialise,
    accuracy: int = ACCURACY,
    margin: float = MARGIN,
) -> DataFrame:
    """Median of ``value`` per group; NULL and NaN are skipped, infinities count.

    An even count gives the mean of the two middle values; a group without values is absent.
    ``stage`` writes the small tables of brackets and middle values, so that Catalyst knows their sizes.
    The result is exact for any ``accuracy`` and ``margin``; too small ones cost further scans.
    """
    keys = list(keys)
    rows = df.select(*keys, S.nan_to_null(value).alias("_v")).filter(F.col("_v").isNotNull())
    found: list[DataFrame] = []
    pending = rows
    while True:
        brackets = stage(_brackets(pending, keys, accuracy, margin), "median_brackets")
        middle = stage(_middle(pending, brackets, keys), "median_middles")
        found.append(middle.filter("_a is not null and _z is not null"))
        missed = middle.filter("_a is null or _z is null").select(*keys)
        if margin >= 0.5 or missed.isEmpty():
            break
        margin = min(0.5, margin * WIDER)
        again = S.same_key("v", "p", [(k, k) for k in keys])
        pending = rows.alias("v").join(missed.alias("p"), again, "left_semi").select("v.*")
    middle = reduce(DataFrame.unionByName, found)
    mean = F.when(F.col("_a") == F.col("_z"), F.col("_a")).otherwise((F.col("_a") + F.col("_z")) / 2)
    return middle.select(*keys, mean.alias(name))


def add_grouped_median(
    df: DataFrame, keys: Sequence[str], value: str, name: str, stage: Stage = materialise
) -> DataFrame:
    """Write the group's median to each of its rows.

    Joins the table of medians back, instead of a window that would sort whole rows and put
    each group into one task.
    """
    medians = stage(grouped_median(df, keys, value, name, stage), "medians")
    on = S.same_key("d", "g", [(k, k) for k in keys])
    return df.alias("d").join(medians.alias("g"), on, "left").select("d.*", F.col(f"g.{name}"))
