"""Places of rows in a sorted table, without sorting it in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mirrorflow.sources.scratch import materialise

Stage = Callable[[DataFrame, str], DataFrame]

_SHIFT = 33  # monotonically increasing ids count from 0 in each partition, whose number stands above


def add_position(df: DataFrame, order: Sequence[str], name: str, stage: Stage = materialise) -> DataFrame:
    """``df`` with ``name``, the place of each row in ascending ``order`` (null first), from 0 without gaps.

    Rows are cut into ranges of the order, sorted within each, and written with their place there; the
    numbers of rows of the ranges before, a row per range, give the rest. Rows alike in ``order`` take
    adjacent places in any order.
    """
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = stage(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()),
        "positions",
    )
    part = F.shiftright("_id", _SHIFT)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")  # as many rows as ranges
    starts = stage(sizes.select("_part", before.alias("_before")), "range_starts")
    place = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    return rows.withColumn("_part", part).join(starts, "_part").withColumn(name, place).drop("_part", "_id", "_before")
