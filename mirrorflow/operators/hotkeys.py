"""Full outer joins that split hot keys.

Spark divides a skewed partition of a left or an inner join, not of a full outer one: there, the rows of a key
on both sides have to meet in one task to tell which are alone. Here a mergeable sketch of frequent items finds the
keys that hold many rows. Their longer side is dealt over salts and left-joined with copies of the shorter one, and
the rows of the shorter one whose key the other side lacks are added; all other keys are joined as usual.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorflow.functions import semantics as S

MAX_HOT = 1000
_TRACKED = 16_384


@dataclass(frozen=True)
class Hot:
    """``mark`` (hash of a key), into how many parts its longer side goes, and which side that is."""

    mark: int
    salts: int
    left: bool


def key_mark(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def frequent_marks(df: DataFrame, keys: Sequence[str], share: float) -> dict[int, int]:
    """Hashes of keys that hold more than about ``share`` of the rows, with their estimated rows.

    The sketch keeps a bounded number of items, is merged over the tasks and overlooks none beyond its error, a
    few ten-thousandths of the rows; ``share`` should be above that. At most ``MAX_HOT`` reach the driver.
    """
    row = df.select(key_mark(keys).alias("m")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(m, {MAX_HOT}, {_TRACKED})").alias("top")
    ).first()
    return {item["item"]: item["count"] for item in row["top"] or [] if item["count"] > share * row["n"]}


def hot_keys(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], parts: int) -> list[Hot]:
    """Keys with more rows on one side than an even part of it holds, and into how many parts they go."""
    sides = []
    for df, keys in ((left, left_keys), (right, right_keys)):
        sides.append(frequent_marks(df, keys, max(1.0 / parts, 2.0 / MAX_HOT)))
    out = []
    for mark in sorted(sides[0].keys() | sides[1].keys()):
        rows = [side.get(mark, 0) for side in sides]
        totals = [max(1, sum(side.values())) for side in sides]
        own = 0 if rows[0] >= rows[1] else 1
        salts = min(parts, 1 + math.ceil(parts * rows[own] / totals[own]))
        out.append(Hot(mark, salts, own == 0))
    return out


def full_join(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], columns: Callable[[str, str], Sequence[Column]],
    parts: int | None = None, hot: Sequence[Hot] | None = None,
) -> DataFrame:
    """``columns("l", "r")`` of the full outer join of the two sides on null-safe equality of the ``pairs``.

    ``parts`` is about how many tasks the join has, by default as many as shuffle partitions; ``hot`` spares
    the pass over both sides that finds the hot keys. Rows of a hot key go to its parts by a hash of all
    their columns. Both sides are read once for each kind of key, so they should be written tables.
    """
    left_keys, right_keys = [a for a, _ in pairs], [b for _, b in pairs]
    spark = left.sparkSession
    if parts is None:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if hot is None:
        hot = hot_keys(left, right, left_keys, right_keys, parts)
    on = S.same_key("l", "r", [(a, b) for a, b in pairs])
    if not hot:
        return left.alias("l").join(right.alias("r"), on, "full").select(*columns("l", "r"))
    table = spark.createDataFrame([(h.mark, h.salts, h.left) for h in hot], "_mark long, _salts int, _left boolean")
    table = F.broadcast(table)  # MAX_HOT rows at most per side

    def marked(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        own = F.xxhash64(*[F.col(c) for c in df.columns])
        return df.withColumns({"_own": key_mark(keys), "_row": own}).join(table, F.col("_own") == F.col("_mark"), "left")

    a, b = marked(left, left_keys), marked(right, right_keys)
    rest = a.filter("_mark is null").alias("l").join(b.filter("_mark is null").alias("r"), on, "full")
    out = [rest.select(*columns("l", "r"))]

    def dealt(long: DataFrame, short: DataFrame, names: tuple[str, str]) -> list[DataFrame]:
        """The longer side with its partners, and the rows of the shorter one that have none."""
        cut = long.withColumn("_salt", F.pmod("_row", F.col("_salts")).cast("int"))
        copies = short.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
        salted = F.col(f"{names[0]}._salt") == F.col(f"{names[1]}._salt")
        met = cut.alias(names[0]).join(copies.alias(names[1]), on & salted, "left")
        keys = left_keys if names[0] == "l" else right_keys
        there = long.select(*keys).distinct()  # partial sums leave a row per hot key and task
        alone = short.alias(names[1]).join(there.alias(names[0]), on, "left_anti")
        nothing = long.limit(0).alias(names[0])
        alone = alone.alias(names[1]).join(nothing, F.lit(False), "left")
        return [met.select(*columns("l", "r")), alone.select(*columns("l", "r"))]

    if any(h.left for h in hot):
        out += dealt(a.filter("_left"), b.filter("_left"), ("l", "r"))
    if any(not h.left for h in hot):
        out += dealt(b.filter("not _left"), a.filter("not _left"), ("r", "l"))
    return reduce(DataFrame.unionByName, out)
