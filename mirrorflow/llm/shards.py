"""Shards along a Hilbert curve through several metadata dimensions.

Each dimension is quantised to ranks, the ranks are interleaved to an index along the curve, and the
rows in the order of that index are cut into runs of equal length. Rows of a shard are then near
each other in every dimension, so the least and largest values per file rule most files out.
Ranks, of values and of rows, come from range partitions and their sizes; nothing is sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorflow.sources.scratch import materialise

BITS = 10
_PART_ROWS = (1 << 33) - 1
NEW = ("curve", "shard", "slot")


def ranked(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``name``, the place of each row in ``order``, from 0 without gaps."""
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = materialise(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "ranked",
    )
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    starts = materialise(sizes.select("_part", before.alias("_start")), "part_starts")
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit(_PART_ROWS))
    return (
        rows.withColumn("_part", part).join(starts, "_part").withColumn(name, place)
        .drop("_part", "_at", "_start")
    )


def quantised(df: DataFrame, dimension: str, name: str, bits: int) -> DataFrame:
    """``df`` with ``name``, the rank of its value among the distinct values, spread over ``bits``
    bits; null counts as the least value."""
    values = ranked(df.select(F.col(dimension).alias("_value")).distinct(), ["_value"], "_rank")
    values = materialise(values, "values")
    n = max(1, values.count())
    code = F.floor(F.col("_rank") * F.lit(float(1 << bits)) / F.lit(float(n))).cast("long")
    values = values.select("_value", code.alias(name))
    return df.join(values, F.col(dimension).eqNullSafe(F.col("_value"))).drop("_value")


def curve_index(coordinates: np.ndarray, bits: int) -> np.ndarray:
    """Index along a Hilbert curve of points, one row each, with coordinates below 2**bits.

    Goes from the highest bit down, undoing at each level the turns of the curve, and reads the
    index off the Gray code that is left.
    """
    x = coordinates.astype(np.int64).copy()
    n = x.shape[1]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for d in range(n):
            turned = (x[:, d] & bit) != 0
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] ^= np.where(turned, low, swap)
            x[:, d] ^= swap
    for d in range(1, n):
        x[:, d] ^= x[:, d - 1]
    flip = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[:, n - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flip[:, None]
    index = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for d in range(n):
            index = (index << 1) | ((x[:, d] >> level) & 1)
    return index


def _index(columns: Sequence[str], bits: int) -> Column:
    @F.pandas_udf("long")
    def index(*codes: pd.Series) -> pd.Series:
        return pd.Series(curve_index(np.stack([c.to_numpy() for c in codes], axis=1), bits))

    return index(*[F.col(c) for c in columns])


def _apart(names: Sequence[str], new: Sequence[str]) -> list[str]:
    """``names``, with underscores appended to those that are among ``new``, in any case."""
    taken = {n.lower() for n in (*names, *new)}
    out = []
    for name in names:
        if name.lower() in new:
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
        out.append(name)
    return out


def hilbert_shards(
    rows: DataFrame, dimensions: Sequence[str], tie: str, shards: int, bits: int = BITS
) -> DataFrame:
    """``rows`` with ``curve``, ``shard`` (from 0) and ``slot`` (from 0 in each shard).

    The law is that of row counts: shards differ by one row at most, and with fewer rows than
    shards some stay empty. Rows at the same place of the curve follow ``tie``; a null dimension
    is its least value, and rows alike in ``tie`` too stand in any order. An empty table gives
    an empty table. Columns of ``rows`` may have any names that differ: one that bears a new name
    gets underscores appended until it differs from all. ``dimensions`` times ``bits`` is 62 at most.
    """
    if len(dimensions) * bits > 62:
        raise ValueError("the index of the curve has to fit a long")
    codes = [f"_code{i}" for i in range(len(dimensions))]
    own = {c: f"column{i}" for i, c in enumerate(rows.columns)}
    coded, tie = rows.toDF(*own.values()), own[tie]
    for dimension, code in zip([own[d] for d in dimensions], codes):
        coded = quantised(coded, dimension, code, bits)
    coded = coded.withColumn("curve", _index(codes, bits)).drop(*codes)
    placed = ranked(coded, ["curve", tie], "_place")
    total = max(1, rows.count())
    shard = F.expr(f"(_place * {shards}) div {total}")
    first = F.expr(f"(shard * {total} + {shards} - 1) div {shards}")
    placed = placed.withColumn("shard", shard).withColumn("slot", F.col("_place") - first)
    names = _apart(rows.columns, NEW)
    return placed.select(*[F.col(c).alias(n) for c, n in zip(own.values(), names)], *NEW)


def write_shards(rows: DataFrame, path: str, shards: int) -> None:
    """Write sharded rows below ``path``, a folder for each shard, in the order of their slots."""
    (
        rows.repartitionByRange(shards, "shard")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
