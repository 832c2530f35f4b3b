"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is an aggregation and a join on the larger or smaller end, so neither links nor
components reach the driver. Each round is written to the shared folder.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorflow.sources.scratch import materialise


def spanning_links(n: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each of ``n`` places to the least place of its component under the pairs x, y."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, x, root[y])
        np.minimum.at(new, y, root[x])
        new = np.minimum(new, new[new])
        if (new == root).all():
            break
        root = new
    far = np.flatnonzero(root != np.arange(n))
    return far, root[far]


def _links(df: DataFrame) -> DataFrame:
    return (
        df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def _state(df: DataFrame) -> tuple:
    mark = F.xxhash64("a", "b")
    return tuple(df.agg(F.count(F.lit(1)), F.sum(mark.cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (least id reachable) of each id in ``links`` (long ``a``, ``b``).

    Repeated links, links in either direction and links of an id with itself are allowed; rows
    with a null end are ignored. Ids whose only link is with themselves and ids without links are
    absent. An empty table gives an empty table.
    """
    edges = materialise(_links(links.select("a", "b").dropna()), "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        edges = materialise(
            _links(
                small.filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
                .unionByName(low.select("a", F.col("low").alias("b")))
            ),
            "links",
        )
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("id")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )
