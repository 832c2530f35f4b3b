"""Exact near-duplicate vectors by cover trees and dual traversal.

Equal vectors form one class. The classes of a label are divided among pivots drawn from them, the
cells of pivots that are still too large among further pivots, and so on, until every cell is a
block of bounded size. Cells know their pivot and covering radius, so they form a tree as well:
pairs of cells are followed down it and dropped where the distance of the pivots exceeds both radii and the
threshold together. What remains are pairs of blocks. Each block has one cover tree (nested levels
with halving radii), built once from distances to its chosen centres only; a task walks down
two of them at once, dropping node pairs by the same bound, and compares exactly what is left at
the leaves. A task returns the number of links per class and links that span the components,
never all pairs.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorflow.llm.batches import bounded_batches
from mirrorflow.llm.components import connected_components, spanning_links
from mirrorflow.sources.scratch import materialise

BLOCK_ROWS = 1024
FANOUT = 256  # pivots of one cell at most
SALT_ROWS = 8192  # rows of a cell that are placed together
MAX_TURNS = 8  # divisions by pivots; cells that are still too large are cut by hash
LEAF = 16
_SLACK = 1e-6  # distances near 0 come from cosines near 1 and keep half their digits


def threshold_distance(cosine: float) -> float:
    """Distance on the unit sphere that belongs to a cosine, with room for rounding."""
    return math.sqrt(max(0.0, 2 - 2 * cosine)) + _SLACK


def distances(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * cosines))


@dataclass
class CoverTree:
    """Nodes of the tree over the rows of ``unit``: centre, covering radius, children, members of leaves.

    Children of a node have centres more than ``reach`` apart and members within ``reach`` of
    their centre, ``reach`` being a power of two below the node's radius. A node stays a leaf if its
    children would be more than half as many as its members: there would be nothing to prune in bulk.
    ``computed`` counts the distances that were formed.
    """

    unit: np.ndarray
    centre: list[int] = field(default_factory=list)
    radius: list[float] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    members: list[np.ndarray] = field(default_factory=list)
    reach: list[float] = field(default_factory=list)
    computed: int = 0

    def __post_init__(self) -> None:
        rows = np.arange(len(self.unit))
        far = self._from(0, rows)
        work = [(self._node(0, rows, far, 2.0), far)]
        while work:
            node, far = work.pop()
            rest, centre, reach = self.members[node], self.centre[node], self.reach[node] / 2
            if len(rest) <= LEAF or self.radius[node] <= _SLACK:
                continue
            while reach >= self.radius[node]:
                reach /= 2
            parts = []
            while len(rest) and 2 * len(parts) <= len(self.members[node]):
                near = far <= reach
                parts.append((centre, rest[near], far[near]))
                rest = rest[~near]
                if len(rest):
                    centre = int(rest[0])
                    far = self._from(centre, rest)
            if len(rest):
                continue
            for centre, near, far in parts:
                child = self._node(centre, near, far, reach)
                self.children[node].append(child)
                work.append((child, far))
            self.members[node] = self.members[node][:0]

    def _from(self, centre: int, rows: np.ndarray) -> np.ndarray:
        self.computed += len(rows)
        far = distances(self.unit[rows] @ self.unit[centre])
        far[rows == centre] = 0.0
        return far

    def _node(self, centre: int, members: np.ndarray, far: np.ndarray, reach: float) -> int:
        self.centre.append(centre)
        self.radius.append(float(far.max()))
        self.children.append([])
        self.members.append(members)
        self.reach.append(reach)
        return len(self.centre) - 1


def _product(a: list, b: list) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of the entries of ``a[i]`` and ``b[i]``, for every i, as two arrays."""
    na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    if not len(na) or not (na * nb).sum():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    flat_a, flat_b = np.concatenate(a).astype(np.int64), np.concatenate(b).astype(np.int64)
    start_a, start_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    pair = np.repeat(np.arange(len(na)), na * nb)
    inner = np.arange(len(pair)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
    return flat_a[start_a[pair] + inner // nb[pair]], flat_b[start_b[pair] + inner % nb[pair]]


def _close_members(left: CoverTree, right: CoverTree, i: np.ndarray, j: np.ndarray, cosine: float):
    """Members of the leaves ``i`` and ``j`` that may have the cosine: one product per leaf of ``left``."""
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    for a, partners in zip(np.unique(i), np.split(j, np.flatnonzero(np.diff(i)) + 1)):
        own = left.members[a]
        others = np.concatenate([right.members[b] for b in partners])
        x, y = np.nonzero(left.unit[own] @ right.unit[others].T >= cosine - _SLACK)
        yield np.stack([own[x], others[y]])


def dual_pairs(left: CoverTree, right: CoverTree, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``left`` and ``right`` with the cosine or more; each pair once if they are one tree."""
    own, limit = left is right, threshold_distance(cosine)
    (ca, ra), (cb, rb) = [(np.array(t.centre), np.array(t.radius)) for t in (left, right)]
    leaf_a, leaf_b = [np.array([not k for k in t.children]) for t in (left, right)]
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    found = [np.empty((2, 0), np.int64)]
    while len(i):
        cosines = np.einsum("nd,nd->n", left.unit[ca[i]], right.unit[cb[j]])
        keep = distances(cosines) <= ra[i] + rb[j] + limit
        i, j = i[keep], j[keep]
        leaves = leaf_a[i] & leaf_b[j]
        if leaves.any():
            found += _close_members(left, right, i[leaves], j[leaves], cosine)
        i, j = i[~leaves], j[~leaves]
        i, j = _product([left.children[a] or [a] for a in i], [right.children[b] or [b] for b in j])
        if own:
            once = np.unique(np.minimum(i, j) * len(ca) + np.maximum(i, j))
            i, j = once // len(ca), once % len(ca)
    x, y = np.concatenate(found, axis=1)
    if own:
        once = np.unique(np.minimum(x, y) * len(left.unit) + np.maximum(x, y))
        x, y = once // len(left.unit), once % len(left.unit)
        x, y = x[x != y], y[x != y]
    close = np.concatenate(
        [
            np.einsum("nd,nd->n", left.unit[x[k : k + 65536]], right.unit[y[k : k + 65536]]) >= cosine
            for k in range(0, len(x), 65536)
        ]
        or [np.empty(0, bool)]
    )
    return x[close], y[close]


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(float)
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _to_nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a cell, after the cell's pivots, under the cell of the nearest of them."""
    key, numbers, centres = None, [], []
    for batch in batches:
        for cell, part in batch.groupby(["cell", "salt"], sort=False):
            if cell != key:
                key, numbers, centres = cell, [], []
            unit = _unit(np.stack(part["vector"].to_numpy()))
            head = (part["side"] == 0).to_numpy()
            if head.any():
                numbers.append(part["bucket"].to_numpy()[head])
                centres.append(unit[head])
            part, unit = part[~head], unit[~head]
            if not len(part):
                continue
            number = np.concatenate(numbers)
            cosines = unit @ np.concatenate(centres).T
            best = cosines.argmax(axis=1)
            if part["flat"].iloc[0]:
                places = {b: k for k, b in enumerate(number)}
                best = np.array([places[b] for b in part["bucket"]])
            yield pd.DataFrame(
                {
                    "rep": part["rep"].to_numpy(),
                    "n": part["n"].to_numpy(),
                    "cell": [f"{cell[0]}/{b}" for b in number[best]],
                    "far": distances(cosines[np.arange(len(part)), best]),
                    "vector": part["vector"].to_numpy(),
                }
            )


def _divided(rows: DataFrame, sizes: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the cells in ``sizes`` under new cells, and these: ``node``, ``parent``, ``vector``.

    Cells of one direction, and all cells after ``MAX_TURNS``, are cut by hash. A cell's rows are dealt
    over salts, and its pivots sent to each, so no cell is one task.
    """
    mark = F.xxhash64("rep", "vector", F.lit(turn))
    rows = rows.join(sizes, "cell").withColumn(
        "bucket",
        F.pmod(mark, F.least(F.lit(FANOUT), F.greatest(F.lit(2), F.ceil(F.col("rows") * 2 / BLOCK_ROWS)))),
    )
    first = rows.groupBy("cell", "bucket").agg(F.min("rep").alias("rep"))
    pivots = rows.join(first, ["cell", "bucket", "rep"]).dropDuplicates(["cell", "bucket"])
    pivots = materialise(pivots.select("cell", "bucket", "vector", "rows"), "pivots")
    salts = F.ceil(F.col("rows") / SALT_ROWS)
    flat = (F.col("radius") <= _SLACK) | F.lit(turn >= MAX_TURNS)
    data = rows.select(
        "cell", F.pmod(F.xxhash64("rep", "vector"), salts).alias("salt"), F.lit(1).alias("side"),
        "bucket", "rep", "n", "vector", F.coalesce(flat, F.lit(False)).alias("flat"),
    )
    heads = pivots.select(
        "cell", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), F.lit(0).alias("side"),
        "bucket", F.lit(0).cast("long").alias("rep"), F.lit(0).cast("long").alias("n"), "vector",
        F.lit(False).alias("flat"),
    )
    both = heads.unionByName(data).repartition("cell", "salt").sortWithinPartitions("cell", "salt", "side")
    kind = rows.schema["vector"].dataType.simpleString()
    placed = both.mapInPandas(_to_nearest, f"rep long, n long, cell string, far double, vector {kind}")
    nodes = pivots.select(F.concat_ws("/", "cell", "bucket").alias("node"), F.col("cell").alias("parent"), "vector")
    return materialise(placed, "placed"), nodes


def _blocks(classes: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Classes under their block (``cell``), the tree of cells, and its height.

    A node has ``node``, ``parent`` (null for the cell of a whole group), ``vector`` (its pivot),
    ``radius`` and ``whole``: whether it is a block.
    """
    rows = classes.select("rep", "n", F.sha2("grp", 256).alias("cell"), F.lit(None).cast("double").alias("far"), "vector")
    done, tree, turn = [], [], 0
    nodes = rows.groupBy("cell").agg(F.any_value("vector").alias("vector"))
    nodes = nodes.select(F.col("cell").alias("node"), F.lit(None).cast("string").alias("parent"), "vector")
    while True:
        sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.max("far").alias("radius"))
        sizes = materialise(sizes, "cells")
        whole = F.col("rows") <= BLOCK_ROWS
        known = sizes.select(F.col("cell").alias("node"), "radius", whole.alias("whole"))
        tree.append(nodes.join(known, "node"))
        done.append(rows.join(sizes.filter(whole).select("cell"), "cell").select("cell", "rep", "n", "vector"))
        large = sizes.filter(~whole)
        if large.isEmpty():
            break
        rows, nodes = _divided(rows, large, turn)
        turn += 1
    for more in done[1:]:
        done[0] = done[0].unionByName(more)
    for more in tree[1:]:
        tree[0] = tree[0].unionByName(more)
    return done[0], materialise(tree[0], "cell_tree"), turn


def _children_pairs(limit: float):
    """For pairs of cells, with the children of both: pairs of children that can hold a link."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for x, y, kids_x, kids_y in batch[["x", "y", "kids_x", "kids_y"]].itertuples(index=False, name=None):
                (a, ra, wa, ua), (b, rb, wb, ub) = [
                    (
                        [k["node"] for k in kids],
                        np.array([k["radius"] for k in kids], float),
                        np.array([k["whole"] for k in kids], bool),
                        _unit(np.stack([k["vector"] for k in kids])),
                    )
                    for kids in (kids_x, kids_y)
                ]
                near = distances(ua @ ub.T) <= ra[:, None] + rb[None, :] + limit + _SLACK
                i, j = np.nonzero(np.triu(near) if x == y else near)
                if len(i):
                    yield pd.DataFrame(
                        {
                            "x": [a[k] for k in i], "y": [b[k] for k in j],
                            "whole": wa[i] & wb[j],
                        }
                    )

    return run


def _block_pairs(tree: DataFrame, height: int, cosine: float) -> DataFrame:
    """Pairs ``x``, ``y`` of blocks that can hold a link, each pair once, by descent from the groups."""
    kid = F.struct("node", F.coalesce("radius", F.lit(2.0)).alias("radius"), "whole", "vector")
    below = tree.filter("parent is not null").select("parent", kid.alias("kid"))
    # a block stands for itself until its partner is one; a cell has FANOUT children at most
    below = below.unionByName(
        tree.filter("whole and parent is not null").select(F.col("node").alias("parent"), kid.alias("kid"))
    )
    families = materialise(below.groupBy("parent").agg(F.array_sort(F.collect_list("kid")).alias("kids")), "families")
    pairs = tree.filter("parent is null").select(F.col("node").alias("x"), F.col("node").alias("y"), "whole")
    found = pairs.filter("whole").select("x", "y")
    for _ in range(height):
        sides = [families.select(F.col("parent").alias(c), F.col("kids").alias(f"kids_{c}")) for c in ("x", "y")]
        sent = pairs.filter("not whole").select("x", "y").join(sides[0], "x").join(sides[1], "y")
        run = _children_pairs(threshold_distance(cosine))
        pairs = materialise(sent.mapInPandas(run, "x string, y string, whole boolean"), "cell_pairs")
        found = found.unionByName(pairs.filter("whole").select("x", "y"))
    return found


def _trees(blocks: DataFrame) -> DataFrame:
    """One row per block: its classes, their vectors and their cover tree, pickled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []

        def finished() -> pd.DataFrame:
            vectors = np.stack([h[3] for h in held])
            tree = CoverTree(_unit(vectors))
            nodes = (tree.centre, tree.radius, tree.children, tree.members, tree.reach)
            ids, weights = np.array([h[1] for h in held], np.int64), np.array([h[2] for h in held], np.int64)
            return pd.DataFrame({"cell": [held[0][0]], "tree": [pickle.dumps((ids, weights, vectors, nodes))]})

        for batch in batches:
            for row in batch[["cell", "rep", "n", "vector"]].itertuples(index=False, name=None):
                if held and row[0] != held[0][0]:
                    yield finished()
                    held = []
                held.append(row)
        if held:
            yield finished()

    ordered = blocks.repartition("cell").sortWithinPartitions("cell", "rep")
    return ordered.mapInPandas(run, "cell string, tree binary")


def _loaded(data: bytes) -> tuple[np.ndarray, np.ndarray, CoverTree]:
    ids, weights, vectors, nodes = pickle.loads(data)
    tree = CoverTree.__new__(CoverTree)
    tree.unit = _unit(vectors)
    tree.centre, tree.radius, tree.children, tree.members, tree.reach = nodes
    return ids, weights, tree


def _compare(pairs: DataFrame, cosine: float) -> DataFrame:
    """Per block pair the links that span it (``b`` set) and the link counts (``b`` null)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, right = None, None
        for batch in batches:
            for x, y, first, second in batch[["x", "y", "first", "second"]].itertuples(index=False, name=None):
                if y != name:
                    name, right = y, _loaded(second)
                ids, weights, tree = right if x == y else _loaded(first)
                i, j = dual_pairs(tree, right[2], cosine)
                if x != y:
                    j = j + len(ids)
                    ids, weights = np.concatenate([ids, right[0]]), np.concatenate([weights, right[1]])
                counts = np.bincount(i, weights[j], len(ids)) + np.bincount(j, weights[i], len(ids))
                own = np.flatnonzero(counts)
                a, b = spanning_links(len(ids), i, j)
                yield pd.concat(
                    [
                        pd.DataFrame({"a": ids[a], "b": ids[b], "n": 0}).astype({"b": "Int64"}),
                        pd.DataFrame({"a": ids[own], "b": pd.NA, "n": counts[own].astype(np.int64)}).astype({"b": "Int64"}),
                    ]
                )

    return pairs.select("x", "y", "first", "second").mapInPandas(run, "a long, b long, n long")


def _usable(vector: Column) -> Column:
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)),
    )
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def vector_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = 0.98,
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Two vectors are linked if their labels are equal, they have the same length and their cosine, in double
    precision, is at least ``cosine``. Vectors that are null, empty, zero or hold a null or a number
    that is not finite are linked with nothing, as are those without a label or an id.
    ``n_links`` counts other rows, equal ones included; ``component_id`` is the least id reachable
    and ``kept`` whether it is the row's own (true without an id). Rows that share an id share its
    component. Other columns are not looked at; an empty table gives an empty table.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    numeric = vectors.schema[vector_col].dataType.simpleString()
    kind = numeric if numeric == "array<float>" else "array<double>"
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast(kind).alias("vector"),
        F.concat_ws(":", F.size(vector_col).cast("string"), F.col(label_col).cast("string")).alias("grp"),
        F.col(label_col).isNotNull().alias("labelled"),
    )
    usable = F.coalesce(F.col("id").isNotNull() & F.col("labelled") & _usable(F.col("vector")), F.lit(False))
    rows = rows.select(
        "id", F.when(usable, F.col("vector")).alias("vector"), F.when(usable, F.col("grp")).alias("grp")
    )
    classes = materialise(
        rows.filter("grp is not null")
        .groupBy("grp", "vector")
        .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")),
        "vector_classes",
    )
    blocks, tree, height = _blocks(classes)
    trees = materialise(_trees(blocks), "block_trees")
    sides = [
        trees.select(F.col("cell").alias(c), F.col("tree").alias(t)) for c, t in (("x", "first"), ("y", "second"))
    ]
    pairs = _block_pairs(tree, height, cosine).join(sides[0], "x").join(sides[1], "y")
    found = materialise(_compare(pairs, cosine), "vector_links")

    links = found.filter("b is not null").select("a", "b")
    components = materialise(connected_components(links), "vector_components")
    counts = found.filter("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("linked"))
    known = materialise(
        classes.select("grp", "vector", "rep", "n")
        .join(counts, "rep", "left")
        .join(components.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "grp",
            "vector",
            (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        ),
        "vector_roots",
    )
    component = F.coalesce("component", "id")
    return rows.join(known, ["grp", "vector"], "left").select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
