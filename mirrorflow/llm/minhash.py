"""Near-duplicate documents by an inverted join of MinHash signature coordinates.

Texts with equal shingle sets form one class, which has a number of its own, whatever the ids of its
rows. A class is posted under its (coordinate, value) pairs. Pairs that no other class has are dropped, and with them every class that cannot reach the
match threshold; of the rest only the rarest are posted, enough that two classes above the
threshold share four (prefix filter). Posting lists are not expanded into pairs of documents.
Their members are gathered into blocks around the least class of their lists, first compared with
it, and then block by block where two blocks share four lists: collisions of all coordinates
are counted for a block at once, and what reaches the threshold is confirmed on full shingle sets.
Blocks whose members all hang on the same class are skipped, so a large group of copies that are
alike costs a comparison per member.

Tables with a row per class, posting or block are joined by merging at every size. They grow with the
input, and Spark's estimates of them are too low: an array counts as one value, exploded or not, and a
file as large as it is compressed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorflow.llm.batches import bounded_batches
from mirrorflow.llm.components import connected_components
from mirrorflow.llm.shingles import shingle_set, signature, similar
from mirrorflow.sources.scratch import materialise

COORDINATES = 32
MISS = 1e-8
COLLISIONS = 4
BLOCK_ROWS = 512
BLOCK_BYTES = 4 << 20
_COLUMNS = 8192


def match_threshold(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """Least number of equal coordinates to ask for, so that a pair at the similarity is missed
    with probability ``miss`` at most."""
    p, missed = percent / 100, 0.0
    for t in range(coordinates + 1):
        missed += math.comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if missed > miss:
            return max(1, t)
    return coordinates


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int, k: int) -> DataFrame:
    """``id``, ``text_key``, ``n_shingles``, ``set_key`` (digest of the shingle set) and ``sig`` of each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for batch in batches:
            sets = [shingle_set(t, size) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "text_key": batch["text_key"],
                    "n_shingles": [len(s) for s in sets],
                    "set_key": [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets],
                    "sig": [signature(s, k).tolist() if len(s) else None for s in sets],
                }
            )

    rows = docs.select(
        F.col(id_col).cast("long").cast("string").alias("id"), F.col(text_col).alias("text"), _text_key(text_col)
    )
    return rows.mapInPandas(run, "id string, text_key binary, n_shingles long, set_key binary, sig array<int>").select(
        F.col("id").cast("long"), "text_key", "n_shingles", "set_key", "sig"
    )


def _text_key(text_col: str) -> Column:
    return F.unhex(F.md5(F.col(text_col).cast("binary"))).alias("text_key")


def _collisions(threshold: int) -> int:
    return min(COLLISIONS, threshold)


def postings(classes: DataFrame, k: int, threshold: int) -> DataFrame:
    """Rows ``token``, ``rep``: each class under its rarest shared coordinate values.

    Two classes with ``threshold`` values in common share ``COLLISIONS`` of those posted, or all.
    """
    value = F.col("value").cast("long").bitwiseAND(F.lit((1 << 32) - 1))
    tokens = classes.select("rep", F.posexplode("sig").alias("pos", "value")).select(
        "rep", (F.shiftleft(F.col("pos").cast("long"), 32) + value).alias("token")
    )
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    per_class = (
        tokens.join(shared.hint("merge"), "token")
        .groupBy("rep")
        .agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("ordered"))
        .filter(F.size("ordered") >= threshold)
    )
    prefix = F.slice("ordered", F.lit(1), F.size("ordered") - F.lit(threshold - _collisions(threshold)))
    return per_class.select("rep", F.explode(prefix).alias("p")).select("rep", "p.token")


def _shared_shingles(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Matrix of intersection sizes, as products of 0/1 incidence matrices."""
    every = np.concatenate([*a, *b])
    words, where = np.unique(every, return_inverse=True)
    lengths = [len(s) for s in [*a, *b]]
    row = np.repeat(np.arange(len(lengths)), lengths)
    order = np.argsort(where, kind="stable")
    row, where = row[order], where[order]
    out = np.zeros((len(a), len(b)), np.float32)
    for start in range(0, len(words), _COLUMNS):
        lo, hi = np.searchsorted(where, [start, start + _COLUMNS])
        part = np.zeros((len(lengths), min(_COLUMNS, len(words) - start)), np.float32)
        part[row[lo:hi], where[lo:hi] - start] = 1
        out += part[: len(a)] @ part[len(a) :].T
    return out.astype(np.int64)


def block_links(
    ids: list[int], sigs: np.ndarray, sets: list[np.ndarray], split: int, threshold: int, percent: int
) -> list[tuple[int, int]]:
    """Links that span the similar pairs between members before and after ``split``.

    ``split`` equal to the number of members compares all of them with each other.
    """
    own = split == len(ids)
    left, right = np.arange(split), np.arange(0 if own else split, len(ids))
    equal = np.zeros((len(left), len(right)), np.int16)
    for c in range(sigs.shape[1]):
        equal += sigs[left, None, c] == sigs[None, right, c]
    sizes = np.array([len(s) for s in sets])
    small = np.minimum(sizes[left, None], sizes[None, right])
    large = np.maximum(sizes[left, None], sizes[None, right])
    wanted = (equal >= threshold) & (100 * small >= percent * large)
    if own:
        wanted &= left[:, None] < right[None, :]
    if wanted.sum() > 64:
        rows, columns = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
        both = np.zeros(wanted.shape, np.int64)
        both[np.ix_(rows, columns)] = _shared_shingles(
            [sets[left[i]] for i in rows], [sets[right[j]] for j in columns]
        )
        wanted &= 100 * both >= percent * (sizes[left, None] + sizes[None, right] - both)
        pairs = [(left[i], right[j]) for i, j in np.argwhere(wanted)]
    else:
        pairs = [
            (left[i], right[j])
            for i, j in np.argwhere(wanted)
            if similar(sets[left[i]], sets[right[j]], percent)
        ]
    root = list(range(len(ids)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in pairs:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((ids[i], ids[j]))
    return out


def _compare_blocks(members: DataFrame, threshold: int, percent: int) -> DataFrame:
    """Links within each block pair; ``members`` is partitioned and sorted by pair and side."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, ids, sigs, sets, split = None, [], [], [], 0

        def finished() -> list[tuple[int, int]]:
            if len(ids) < 2:
                return []
            return block_links(ids, np.array(sigs, np.int32), sets, split or len(ids), threshold, percent)

        for batch in batches:
            links = []
            for pair, side, rep, sig, shingles in batch.itertuples(index=False, name=None):
                if pair != key:
                    links += finished()
                    key, ids, sigs, sets, split = pair, [], [], [], 0
                if side == 1 and not split:
                    split = len(ids)
                ids.append(rep)
                sigs.append(sig)
                sets.append(np.frombuffer(shingles, np.uint64))
            yield pd.DataFrame(links, columns=["a", "b"])
        yield pd.DataFrame(finished(), columns=["a", "b"])

    return members.select("pair", "side", "rep", "sig", "shingles").mapInPandas(run, "a long, b long")


def _members(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame, size: int) -> DataFrame:
    """The rows of ``wanted`` (class, its first text, home, digest and signature) with their full
    shingle sets.

    The texts are shuffled once, by id and digest; equal rows are dropped where that put them.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for batch in batches:
            batch["shingles"] = [shingle_set(t, size).tobytes() for t in batch["text"]]
            same = [hashlib.md5(s).digest() == k for s, k in zip(batch["shingles"], batch["set_key"])]
            yield batch.loc[same, ["rep", "home", "root", "n_shingles", "sig", "shingles"]]

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), _text_key(text_col))
    # plain columns as keys, so that dropping repeated rows needs no further exchange; a null id counts as the least
    least = F.lit(-(2**63)).cast("long")
    rows = rows.withColumn("_id", F.coalesce("id", least)).drop("id")
    first = wanted.withColumns({"_id": F.coalesce("first.id", least), "text_key": F.col("first.text_key")}).drop("first")
    picked = rows.join(first.hint("shuffle_hash"), ["_id", "text_key"]).dropDuplicates(["_id", "text_key"])
    picked = picked.select("rep", "home", "root", "n_shingles", "sig", "set_key", "text")
    return picked.mapInPandas(
        run, "rep long, home long, root boolean, n_shingles long, sig array<int>, shingles binary"
    )


def _home_links(members: DataFrame, percent: int) -> DataFrame:
    """For each member whether it is similar to the member whose id is its ``home``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked = [
                similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent)
                for a, b in zip(batch["shingles"], batch["home_shingles"])
            ]
            yield pd.DataFrame({"rep": batch["rep"], "home": batch["home"], "linked": linked})

    far = members.filter("rep <> home").select("rep", "home", "shingles")
    homes = members.filter("root").select(
        F.col("rep").alias("home"), F.col("shingles").alias("home_shingles")
    )
    return far.join(homes.hint("merge"), "home").mapInPandas(run, "rep long, home long, linked boolean")


def similar_links(
    docs: DataFrame, id_col: str, text_col: str, classes: DataFrame, percent: int, size: int, k: int
) -> DataFrame:
    """Links ``a``, ``b`` that connect what confirmed similar pairs of classes connect."""
    threshold = match_threshold(percent, k)
    posted = materialise(postings(classes, k, threshold), "postings")
    lists = posted.groupBy("token").agg(F.min("rep").alias("first"), F.max("rep").alias("last"))
    lists = lists.filter("first < last").select("token", "first")
    joint = materialise(posted.join(lists.hint("merge"), "token"), "joint")
    homes = materialise(joint.groupBy("rep").agg(F.min("first").alias("home")), "homes")
    roots = homes.select(F.col("home").alias("rep")).distinct().withColumn("root", F.lit(True))
    homes = homes.join(roots.hint("merge"), "rep", "left").withColumn("root", F.coalesce("root", F.lit(False)))
    wanted = classes.select("rep", "first", "set_key", "sig", "n_shingles").join(homes.hint("merge"), "rep")
    members = materialise(_members(docs, id_col, text_col, wanted, size), "members")
    near = materialise(_home_links(members, percent), "home_links")

    placed = members.select("rep", "home", "n_shingles").join(
        near.select("rep", "linked").hint("merge"), "rep", "left"
    ).select("rep", "home", "n_shingles", F.coalesce("linked", F.lit(True)).alias("linked"))
    counts = placed.groupBy("home", "linked").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_shingles").alias("shingles")
    )
    # written, so that both sides of the join are read from a shuffle and a large home can be split
    counts = materialise(counts, "home_counts")
    chunks = F.greatest(
        F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("shingles") * 8 / BLOCK_BYTES), F.lit(1)
    )
    chunk = F.pmod(F.xxhash64("rep"), chunks)
    placed = placed.join(counts.hint("merge"), ["home", "linked"]).select(
        "rep", F.struct("home", "linked", chunk.alias("chunk")).alias("block")
    )
    placed = materialise(placed.distinct(), "placed")

    at = materialise(joint.join(placed.hint("merge"), "rep").select("token", "block").distinct(), "listed")
    pairs = (
        at.select("token", F.col("block").alias("x"))
        .join(at.select("token", F.col("block").alias("y")).hint("merge"), "token")
        .filter("x < y and not (x.linked and y.linked and x.home = y.home)")
        .groupBy("x", "y")
        .agg(F.count(F.lit(1)).alias("shared"))
        .filter(F.col("shared") >= _collisions(threshold))
        .select("x", "y")
    )
    several = placed.filter("not block.linked").groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    several = several.filter("n > 1").select(F.col("block").alias("x"), F.col("block").alias("y"))
    pairs = pairs.unionByName(several).withColumn("pair", F.to_json(F.struct("x", "y")))
    pairs = materialise(pairs, "block_pairs")
    sides = pairs.select("pair", F.lit(0).alias("side"), F.col("x").alias("block")).unionByName(
        pairs.filter("x <> y").select("pair", F.lit(1).alias("side"), F.col("y").alias("block"))
    )
    calls = placed.join(sides.hint("merge"), "block").select("rep", "pair", "side")
    rows = (
        members.join(calls.hint("merge"), "rep")
        .select("pair", "side", "rep", "sig", "shingles")
        .repartition("pair")
        .sortWithinPartitions("pair", "side", "rep")
    )
    found = _compare_blocks(rows, threshold, percent)
    return near.filter("linked").select(F.col("rep").alias("a"), F.col("home").alias("b")).unionByName(found)


def _grouped(
    docs: DataFrame, id_col: str, text_col: str, percent: int, size: int, coordinates: int, nameless: bool
) -> tuple[DataFrame, DataFrame]:
    """``sketches`` of the rows, and ``first`` of its group (ids before null ones) per ``set_key``.

    Rows without an id take part if ``nameless`` is true.
    """
    bounded_batches(docs.sparkSession)
    known = materialise(sketches(docs, id_col, text_col, size, coordinates), "sketches")
    usable = known.filter("n_shingles > 0") if nameless else known.filter("id is not null and n_shingles > 0")
    first = F.struct(F.col("id").isNull().alias("nameless"), "id", "text_key")
    classes = usable.groupBy("set_key").agg(
        F.min(first).alias("first"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles")
    )
    # numbers are unique and, once written, fixed
    classes = materialise(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    links = similar_links(docs, id_col, text_col, classes, percent, size, coordinates)
    found = materialise(connected_components(links), "components")
    found = found.withColumnRenamed("id", "rep").hint("merge")
    roots = classes.select("set_key", "rep", "first").join(found, "rep", "left")
    roots = materialise(
        roots.select("set_key", "first", F.coalesce("component", "rep").alias("component")), "class_roots"
    )
    # written for the same reason as ``home_counts``
    firsts = materialise(roots.groupBy("component").agg(F.min("first").alias("first")), "group_firsts")
    roots = roots.select("set_key", "component").join(firsts.hint("merge"), "component")
    return known, roots.select("set_key", "first")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 80,
    size: int = 5,
    coordinates: int = COORDINATES,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Two texts are linked if the Jaccard similarity of their sets of ``size``-word shingles is at
    least ``percent`` / 100; ``component_id`` is the least id reachable by links and ``kept`` tells
    whether it is the row's own. Empty texts, null texts and texts without words have an empty set
    and are linked with nothing. A row without an id is linked with nothing, has no component and is
    kept. Rows that share an id are linked only if their texts are. Other columns of ``docs`` are not
    looked at. An empty table gives an empty table. A link is missed with probability 1e-8 at most.
    """
    known, roots = _grouped(docs, id_col, text_col, percent, size, coordinates, False)
    rows = known.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.col("set_key")).alias("set_key"))
    component = F.coalesce(F.col("first.id"), F.col("id"))
    return rows.join(roots.hint("merge"), "set_key", "left").select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def without_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 80,
    size: int = 5,
    coordinates: int = COORDINATES,
) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, that of the least id.

    Rows are judged by id and text: unlike texts under one id are groups of their own, and rows
    without an id are judged like any other and give way to rows with one. Of rows that share id
    and text the least in the other columns stays. Rows without words all stay.
    """
    known, roots = _grouped(docs, id_col, text_col, percent, size, coordinates, True)
    own = F.struct(F.col("id").isNull().alias("nameless"), "id", "text_key")
    judged = known.filter("n_shingles > 0").join(roots.hint("merge"), "set_key")
    judged = judged.groupBy("id", "text_key").agg(
        F.every(own == F.col("first")).alias("kept"), F.count(F.lit(1)).alias("n")
    )
    marked = materialise(
        judged.filter("n > 1 or not kept").select(F.col("id").alias("_id"), F.col("text_key").alias("_key"), "kept"),
        "duplicates",
    )
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(f"`{id_col}`").cast("long").alias("_own"), _text_key(f"`{text_col}`").alias("_text"),
    )
    same = F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_key"))
    # one plan for every size: what goes grows with the rows, so it is never broadcast
    left = packed.join(marked.filter("not kept").hint("merge"), same, "left_anti")
    again = marked.filter("kept").drop("kept").hint("merge")
    if again.isEmpty():
        return left.select("_row.*")
    several = left.join(again, same, "left_semi").groupBy("_own", "_text").agg(F.min("_row").alias("_row"))
    return left.join(again, same, "left_anti").select("_row").unionByName(several.select("_row")).select("_row.*")
