"""A Merkle manifest of a table: hash trees per partition, and a recursive query that checks each row.

Leaves are digests of rows. Within a partition value every run of eight nodes becomes the digest of
its members until one is left, the subroot; subroots become the root in the same way. Levels are
built one after the other, each from groups of eight at most, and stored as node rows that
know their parent and their siblings to the left and right.

Digests are hashed as hex text and travel as bytes. To check rows, a recursive common table expression climbs from the leaves: each step joins the node
reached, appends its siblings to the proof and folds them with the digest carried along. Leaves of
one run have all nodes above it in common, so they climb in one row, as an array of digests beside one
proof. Places of leaves come from range partitions, so no partition value is one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorflow.llm.shards import ranked
from mirrorflow.sources.scratch import materialise

ARITY = 8
_TOP = -1  # tree number of the levels above the subroots
_NODE = "struct<tree: bigint, level: int, idx: bigint>"

# the climb takes a step per level; rows are as many as runs times levels
_NO_LIMIT = {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.cteRecursionLevelLimit": "200"}


def row_digest(values: Sequence[Column]) -> Column:
    """Hex SHA-256 of the values: each ``-`` if null, else its bytes in UTF-8, ``:`` and itself."""
    parts = []
    for value in values:
        text = value.cast("string")
        spelled = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(spelled, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _digest(hexes: Column) -> Column:
    return F.sha2(F.array_join(hexes, ""), 256)


def _key(tree: Column, level: int, idx: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), F.lit(level).alias("level"), idx.cast("long").alias("idx"))


def _runs(nodes: DataFrame, parent: Column, carried: Sequence[str] = ()) -> DataFrame:
    """``parent`` and ``kids`` (idx, node, hash and what is carried) of each run, in order."""
    kid = F.struct("idx", "node", "hash", *carried)
    return nodes.groupBy(parent.alias("parent")).agg(F.sort_array(F.collect_list(kid)).alias("kids"))


def _siblings(kids: str, place: Column) -> tuple[Column, Column]:
    hashes = F.col(kids)["hash"]
    after = F.slice(hashes, place + 2, F.greatest(F.size(hashes) - place - 1, F.lit(0)))
    return F.array_join(F.slice(hashes, F.lit(1), place), ""), F.array_join(after, "")


def _node_rows(runs: DataFrame) -> DataFrame:
    """``node``, ``parent``, ``left`` and ``right`` of each member of the runs."""
    members = runs.select("parent", F.col("kids"), F.posexplode(F.col("kids")["node"]).alias("_at", "node"))
    left, right = _siblings("kids", F.col("_at"))
    return members.select("node", "parent", F.unhex(left).alias("left"), F.unhex(right).alias("right"))


def _levels(n: int) -> int:
    """Levels above ``n`` nodes."""
    return 0 if n <= 1 else 1 + _levels(math.ceil(n / ARITY))


@dataclass(frozen=True)
class Manifest:
    """Built levels of a table.

    ``leaf_runs``: ``parent`` and ``kids`` of the runs of leaves, each kid with the row's columns;
    ``nodes``: a row per inner node but the root, with parent and siblings; ``subroots``: ``tree``,
    the partition value and ``subroot``; ``root`` is None for an empty table.
    """

    leaf_runs: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def build_manifest(leaves: DataFrame, partition: str, order: str, hash_col: str, carried: Sequence[str]) -> Manifest:
    """Hash trees over ``leaves``, one per value of ``partition`` (null is a value, and the first).

    Leaves ascend by ``order`` (null first), then by digest; equal rows are leaves of their own. The last run of
    a level may have fewer members, even one. ``carried`` columns stay with the leaves.
    """
    spark = leaves.sparkSession
    rows = leaves.select(
        F.col(partition).alias("_part_value"), F.col(order).alias("_order"), F.col(hash_col).alias("hash"), *carried
    )
    rows = materialise(ranked(rows, ["_part_value", "_order", "hash"], "_place"), "merkle_leaves")
    trees = rows.groupBy("_part_value").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("n"))
    trees = materialise(ranked(materialise(trees, "merkle_sizes"), ["_part_value"], "tree"), "merkle_trees")
    n_trees, largest = trees.agg(F.count(F.lit(1)), F.max("n")).first()
    if not n_trees:
        nothing = spark.createDataFrame([], f"node {_NODE}, parent {_NODE}, left binary, right binary")
        runs = rows.select(_key(F.lit(0), 0, F.lit(0)).alias("parent"), F.array(F.struct(*carried)).alias("kids"))
        return Manifest(runs, nothing, trees.select("tree", "_part_value", F.lit("").alias("subroot")), None)

    same = rows["_part_value"].eqNullSafe(trees["_part_value"])
    placed = rows.join(trees.select("_part_value", "_first", "n", "tree"), same)
    nodes = placed.select(
        "tree", (F.col("_place") - F.col("_first")).alias("idx"), "n", "hash", *carried
    ).withColumn("node", _key(F.col("tree"), 0, F.col("idx")))

    def above(level: int) -> Column:
        """The parent: in the own tree, of a subroot among the levels over all trees, of the root none."""
        own = _key(F.col("tree"), level + 1, F.expr(f"idx div {ARITY}"))
        top = _key(F.lit(_TOP), 1, F.expr(f"tree div {ARITY}")) if n_trees > 1 else F.lit(None).cast(_NODE)
        return F.when(F.col("n") > 1, own).otherwise(top)

    # runs of leaves; a lone leaf is its tree's subroot and has its siblings among the subroots
    nodes = materialise(nodes, "merkle_nodes")
    found, subroots, level = [], [], 0
    leaf_runs = materialise(_runs(nodes.filter("n > 1"), above(0), ["tree", *carried]), "merkle_leaf_runs")
    current, lone = leaf_runs, nodes.filter("n = 1")
    subroots.append(lone.select("tree", "node", "hash"))
    sizes = trees.select("tree", "n")
    for level in range(1, _levels(largest) + 1):
        size = F.expr(f"n div {ARITY ** level} + cast(n % {ARITY ** level} > 0 as long)").alias("n")
        made = current.select(
            F.col("parent.tree").alias("tree"), F.col("parent.idx").alias("idx"),
            F.col("parent").alias("node"), _digest(F.col("kids")["hash"]).alias("hash"),
        ).join(sizes.select("tree", size), "tree")
        made = materialise(made, "merkle_nodes")
        subroots.append(made.filter("n = 1").select("tree", "node", "hash"))
        current = materialise(_runs(made.filter("n > 1"), above(level)), "merkle_runs")
        found.append(_node_rows(current))
    tops = materialise(reduce(DataFrame.unionByName, subroots), "merkle_subroots")
    tops = tops.withColumn("idx", F.col("tree"))
    current, n = tops, n_trees
    for level in range(1, _levels(n_trees) + 1):
        runs = materialise(_runs(current, _key(F.lit(_TOP), level, F.expr(f"idx div {ARITY}"))), "merkle_top_runs")
        found.append(_node_rows(runs))
        current = runs.select(
            F.col("parent.idx").alias("idx"), F.col("parent").alias("node"), _digest(F.col("kids")["hash"]).alias("hash")
        )
    root = current.select("hash").first()["hash"]
    every = materialise(reduce(DataFrame.unionByName, found), "merkle_node_rows") if found else spark.createDataFrame(
        [], f"node {_NODE}, parent {_NODE}, left binary, right binary"
    )
    # lone leaves join the climb as runs of one, from their own place among the subroots
    alone = lone.select(
        F.col("node").alias("parent"), F.array(F.struct("idx", "node", "hash", "tree", *carried)).alias("kids")
    )
    values = trees.select("tree", F.col("_part_value"))
    named = tops.select("tree", F.col("hash").alias("subroot")).join(values, "tree")
    return Manifest(leaf_runs.unionByName(alone), every, materialise(named, "merkle_named"), root)


@contextmanager
def _without_limit(spark: SparkSession) -> Iterator[None]:
    """The row limit of recursive queries, a guard against endless ones, lifted for a while."""
    before = {k: spark.conf.get(k) for k in _NO_LIMIT}
    for k, v in _NO_LIMIT.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


_CLIMB = """
WITH RECURSIVE climb (run, node, folded, proof) AS (
  SELECT run, run AS node, folded, cast('' AS binary) AS proof FROM {runs}
  UNION ALL
  SELECT c.run, n.parent,
    transform(c.folded, f -> unhex(sha2(lower(concat(hex(n.left), hex(f), hex(n.right))), 256))),
    concat(c.proof, n.left, n.right)
  FROM climb c JOIN {nodes} n ON n.node = c.node
  WHERE n.parent IS NOT NULL
)
SELECT run, folded, proof FROM climb WHERE node.tree = """


def check_rows(manifest: Manifest, claimed: str) -> DataFrame:
    """Every row of the manifest with ``tree``, ``hash``, ``proof_sha256`` and ``folded_root``.

    ``claimed`` is the carried column that holds the digest to check in place of the leaf's own, or null.
    The proof is the digests of all siblings on the way up, level by level, left to right.
    """
    runs, spark = manifest.leaf_runs, manifest.leaf_runs.sparkSession
    if manifest.root is None:
        return runs.select(F.explode("kids").alias("kid")).select(
            F.lit(0).cast("long").alias("tree"), F.lit("").alias("hash"), "kid.*",
            F.lit("").alias("proof_sha256"), F.lit("").alias("folded_root"),
        )

    alone = F.col("parent.level") == 0

    def own(k: Column, i: Column) -> Column:
        left, right = _siblings("kids", i)
        given = F.coalesce(k[claimed], k["hash"])
        return F.unhex(F.when(alone, given).otherwise(F.sha2(F.concat(left, given, right), 256)))

    starts = runs.select(F.col("parent").alias("run"), F.transform("kids", own).alias("folded"))
    top = _levels(manifest.subroots.count())
    # with one tree its own highest level holds the root
    tree, level = (_TOP, top) if top else (0, _levels(runs.agg(F.sum(F.size("kids"))).first()[0]))
    starts, query = materialise(starts, "merkle_starts"), f"{_CLIMB}{tree} AND node.level = {level}"
    with _without_limit(spark):
        climbed = materialise(spark.sql(query, runs=starts, nodes=manifest.nodes), "merkle_climbed")
    kids = runs.join(climbed, runs["parent"] == climbed["run"])
    kids = kids.select("parent", "kids", "folded", "proof", F.posexplode("kids").alias("_at", "kid"))
    left, right = _siblings("kids", F.col("_at"))
    proof, folded = F.lower(F.hex("proof")), F.lower(F.hex(F.get("folded", F.col("_at"))))
    siblings = F.when(F.col("parent.level") == 0, proof).otherwise(F.concat(left, right, proof))
    return kids.select("kid.*", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))


def _lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def checked_documents(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its leaf, subroot, root, proof and the root its tampered form gives.

    A row counts as tampered with if 3 divides the CRC-32 of its id; its text then has A-Z lowered.
    Null ids are not tampered with; repeated rows are leaves of their own, rows that share an id stand in the
    order of their digests. Columns other than the five that are digested are not looked at. An empty table
    gives an empty table.
    """

    def digest(text: Column) -> Column:
        return row_digest([F.col(c) for c in ("doc_id", "source", "lang", "n_chars")] + [text])

    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    claimed = F.when(marked, digest(_lowered(F.col("text"))))
    leaves = docs.select("doc_id", "lang", digest(F.col("text")).alias("leaf"), claimed.alias("claimed"))
    manifest = build_manifest(materialise(leaves, "merkle_digests"), "lang", "doc_id", "leaf", ["doc_id", "claimed"])
    rows = check_rows(manifest, "claimed")
    return rows.join(manifest.subroots.select("tree", "subroot"), "tree").select(
        F.col("doc_id"), F.col("hash").alias("leaf"), "subroot", F.lit(manifest.root or "").alias("root"),
        "proof_sha256", "folded_root", (F.col("folded_root") == F.lit(manifest.root or "")).alias("verified"),
    )
