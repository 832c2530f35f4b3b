"""Mixing sources by temperature, and dealing the mix into blocks of a token budget.

A source's weight is its share of tokens to the power of an exponent between 0 (all alike) and 1 (as
they are). The exponent is the least for which the entropy of the weights stays at or below a target
and no source is repeated more often than allowed, found by bisection; a job evaluates a tree of
five halvings at once over the table of sources. Each source is put in an order given by hashes
of its ids and repeated in that order until its quota of tokens is met. Places in that order come
from sums per bucket of hashes and running sums inside a bucket, so a source that holds most
rows is spread over many tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorflow.llm.text import words
from mirrorflow.sources.scratch import materialise

HALVINGS, ROUNDS = 5, 6


@dataclass(frozen=True)
class Mix:
    """Production parameters. ``budget`` in tokens; without one, what uses each row at least once.

    ``target_entropy`` is a share of the entropy of equal weights.
    """

    target_entropy: float = 0.95
    max_repetition: float = 2.0
    budget: int | None = None
    block_tokens: int = 262_144
    seed: int = 7


def token_rows(docs: DataFrame, id_col: str, source_col: str, text_col: str, mix: Mix) -> DataFrame:
    """``doc_id``, ``source``, ``n_tokens`` (words) and ``key``, the hash that gives the order."""
    doc_id = F.col(id_col)
    return docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(F.col(source_col), F.lit("")).alias("source"),
        F.size(words(F.col(text_col))).cast("long").alias("n_tokens"),
        order_key(doc_id, mix).alias("key"),
    )


def order_key(doc_id: Column, mix: Mix) -> Column:
    return F.md5(F.concat(F.lit(f"{mix.seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _measures(totals: DataFrame, exponents: list[float], total: int) -> list[tuple[float, ...]]:
    share = F.col("tokens") / F.lit(float(total))
    columns = []
    for i, a in enumerate(exponents):
        weight, stretch = F.pow(share, F.lit(a)), F.pow(share, F.lit(a - 1))
        columns += [
            F.sum(weight).alias(f"z{i}"), F.sum(weight * F.log(share)).alias(f"l{i}"),
            F.max(stretch).alias(f"a{i}"), F.min(stretch).alias(f"b{i}"),
        ]
    row = totals.agg(*columns).first()
    return [tuple(row[4 * i : 4 * i + 4]) for i in range(len(exponents))]


def fit_exponent(totals: DataFrame, mix: Mix) -> float:
    """Least exponent in [0, 1] that meets both limits, to 2**-30; 1 if none does.

    ``totals`` has a row per source with its positive ``tokens``; one row per job reaches the driver.
    """
    total, n = totals.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not n or n == 1:
        return 1.0

    def meets(a: float, z: float, logs: float, most: float, least: float) -> bool:
        entropy = math.log(z) - a * logs / z
        repeated = most / least if mix.budget is None else mix.budget * most / (z * total)
        return entropy <= mix.target_entropy * math.log(n) and repeated <= mix.max_repetition

    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (high - low) / 2**HALVINGS
        grid = [low + step * i for i in range(2**HALVINGS)]
        met = [meets(a, *m) for a, m in zip(grid, _measures(totals, grid, total))]
        if met[0]:
            return grid[0]
        first = met.index(True) if True in met else len(met)
        low, high = low + step * (first - 1), low + step * first
    return high


def source_quotas(rows: DataFrame, mix: Mix) -> DataFrame:
    """Per source ``tokens``, ``rows``, ``weight``, ``quota`` and the ``buckets`` of its order.

    There are about as many buckets as rows in one, so that neither level outgrows the other.

    Without a budget every quota is at least the tokens of the source. Sources without tokens have
    weight and quota 0.
    """
    totals = materialise(
        rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")),
        "source_totals",
    )
    filled = totals.filter("tokens > 0")
    exponent = fit_exponent(filled, mix)
    total = filled.agg(F.sum("tokens")).first()[0] or 1
    z = filled.agg(F.sum(F.pow(F.col("tokens") / F.lit(float(total)), F.lit(exponent)))).first()[0] or 1.0
    weight = F.when(
        F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total)), F.lit(exponent)) / F.lit(z)
    ).otherwise(0.0)
    quotas = totals.withColumn("weight", weight)
    if mix.budget is None:
        covering = quotas.filter("tokens > 0").agg(F.max(F.col("tokens") / F.col("weight"))).first()[0]
        quota = F.greatest("tokens", F.floor(F.col("weight") * F.lit(covering or 0.0) + 0.5))
    else:
        quota = F.floor(F.col("weight") * F.lit(float(mix.budget)) + 0.5)
    quotas = quotas.withColumn("quota", F.when(F.col("tokens") > 0, quota).otherwise(0).cast("long"))
    return materialise(
        quotas.withColumn("buckets", F.ceil(F.sqrt("rows")).cast("long")), "source_quotas"
    )


def _placed(rows: DataFrame, quotas: DataFrame) -> DataFrame:
    """Adds the quotas and ``start``, the tokens of the source that come before a row."""
    head = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    rows = rows.join(quotas, "source").withColumn(
        "bucket", F.shiftright(head * F.col("buckets"), 32)
    )
    sums = rows.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("held"))
    earlier = Window.partitionBy("source").orderBy("bucket")
    sums = sums.withColumn("before", F.sum("held").over(earlier) - F.col("held")).drop("held")
    sums = materialise(sums, "bucket_starts")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "n_tokens")
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("within", F.sum("n_tokens").over(inside) - F.col("n_tokens"))
    return rows.join(sums, ["source", "bucket"]).withColumn("start", F.col("before") + F.col("within"))


def _copies(has_last: Column) -> Column:
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.greatest("tokens", F.lit(1))))
    return F.when(F.col("tokens") > 0, whole + has_last.cast("long")).otherwise(1)


def _rest() -> Column:
    return F.pmod(F.col("quota"), F.greatest(F.col("tokens"), F.lit(1)))


def mixed_blocks(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    mix: Mix = Mix(),
) -> DataFrame:
    """The mix as rows ``doc_id``, ``source``, ``copy``, ``n_tokens``, ``block`` and ``slot``.

    Copy c of a row stands where c whole rounds of its source and the rows before it end; the
    quota is cut into as many even blocks for each source, so that each block has the weights.
    Inside a block, slots from 0 follow a hash of id and copy. A null source is the source ''; rows of
    sources without a token appear once, in the block of their hash; a null id has the hash of the empty string.
    Repeated rows are rows of their own. An empty table gives an empty table.
    """
    rows = materialise(token_rows(docs, id_col, source_col, text_col, mix), "token_rows")
    quotas = source_quotas(rows, mix)
    budget = quotas.agg(F.sum("quota")).first()[0] or 0
    blocks = max(1, math.ceil(budget / mix.block_tokens))
    placed = _placed(rows, quotas)
    placed = placed.withColumn("copies", _copies(F.col("start") < _rest())).filter("copies > 0")
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    placed = placed.select("doc_id", "source", "n_tokens", "key", "start", "tokens", "quota", copy)
    share = (F.col("copy") * F.col("tokens") + F.col("start")) / F.greatest("quota", F.lit(1))
    hashed = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")  # below 2**32
    share = F.when(F.col("tokens") > 0, share).otherwise(hashed / F.lit(float(1 << 32)))
    block = F.least(F.floor(share * F.lit(float(blocks))), F.lit(blocks - 1))
    mark = F.md5(F.concat("key", F.lit(":"), F.col("copy").cast("string")))
    order = Window.partitionBy("block").orderBy("mark", "doc_id", "copy", "n_tokens")
    return (
        placed.withColumns({"block": block.cast("long"), "mark": mark})
        .withColumn("slot", F.row_number().over(order).cast("long") - 1)
        .select("doc_id", "source", "copy", "n_tokens", "block", "slot")
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    mix: Mix = Mix(),
) -> DataFrame:
    """``docs`` with each row as often as the mix has it, with all its columns.

    The same copies as in ``mixed_blocks``. Texts are not shuffled: the last, partial round of a
    source ends at one place of its order, and each row is compared with that place. Rows that
    share id and token count share their number of copies.
    """
    rows = materialise(token_rows(docs, id_col, source_col, text_col, mix), "token_rows")
    quotas = source_quotas(rows, mix)
    place = F.struct("key", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("id"), "n_tokens")
    ends = (
        _placed(rows, quotas)
        .filter(F.col("start") < _rest())
        .groupBy("source")
        .agg(F.max(place).alias("end"))
    )
    plan = materialise(quotas.join(ends, "source", "left"), "mix_plan")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(row.alias("_row"))
    own = packed.select(
        "_row",
        F.coalesce(F.col("_row")[source_col], F.lit("")).alias("source"),
        F.struct(
            order_key(F.col("_row")[id_col], mix).alias("key"),
            F.coalesce(F.col("_row")[id_col].cast("long"), F.lit(-(2**63))).alias("id"),
            F.size(words(F.col("_row")[text_col])).cast("long").alias("n_tokens"),
        ).alias("own"),
    )
    own = own.join(plan, "source").withColumn(
        "copies", _copies(F.coalesce(F.col("own") <= F.col("end"), F.lit(False)))
    )
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return own.filter("copies > 0").select("_row", copies.alias("copy")).select("_row.*")
