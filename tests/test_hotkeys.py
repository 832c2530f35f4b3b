"""Full joins that split hot keys, against Spark's own, and how evenly their rows fall."""

import pytest
from pyspark.sql import functions as F

from mirrorflow.operators import flows, hotkeys, ranks
from mirrorflow.sources.scratch import materialise

PAIRS = [("k", "j")]


def columns(left, right):
    return [F.col(f"{left}.k"), F.col(f"{left}.a"), F.col(f"{right}.j"), F.col(f"{right}.b")]


def sides(spark, hot_left=True, both=False):
    n = 6000
    long = spark.range(n).selectExpr("case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else concat('k', id % 900) end as k", "id as a")
    short = spark.range(1500).selectExpr("case when id = 7 then 'hot' when id < 3 then null else concat('k', id) end as j", "id * 2 as b")
    if both:
        short = short.unionByName(spark.range(400).selectExpr("'warm' as j", "id as b"))
        long = long.unionByName(spark.range(5).selectExpr("'warm' as k", "id + 10000 as a"))
    if not hot_left:
        long, short = short.selectExpr("j as k", "b as a"), long.selectExpr("k as j", "a as b")
    return materialise(long, "long"), materialise(short, "short")


@pytest.mark.parametrize("hot_left", [True, False])
@pytest.mark.parametrize("both", [True, False])
def test_same_rows_as_a_plain_join(spark, rows, hot_left, both):
    a, b = sides(spark, hot_left, both)
    hot = hotkeys.hot_keys(a, b, ["k"], ["j"], 8)
    assert hot and any(h.left == hot_left for h in hot)
    want = a.alias("l").join(b.alias("r"), F.col("l.k").eqNullSafe(F.col("r.j")), "full").select(*columns("l", "r"))
    assert rows(hotkeys.full_join(a, b, PAIRS, columns, parts=8, hot=hot)) == rows(want)


def test_hot_key_on_one_side_only(spark, rows):
    a, b = sides(spark)
    without = b.filter("j is null or j <> 'hot'")
    want = a.alias("l").join(without.alias("r"), F.col("l.k").eqNullSafe(F.col("r.j")), "full").select(*columns("l", "r"))
    assert rows(hotkeys.full_join(a, without, PAIRS, columns, parts=8)) == rows(want)
    alone = [hotkeys.Hot(h.mark, h.salts, False) for h in hotkeys.hot_keys(a, b, ["k"], ["j"], 8)]  # the wrong side
    want = a.alias("l").join(b.alias("r"), F.col("l.k").eqNullSafe(F.col("r.j")), "full").select(*columns("l", "r"))
    assert rows(hotkeys.full_join(a, b, PAIRS, columns, parts=8, hot=alone)) == rows(want)


def test_tasks_are_even(spark):
    a, b = sides(spark)
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in zip(keys, ("false", "-1", "16")):
            spark.conf.set(k, v)

        def largest(df):
            sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            return max(sizes) / (sum(sizes) / 16)

        plain = a.alias("l").join(b.alias("r"), F.col("l.k").eqNullSafe(F.col("r.j")), "full").select(*columns("l", "r"))
        assert largest(plain) > 4  # a task of its own for the third of the rows
        assert largest(hotkeys.full_join(a, b, PAIRS, columns)) < 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_mirror_join_by_hot_keys(spark, rows):
    schema = "year int, reporter_iso string, partner_iso string, commodity_code string, trade_value_usd double, qty_unit string, qty double"
    e = [(2000, "a", "b", "999999", float(i), "u", 1.0) for i in range(300)] + [(2000, "a", f"p{i}", "1", 1.0, "u", 1.0) for i in range(300)]
    i = [(2000, "b", "a", "999999", 5.0, "u", 1.0)] + [(2000, f"p{i}", "a", "1", 2.0, "u", 1.0) for i in range(150, 450)]
    a, b = (materialise(spark.createDataFrame(x, schema), "side") for x in (e, i))
    assert rows(flows.mirror_join(a, b, split_hot_keys=True)) == rows(flows.mirror_join(a, b))


def test_positions(spark):
    df = spark.createDataFrame([(i % 7, None if i % 5 == 0 else f"n{i}") for i in range(500)] + [(None, "x")] * 3, "y int, c string")
    got = sorted((r.position, r.y, r.c) for r in ranks.add_position(df.repartition(6), ["y", "c"], "position").collect())
    assert [g[0] for g in got] == list(range(503))
    order = [(y is not None, y or 0, c is not None, c or "") for _, y, c in got]
    assert order == sorted(order)
    assert ranks.add_position(df.limit(0), ["y"], "position").count() == 0
