import math
import random
import statistics

from mirrorflow.operators.median import add_grouped_median, grouped_median
from mirrorflow.sources.scratch import materialise

INF, NAN = math.inf, math.nan


def expected(groups):
    out = {}
    for k, values in groups.items():
        kept = sorted(v for v in values if v is not None and not math.isnan(v))
        if kept:
            a, b = kept[(len(kept) - 1) // 2], kept[len(kept) // 2]
            out[k] = a if a == b else (a + b) / 2
    return out


def run(spark, groups, **kw):
    data = [(2000, k, v) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(data, "year int, c string, v double")
    return {r.c: r.m for r in grouped_median(df, ["year", "c"], "v", "m", **kw).collect()}


def test_special_values(spark):
    groups = {
        "pair": [1.0, 2.0], "inf": [1.0, INF], "nan": [NAN, 3.0], "none": [None, NAN],
        "allinf": [INF, INF], "neg": [-3.0, -1.0, -2.0], "mixed": [-INF, -1.0, 0.0, 5.0],
        "zero": [0.0, 0.0, 1.0], "one": [7.0], "tiny": [5e-324, 1e308, 1.0], None: [4.0, 6.0],
    }
    assert run(spark, groups) == expected(groups)


def test_random_groups_one_of_them_hot(spark):
    rnd = random.Random(7)
    groups = {f"g{i}": [math.exp(rnd.gauss(0, 2)) for _ in range(rnd.randint(1, 9))] for i in range(60)}
    groups["hot"] = [round(math.exp(rnd.gauss(1, 0.5)), 3) for _ in range(5000)]
    groups["same"] = [2.5] * 1000 + [1.0] * 999
    got = run(spark, groups)
    assert got == expected(groups)
    assert got["hot"] == statistics.median(groups["hot"])


def test_hot_group_within_one_bucket(spark):
    """Many distinct values closer together than a bucket is wide, and two lone ones far off."""
    rnd = random.Random(5)
    near = [3.0 * (1 + 1e-5 * rnd.random()) for _ in range(3000)]
    nested = [1.0 + 1e-9 * i for i in range(1001)] + [1.0 + 1e-14 * i for i in range(1200)]
    groups = {"near": near + [1e-9, 1e9], "nested": nested, "negative": [-x for x in near], "few": [2.0, 1.0]}
    assert run(spark, groups) == expected(groups)


def test_written_back_to_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "c string, v double")
    out = add_grouped_median(df, ["c"], "v", "m").collect()
    assert sorted((r.c, r.m) for r in out if r.c == "a") == [("a", 2.0), ("a", 2.0)]
    assert [r.m for r in out if r.c == "b"] == [None]


def test_too_coarse_sketch(spark):
    """Brackets that miss the middle are found out and widened; the result stays exact."""
    rnd = random.Random(9)
    groups = {f"g{i}": [rnd.random() ** 3 for _ in range(rnd.randint(900, 1500))] for i in range(4)}
    groups["small"] = [1.0, 2.0, 4.0]
    groups["ends"] = [0.0] * 700 + [1.0] * 700
    # with an accuracy of 3 ranks are off by a third of a group, far more than the margin
    assert run(spark, groups, accuracy=3, margin=0.001) == expected(groups)
    written = []

    def stage(df, name):
        written.append(name)
        return materialise(df, name)

    assert run(spark, groups, stage=stage) == expected(groups)
    assert len(written) == 2  # a scan for the sketches and one for the values between
