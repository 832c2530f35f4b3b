import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from mirrorflow.functions import codes
from mirrorflow.operators import impute, ols

INF, NAN = math.inf, math.nan
C, K = codes.CONVERT, codes.KEEP


def test_label_by_ratio(spark, rows):
    logs = [math.log(0.99), 0.0, math.log(1.5), None, NAN, INF, -INF]
    df = spark.createDataFrame(list(enumerate(logs)), "i int, fitted_unit_ratio double")
    got = dict(rows(impute.label_by_ratio(df), "i", "fobization"))
    assert got == {0: K, 1: C, 2: C, 3: K, 4: K, 5: C, 6: K}


def test_label_by_unit_and_system(spark, rows):
    df = spark.createDataFrame(
        [(0, codes.ELECTRICITY, None, "CIF"), (1, None, codes.ELECTRICITY, "CIF"), (2, None, None, "CIF"),
         (3, codes.KILOGRAMS, None, "FOB"), (4, None, codes.KILOGRAMS, None)],
        "i int, qty_unit_exp string, qty_unit_imp string, imports_report string",
    ).withColumn("fobization", F.lit(C))
    assert dict(rows(impute.label_by_unit(df), "i", "fobization")) == {0: K, 1: K, 2: C, 3: C, 4: C}
    assert dict(rows(impute.label_by_system(df), "i", "fobization")) == {0: C, 1: C, 2: C, 3: K, 4: C}


def test_replacement_must_be_strictly_closer(spark):
    rows = [
        (0, 100.0, 120.0, 1.2, C),  # 100 instead of 120: exact
        (1, 110.0, 120.0, 1.2, C),  # both 10 away
        (2, 119.0, 120.0, 1.2, C),  # worse
        (3, 100.0, 120.0, 1.2, K),
        (4, None, 120.0, 1.2, C),
        (5, 100.0, 120.0, None, C),
        (6, 100.0, 120.0, INF, C),  # FOB value 0: worse than 20
        (7, 0.0, 0.0, 0.0, C),  # 0/0
        (8, 10.0, 120.0, INF, C),  # FOB value 0 is closer to 10
    ]
    df = spark.createDataFrame(
        rows, "i int, trade_value_usd_exp double, trade_value_usd_imp double,"
        " fitted_unit_ratio double, fobization string",
    )
    got = {r.i: r for r in impute.impute_tag(impute.impute_trade(df)).collect()}
    assert {i: r.trade_value_usd_exp_imputed for i, r in got.items()} == {
        0: 100.0, 1: 110.0, 2: 119.0, 3: 100.0, 4: None, 5: 100.0, 6: 100.0, 7: 0.0, 8: 0.0,
    }
    # row 0 is replaced by an equal value, so nothing changed
    assert {i for i, r in got.items() if r.exports_value == codes.FLAG_RATIO} == {8}


IMPUTED = (
    "year int, reporter_iso string, partner_iso string, commodity_code string,"
    " trade_value_usd_imp double, trade_value_usd_imp_fob double,"
    " trade_value_usd_exp_imputed double, exports_value string"
)


def test_zero_exporters_take_the_partners_reports(spark, rows):
    u = codes.FLAG_UNCHANGED
    df = spark.createDataFrame(
        [
            (2000, "z", "a", "1", 30.0, 20.0, 0.0, u), (2000, "z", "a", "2", 30.0, INF, None, u),
            (2000, "z", "b", "3", 30.0, NAN, 0.0, u), (2000, "a", "z", "1", 30.0, 20.0, 5.0, u),
            (2000, "a", "z", "2", 30.0, 20.0, 0.0, u), (2001, "z", "a", "1", 30.0, 20.0, 7.0, u),
            (2000, None, "a", "1", 9.0, 8.0, 0.0, u),
        ],
        IMPUTED,
    )
    out = impute.zero_exporter_fallback(df, 1.5)
    got = {(r.year, r.reporter_iso, r.commodity_code): (r.trade_value_usd_exp_imputed, r.exports_value)
           for r in out.collect()}
    assert got == {
        (2000, "z", "1"): (20.0, codes.FLAG_RATIO), (2000, "z", "2"): (20.0, codes.FLAG_CONSTANT),
        (2000, "z", "3"): (20.0, codes.FLAG_CONSTANT), (2000, "a", "1"): (5.0, u),
        (2000, "a", "2"): (0.0, u), (2001, "z", "1"): (7.0, u), (2000, None, "1"): (8.0, codes.FLAG_RATIO),
    }


def test_exporter_left_without_exports_fails_the_query(spark):
    df = spark.createDataFrame(
        [(2000, "z", "a", "1", 0.0, 0.0, 0.0, codes.FLAG_UNCHANGED)], IMPUTED
    )
    with pytest.raises(Exception, match="no exports even after the fallback: z 2000"):
        impute.zero_exporter_fallback(df, 1.5).collect()
    assert impute.zero_exporter_fallback(df, 1.5, check=False).count() == 1


def brute_mirror(data):
    left, right = defaultdict(list), defaultdict(list)
    for y, r, p, c, v, f in data:
        left[(y, r, p, c, f)].append(v)
        right[(y, p, r, c, f)].append(v)
    out = []
    for k in left.keys() | right.keys():
        for a in left.get(k) or [None]:
            for b in right.get(k) or [None]:
                a0, b0 = (0.0 if x is None or math.isnan(x) else x for x in (a, b))
                if a0 + b0 > 0:
                    out.append((k[0], k[1], k[2], k[3], a0, b0, k[4]))
    return sorted(out, key=str)


def test_mirror_output_against_brute_force(spark):
    rnd = random.Random(11)
    countries = ["a", "b", "c", None]
    data = [
        (rnd.choice([2000, 2001]), rnd.choice(countries), rnd.choice(countries), rnd.choice("12"),
         rnd.choice([0.0, None, NAN, 1.0, 2.5, 4.0]), rnd.choice("xy"))
        for _ in range(160)
    ]
    df = spark.createDataFrame(
        data, "year int, reporter_iso string, partner_iso string, commodity_code string,"
        " trade_value_usd_exp_imputed double, exports_value string",
    )
    out = impute.mirror_output(df)
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == brute_mirror(data)
    swapped = sorted(((y, p, r, c, b, a, f) for y, r, p, c, a, b, f in got), key=str)
    assert swapped == got


def test_labels_from_a_model(spark, rows):
    model = ols.LinearModel({"(Intercept)": -1.0, "x": 1.0}, ["x"])
    df = spark.createDataFrame(
        [(0, 2.0, "CIF"), (1, 0.5, "CIF"), (2, 2.0, "FOB"), (3, None, "CIF")], "i int, x double, imports_report string"
    ).withColumns({"qty_unit_exp": F.lit("k"), "qty_unit_imp": F.lit("k")})
    out = impute.fob_label(ols.predict(df, model, "fitted_unit_ratio"))
    assert dict(rows(out, "i", "fobization")) == {0: C, 1: K, 2: K, 3: K}
