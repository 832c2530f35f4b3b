import math

import pytest
from pyspark.sql import functions as F

from mirrorflow.functions import codes
from mirrorflow.operators import checks, flows, ratios

KG = codes.KILOGRAMS
FLOW = (
    "aggregate_level int, trade_flow string, year int, reporter_iso string, partner_iso string,"
    " commodity_code string, trade_value_usd double, qty_unit string, qty double, netweight_kg double"
)


def flow(f="export", y=2000, r="a", p="b", c="010101", v=1.0, u=KG, q=1.0, w=1.0, level=6):
    return (level, f, y, r, p, c, v, u, q, w)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), FLOW)


def test_filter_flow(spark, rows):
    df = table(
        spark, flow(), flow(r="wld"), flow(p="0-unspecified"), flow(p=None), flow(level=4),
        flow(f="import"), flow(y=2001), flow(y=2002),
    )
    out = flows.filter_flow(df, "export", years=[2000, 2001])
    assert rows(out, "year", "partner_iso") == [(2000, None), (2000, "b"), (2001, "b")] or sorted(
        map(str, rows(out, "year", "partner_iso"))
    ) == sorted(map(str, [(2000, None), (2000, "b"), (2001, "b")]))
    assert tuple(out.columns) == flows.FLOW_COLUMNS
    wide = flows.filter_flow(df, "export", columns=flows.FLOW_COLUMNS_WITH_WEIGHT)
    assert "netweight_kg" in wide.columns


def test_mirror_join_keeps_both_sides_and_null_partners(spark, rows):
    exports = table(spark, flow(v=10.0), flow(r="x", p=None, v=5.0)).drop("aggregate_level", "trade_flow")
    imports = table(spark, flow(r="b", p="a", v=12.0), flow(r=None, p="x", v=6.0), flow(r="c", p="a", v=7.0))
    out = flows.mirror_join(exports, imports)
    got = rows(out, "reporter_iso", "partner_iso", "trade_value_usd_exp", "trade_value_usd_imp")
    assert set(got) == {("a", "b", 10.0, 12.0), ("x", None, 5.0, 6.0), ("a", "c", None, 7.0)}
    assert out.filter(F.col("year").isNull()).count() == 0
    assert "netweight_kg_exp" in out.columns
    assert "netweight_kg_exp" not in flows.mirror_join(exports.drop("netweight_kg"), imports).columns


def test_mirror_join_multiplies_repeated_keys(spark):
    exports = table(spark, flow(v=1.0), flow(v=2.0))
    imports = table(spark, flow(r="b", p="a", v=3.0), flow(r="b", p="a", v=4.0))
    assert flows.mirror_join(exports, imports).count() == 4


MIRROR = (
    "year int, reporter_iso string, partner_iso string, commodity_code string,"
    " trade_value_usd_exp double, trade_value_usd_imp double, qty_unit_exp string,"
    " qty_unit_imp string, qty_exp double, qty_imp double, netweight_kg_exp double, netweight_kg_imp double"
)


def mirrored(spark, *values):
    """(year, commodity, value exp, value imp, unit exp, unit imp, qty exp, qty imp)"""
    full = [(y, "a", "b", c, ve, vi, ue, ui, qe, qi, 1.0, 2.0) for y, c, ve, vi, ue, ui, qe, qi in values]
    return spark.createDataFrame(full, MIRROR)


def test_kg_filter_is_strict(spark):
    keep = (2000, "c", 10.01, 10.01, KG, KG, 2000.1, 2000.1)
    drop = [
        (2000, "c", 10.0, 11.0, KG, KG, 3000.0, 3000.0),
        (2000, "c", 11.0, 11.0, KG, KG, 2000.0, 3000.0),
        (2000, "c", 11.0, 11.0, KG, "number of items", 3000.0, 3000.0),
        (2000, "c", None, 11.0, None, KG, None, 3000.0),
    ]
    assert flows.filter_kg(mirrored(spark, keep, *drop)).count() == 1
    assert flows.filter_kg(mirrored(spark, keep), ton=1016.0469).count() == 0


def crosswalk(spark):
    return spark.createDataFrame(
        [("01", "12"), ("01", "11"), ("02", None), ("03", "11"), ("04", None), ("04", "13")],
        "hs02 string, hs12 string",
    )


def test_first_crosswalk(spark, rows):
    assert dict(rows(flows.first_crosswalk(crosswalk(spark)))) == {
        "01": "11", "02": None, "03": "11", "04": "13",
    }


def test_conversion_before_and_after_the_cutover(spark, rows):
    df = mirrored(
        spark,
        (2000, "01", 1.0, None, KG, None, 1.0, None),
        (2000, "03", 2.0, None, KG, None, 2.0, None),
        (2000, "02", 4.0, 4.0, KG, KG, 4.0, 4.0),
        (2000, "zz", 8.0, 8.0, KG, KG, 8.0, 8.0),
        (2012, "01", 1.0, None, KG, None, 1.0, None),
    )
    out = flows.convert_hs_before(df, crosswalk(spark), 2012, flows.TRAINING_GROUP, flows.TRAINING_SUMS)
    got = rows(out, "year", "commodity_code", "trade_value_usd_exp", "trade_value_usd_imp")
    assert got == [(2000, "11", 3.0, 0.0), (2000, "999999", 12.0, 12.0), (2012, "01", 1.0, None)]
    by_unit = flows.convert_hs(
        df.filter("year = 2000"), crosswalk(spark), flows.IMPUTE_GROUP, flows.IMPUTE_SUMS
    )
    assert by_unit.count() == 2


def test_remaining_share_in_one_pass(spark, rows):
    old = [
        (2000, "01", 20.0, 20.0, KG, KG, 3000.0, 3000.0),
        (2000, "03", 20.0, 20.0, KG, KG, 3000.0, 3000.0),  # same new code as 01
        (2000, "02", 1.0, 1.0, KG, KG, 3000.0, 3000.0),
        (2001, "01", None, 1.0, None, KG, None, 3.0),
    ]
    new = [(2012, "01", 20.0, 20.0, KG, KG, 3000.0, 3000.0), (2012, "02", 1.0, None, KG, None, 1.0, None)]
    out = checks.remaining_share(mirrored(spark, *old), mirrored(spark, *new), crosswalk(spark))
    got = rows(out)
    assert got == [(2000, 3, 1, pytest.approx(1 / 3)), (2001, 1, 0, 0.0), (2012, 2, 1, 0.5)]
    left = flows.convert_hs(
        flows.filter_kg(mirrored(spark, *old)), crosswalk(spark), flows.TRAINING_GROUP, flows.TRAINING_SUMS
    )
    assert rows(checks.remaining_share_of(mirrored(spark, *old), left)) == got[:2]


def test_net_reflows(spark):
    inf, nan = math.inf, math.nan
    main = table(
        spark, flow(c="1", v=5.0, q=5.0, w=None), flow(c="2", v=5.0, q=nan), flow(c="3", v=inf, q=5.0),
        flow(c="4", v=5.0, q=5.0),
    )
    re = table(spark, flow(c="1", v=7.0, q=2.0, w=1.0), flow(c="3", v=1.0, q=inf), flow(c="4", v=nan, q=1.0))
    got = {r.commodity_code: (r.trade_value_usd, r.qty) for r in flows.net_reflows(main, re).collect()}
    assert got == {"1": (0.0, 3.0), "2": (5.0, 0.0), "3": (0.0, 0.0), "4": (5.0, 4.0)}


def test_reported_by_and_quantity(spark, rows):
    df = mirrored(
        spark,
        (2000, "1", 1.0, 1.0, KG, "number of items", 5.0, 6.0),
        (2000, "2", 1.0, None, None, KG, 5.0, 6.0),
        (2000, "3", None, 1.0, "no quantity", None, 5.0, 6.0),
        (2000, "4", None, None, KG, KG, 5.0, 6.0),
    )
    out = flows.quantity_in_kg(flows.reported_by(df))
    assert rows(out, "commodity_code", "reported_by", "qty_exp", "qty_imp") == [
        ("1", "both parties", 5.0, 2.0), ("2", "exporter only", None, 6.0),
        ("3", "importer only", 1.0, None), ("4", None, 5.0, 6.0),
    ]


def test_ratios_and_weights(spark):
    df = mirrored(
        spark,
        (2000, "1", 10.0, 24.0, KG, KG, 5.0, 4.0),
        (2000, "1", 30.0, 30.0, KG, KG, 5.0, 10.0),
        (2001, "1", 9.0, 9.0, KG, KG, 1.0, 1.0),
    )
    got = {r.trade_value_usd_exp: r for r in ratios.compute_ratios(df).collect()}
    assert got[10.0].uv_exp == got[30.0].uv_exp == 4.0 and got[9.0].uv_exp == 9.0
    assert got[10.0].cif_fob_unit_ratio == 3.0 and got[10.0].cif_fob_ratio == 2.4
    assert got[10.0].cif_fob_weights == 0.8 and got[30.0].cif_fob_weights == 0.5


def test_key_checks(spark, rows):
    df = mirrored(spark, (2000, "1", 1.0, 1.0, KG, KG, 1.0, 1.0), (2000, "1", 2.0, 1.0, KG, KG, 1.0, 1.0),
                  (2001, "1", 1.0, 1.0, KG, KG, 1.0, 1.0))
    assert rows(checks.key_counts(df, flows.EXPORT_KEYS)) == [(2000, 2, 1), (2001, 1, 1)]
    assert rows(checks.repeated_keys(df, flows.EXPORT_KEYS), "year", "n") == [(2000, 2)]
    checks.assert_unique(df.filter("year = 2001"), flows.EXPORT_KEYS)
    with pytest.raises(checks.CheckFailed):
        checks.assert_unique(df, flows.EXPORT_KEYS)
