import pytest

from mirrorflow.operators import gravity, valuation
from mirrorflow.sources import schemas

KEYS = "year int, reporter_iso string, partner_iso string"


def lookups(spark):
    distances = spark.createDataFrame(
        [("CHL", "ARG", 1000.0, 1, 0, 1), ("ROM", "CHL", 9000.0, 0, 0, 0)], schemas.DISTANCES
    )
    countries = spark.createDataFrame(
        [("CHL", 0), ("CHL", 0), ("ARG", 0), ("ROM", 1)], schemas.COUNTRIES
    )
    return distances, countries


def test_gravity(spark, rows):
    df = spark.createDataFrame(
        [(2000, "chl", "arg"), (2000, "rou", "chl"), (2000, "arg", "chl"), (2000, "chl", None)], KEYS
    )
    inner = gravity.add_gravity(df, *lookups(spark))
    assert rows(inner, "reporter_iso", "dist", "landlocked_reporter") == [("chl", 1000.0, 0), ("rou", 9000.0, 1)]
    left = gravity.add_gravity(df, *lookups(spark), how="left")
    assert left.count() == 4
    assert left.filter("dist is null").count() == 2


def test_agreements(spark, rows):
    rtas = spark.createDataFrame([(2000, "arg", "chl", 1)], schemas.RTAS)
    df = spark.createDataFrame(
        [(2000, "chl", "arg"), (2000, "arg", "chl"), (2001, "chl", "arg"), (2000, "chl", None)], KEYS
    )
    out = gravity.add_rta(df, rtas)
    assert rows(out, "year", "partner_iso", "rta") == sorted(
        [(2000, "arg", 1), (2000, "chl", 1), (2001, "arg", 0), (2000, None, 0)], key=lambda t: tuple(map(str, t))
    )
    with pytest.raises(Exception, match="pair listed twice"):
        gravity.add_rta(df, rtas.unionByName(rtas)).collect()


def test_terms_and_keys(spark):
    df = spark.createDataFrame([("chl", "arg", 2000, 1.0, 0.0)], "exporter_iso string, importer_iso string, year int, dist double, uv_exp double")
    row = gravity.add_pair_id(gravity.add_time_effects(gravity.add_log_terms(df))).first()
    assert (row.log_dist, row.log_dist_sq, row.log_uv_exp) == (0.0, 0.0, float("-inf"))
    assert (row.etfe, row.itfe, row.pair_id) == ("chl_2000", "arg_2000", "chl_arg")


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.VALUATION_RAW)


CODES = [("Chile", "CHL"), ("Viet Nam", "VNM"), ("Romania", "ROM"), ("Bolivia", "ZZZ")]


def test_valuation_names(spark, rows):
    df = raw(
        spark,
        ("Chile", "Import", "CIF", 152, 2000), ("Chile", "Import", "CIF", 152, 2000),
        ("Fmr Ethiopia (until 1992)", "Import", "FOB", 230, 2000),
        ("USA (before 1981)", "Import", "FOB", 841, 2000),
        ("Bolivia (Plurinational State of)", "Import", "CIF", 68, 2000),
        ("Viet Nam (united)", "Import", "CIF", 704, 2000),
        ("Romania", "Import", "CIF", 642, 2000),
    )
    codes = spark.createDataFrame(CODES, schemas.COUNTRY_CODES)
    clean = valuation.clean_valuation(df, codes)
    assert dict(rows(clean, "reporter", "iso3_digit_alpha")) == {
        "Chile": "chl", "Fmr Ethiopia": "eth", "USA": "usa", "Bolivia": "bol", "Viet Nam": None, "Romania": "rou",
    }
    assert clean.count() == 6
    assert rows(valuation.unmatched_reporters(clean)) == [("Viet Nam", None)]
    trimmed = valuation.clean_valuation(df, codes, trim_first=True)
    assert dict(rows(trimmed, "reporter", "iso3_digit_alpha"))["Viet Nam"] == "vnm"
    first = valuation.sort_valuation(clean).first()
    assert first.reporter == "Bolivia"


def test_valuation_wide(spark, rows):
    df = spark.createDataFrame(
        [
            (2000, "Fmr X", "x", "Import", "FOB", 1), (2000, "X", "x", "Import", "CIF", 2),
            (2000, "X", "x", "Export", "FOB", 2), (2000, "X", "x", "Re-Import", "CIF", 2),
            (2000, "Y", "y", "Import", None, 3), (2000, "Z", None, "Import", "CIF", 4),
            (2001, "X", "x", "Import", "CIF", 2),
        ],
        schemas.VALUATION,
    )
    assert rows(valuation.valuation_wide(df)) == [(2000, "x", "FOB", "FOB"), (2001, "x", None, "CIF")]
    flows = spark.createDataFrame([(2000, "x", "w"), (2000, "w", "x")], KEYS)
    assert rows(valuation.add_valuation(flows, df), "reporter_iso", "imports_report") == [("w", None), ("x", "FOB")]
    assert rows(valuation.add_valuation(flows, df, "partner"), "reporter_iso", "imports_report") == [("w", "FOB"), ("x", None)]
    with pytest.raises(ValueError):
        valuation.add_valuation(flows, df, "both")


def test_repeated_distance_pair_fails(spark):
    rows = [("ROM", "FRA", 1.0, 0, 0, 0), ("ROU", "FRA", 2.0, 0, 0, 0)]
    table = spark.createDataFrame(
        rows, "iso_o string, iso_d string, dist double, contig int, colony int, comlang_off int"
    )
    with pytest.raises(Exception, match="pair listed twice"):
        gravity.distance_lookup(table).collect()
    assert gravity.distance_lookup(table.limit(1)).count() == 1
