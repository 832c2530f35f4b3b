"""Every registered query against its SQL counterpart, and properties of the whole pipeline."""

import os

import pytest
from compare import difference, duck

import __spark_entry__ as E
from catalogue import model as M
from catalogue.derive import CUTOVER_YEAR, fixture
from catalogue.queries import QUERIES, training_table
from mirrorflow.functions import codes
from mirrorflow.plans import imputation, training
from mirrorflow.sources.scratch import materialise

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = E.queries()[name](spark, SF)
    oracle = E.oracle_sql().get(name)
    if oracle is None:
        assert len(df.collect()) > 0
    else:
        assert difference(df, con, oracle) is None


def test_entry(spark):
    assert E.entry(spark).count() > 0


@pytest.fixture(scope="module")
def harmonised(spark):
    fx = fixture(spark, SF)
    return materialise(
        imputation.impute_flows(fx.flows, fx.lookups, M.OLS_MODEL, CUTOVER_YEAR), "harmonised"
    )


def test_known_row_counts(spark):
    """Counts of an independent trial run on the same tables (FIXTURES.md, section 4)."""
    if not SF.endswith("sf0.001"):
        pytest.skip("counts are for sf0.001")
    fx = fixture(spark, SF)
    counts = {r["trade_flow"]: r["count"] for r in fx.flows.groupBy("trade_flow").count().collect()}
    assert counts == {"export": 4275, "import": 4670, "re-export": 1514, "re-import": 1617}
    assert training.mirrored_reports(fx.flows).count() == 5338
    assert training_table(fx).count() == 1994
    fit, used = training.fit_model(training_table(fx))
    assert used == [1994, 1843, 1752, 1651]
    out = imputation.impute_flows(fx.flows, fx.lookups, fit.model, CUTOVER_YEAR)
    flags = {r["flag"]: r["count"] for r in out.groupBy("flag").count().collect()}
    assert flags == {codes.FLAG_UNCHANGED: 4041, codes.FLAG_RATIO: 5194, codes.FLAG_CONSTANT: 65}


def test_output_is_symmetric(harmonised):
    swapped = harmonised.selectExpr(
        "year", "partner_iso as reporter_iso", "reporter_iso as partner_iso", "commodity_code",
        "trade_value_usd_imp as trade_value_usd_exp", "trade_value_usd_exp as trade_value_usd_imp", "flag",
    )
    assert harmonised.exceptAll(swapped).count() == 0


def test_shares_add_up(harmonised):
    out = imputation.imputation_summary(harmonised).groupBy("year").agg({"m": "sum"}).collect()
    assert all(abs(r[1] - 1) < 1e-12 for r in out)


def test_all_years_at_once_equal_year_by_year(spark, harmonised):
    fx = fixture(spark, SF)
    for year in (CUTOVER_YEAR - 1, CUTOVER_YEAR):
        alone = imputation.impute_flows(
            fx.flows.filter(f"year = {year}"), fx.lookups, M.OLS_MODEL, CUTOVER_YEAR
        )
        part = harmonised.filter(f"year = {year}")
        assert alone.count() == part.count()
        def total(df):
            return sorted(tuple(r) for r in imputation.imputation_summary(df).collect())
        assert total(alone) == total(part)


def test_weights_lie_in_unit_interval(spark):
    low, high = training_table(fixture(spark, SF)).selectExpr(
        "min(cif_fob_weights)", "max(cif_fob_weights)"
    ).first()
    assert 0 < low <= high <= 1


def test_backfill_of_harmonised_years(spark, tmp_path, harmonised):
    fx, path = fixture(spark, SF), str(tmp_path / "h")
    args = (fx.flows, fx.lookups, M.OLS_MODEL, CUTOVER_YEAR)
    assert imputation.backfill_harmonised(spark, path, [1997], *args) == [1997]
    assert imputation.backfill_harmonised(spark, path, [1997, 1998], *args) == [1998]
    got = spark.read.parquet(path)
    assert got.count() == harmonised.filter("year in (1997, 1998)").count()
