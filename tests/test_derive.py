"""The derived tables: what is written, and by how many exchanges."""

import datetime as dt
import re

from catalogue.derive import Fixture, hs, iso, trade_cells
from catalogue.queries import QUERIES
from pyspark.sql import functions as F


def given_tables(spark, folder, lines):
    """Two nations; supplier 1 of nation 1, suppliers 2 and 3 of nation 2; order 1 by nation 2, order 2 by nation 1."""
    when = dt.datetime(1997, 5, 1)
    made = {
        "nation": ([(1, "A", 0), (2, "B", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, 2), (2, 1)], "c_custkey long, c_nationkey int"),
        "supplier": ([(1, 1), (2, 2), (3, 2)], "s_suppkey long, s_nationkey int"),
        "part": ([(1,), (2,), (18,), (None,)], "p_partkey long"),
        "orders": ([(1, 1), (2, 2), (3, None)], "o_orderkey long, o_custkey long"),
        "lineitem": (
            [(*row, when) for row in lines],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
            " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp",
        ),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_crosswalk_query_reads_parts_only(spark, tmp_path, rows):
    """q55 builds its table from the parts and derives no flows."""
    spark.createDataFrame([(1,), (3,), (18,), (2003,)], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    out = QUERIES["q55_load_or_build"](spark, str(tmp_path))
    assert rows(out) == [("010001", "020000"), ("010003", "020001"), ("010023", "020021")]


def test_tables_are_written_on_first_use(spark, tmp_path):
    fx = Fixture(spark, given_tables(spark, tmp_path, [(1, 1, 1, 1, 2.0, 10.0, 0.0, 0.0, "R")]))
    assert fx.hs_crosswalk.count() == 2
    assert "_trees" not in vars(fx)
    assert fx.flows.count() == 3
    assert fx.flows is fx.flows


def test_cells_of_several_suppliers_by_one_exchange_of_sums(spark, tmp_path):
    lines = [
        (1, 1, 2, 1, 2.0, 10.0, 0.5, 0.0, "R"),
        (1, 1, 3, 3, 1.0, 5.0, 0.0, 0.0, "A"),
        (1, 1, 3, 5, 4.0, 7.0, 0.0, 0.0, "N"),
        (2, 2, 1, 1, 1.0, 3.0, 0.0, 1.0, "A"),
        (3, 1, 1, 1, 1.0, 3.0, 0.0, 0.0, "A"),
        (1, 1, None, 1, 1.0, 3.0, 0.0, 0.0, "A"),
        (None, 1, 1, 1, 1.0, 3.0, 0.0, 0.0, "A"),
    ]
    cells = trade_cells(spark, given_tables(spark, tmp_path, lines))
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"HashAggregate|SortAggregate", plan)) == 2
    found = {(r["year"], r["sn"], r["cn"], r["kk"]): r.asDict() for r in cells.collect()}
    assert set(found) == {(1997, 2, 2, 1), (1997, 1, 1, 2)}
    one = found[1997, 2, 2, 1]
    assert (one["e_v"], one["e_q"], one["re_v"], one["i_v"], one["i_c"]) == (17.0, 6.0, 10.0, 15.0, 25.0)
    assert (one["i_q"], one["ri_v"], one["x_v"], one["x_q"]) == (2.5, 5.0, 5.0, 1.0)


def test_codes_are_those_of_the_formatter(spark):
    numbers = [(None,), (-12,), (-5,), (0,), (7,), (10,), (99,), (100,), (999,), (1000,), (12345,)]
    n = F.col("n")
    out = spark.createDataFrame(numbers, "n int").select(
        iso("n").alias("a"), F.format_string("n%02d", n).alias("b"),
        hs("01", n).alias("c"), F.format_string("01%04d", n.cast("long")).alias("d"),
    )
    assert all(r["a"] == r["b"] and r["c"] == r["d"] for r in out.collect())


def test_share_is_of_judged_reports(spark):
    """Units and numbers of reports are not exchanged; both sides have to pass, a side that is absent does not."""
    from mirrorflow.functions import codes
    from mirrorflow.plans import training

    kg = codes.KILOGRAMS
    rows = [
        ("export", "a", "b", "1", kg, 50.0, 3000.0), ("import", "b", "a", "1", kg, 60.0, 3000.0),
        ("export", "a", "b", "2", kg, 50.0, 3000.0), ("import", "b", "a", "2", kg, 60.0, 2000.0),
        ("export", "a", "c", "1", kg, 50.0, 3000.0), ("import", "c", None, "1", None, None, 9000.0),
        ("export", "a", "d", "1", None, 50.0, 3000.0), ("import", "d", "a", "1", kg, 50.0, 3000.0),
    ]
    schema = "trade_flow string, reporter_iso string, partner_iso string, commodity_code string, qty_unit string, trade_value_usd double, qty double"
    part = spark.createDataFrame(rows, schema).withColumn("aggregate_level", F.lit(6))
    both = part.withColumn("year", F.explode(F.array(F.lit(1997), F.lit(1998))))
    out = training.remaining_share(both, spark.createDataFrame([("1", "9"), ("2", "9")], "hs02 string, hs12 string"), 1998)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = re.findall(r"Join FullOuter.*", plan)
    assert len(joins) == 2 and "trade_value_usd_exp" not in plan
    assert sorted(map(tuple, out.collect())) == [(1997, 5, 1, 0.2), (1998, 5, 1, 0.2)]


def test_imputation_writes_what_its_output_needs(spark, tmp_path):
    from catalogue import model as M
    from catalogue.derive import CUTOVER_YEAR
    from mirrorflow.operators import impute
    from mirrorflow.plans import imputation
    from mirrorflow.sources.scratch import materialise

    lines = [(1, 1, 1, 1, 2.0, 10.0, 0.0, 0.0, "R"), (2, 2, 1, 1, 1.0, 3.0, 0.0, 1.0, "A")]
    fx = Fixture(spark, given_tables(spark, tmp_path, lines))
    staged = {}

    def stage(df, name):
        staged.setdefault(name, set(df.columns))
        return materialise(df, name)

    args = (fx.flows, fx.lookups, M.OLS_MODEL, CUTOVER_YEAR)
    out = imputation.impute_flows(*args, stage=stage, check=False)
    assert staged["mirror"] == set(imputation.LABELLED_FROM)
    assert staged["labelled"] == set(impute.MIRRORED_FROM) | set(impute.FALLBACK_FROM)
    whole = imputation.imputed_flows(*args, check=False)
    assert {"reported_by", "qty_imp", "contig"} <= set(whole.columns)
    assert sorted(map(str, impute.mirror_output(whole).collect())) == sorted(map(str, out.collect()))


def test_flows_are_written_without_a_sort_and_the_setting_goes_back(spark):
    from catalogue.derive import _unsorted

    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    with _unsorted(spark):
        assert spark.conf.get(name) == "200"
    assert spark.conf.get(name, None) == before
