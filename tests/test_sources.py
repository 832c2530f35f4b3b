import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mirrorflow.plans import imputation
from mirrorflow.sources import schemas, scratch, tables


def flows(spark, years):
    rows = [
        (f"0{c}0101", "b", float(y), "weight in kilograms", 1.0, None, 6, f, y, "a")
        for y in years for c in (1, 2) for f in ("export", "re-import")
    ]
    return spark.createDataFrame(rows, schemas.FLOWS)


def test_flow_trees(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    tables.write_flow_tree(flows(spark, range(2008, 2014)), old)
    tables.write_flow_tree(flows(spark, range(2010, 2016)).withColumn("commodity_code", F.lit("new")), new)
    assert glob.glob(f"{old}/aggregate_level=6/trade_flow=re-import/year=2008/reporter_iso=a/*.parquet")
    df = tables.read_flows(spark, old, new, 2012)
    assert df.count() == 8 * 4
    assert {r.year for r in df.filter("commodity_code = 'new'").select("year").distinct().collect()} == {2012, 2013, 2014, 2015}
    assert dict(df.dtypes)["year"] == "int" and dict(df.dtypes)["reporter_iso"] == "string"


def test_year_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(2000, 1.0), (2001, 2.0), (2002, 3.0)], "year int, v double")
    tables.write_by_year(df, path)
    tables.write_by_year(df.filter("year = 2001").withColumn("v", F.lit(9.0)), path, only_these_years=True)
    out = tables.read_by_year(spark, path)
    assert out.columns[0] == "year" and rows(out) == [(2000, 1.0), (2001, 9.0), (2002, 3.0)]
    one = tables.read_year(spark, path, 2001, "v double, year int")
    assert rows(one) == [(2001, 9.0)]


def test_backfill_builds_missing_years_only(spark, tmp_path, rows):
    path, asked = str(tmp_path / "t"), []

    def build(years):
        asked.append(years)
        return spark.createDataFrame([(y, float(len(asked))) for y in years], "year int, v double")

    assert tables.backfill(spark, path, [2001, 2003], build) == [2001, 2003]
    assert tables.backfill(spark, path, [2001, 2002, 2003], build) == [2002]
    assert tables.backfill(spark, path, [2001, 2002], build) == []
    assert asked == [[2001, 2003], [2002]]
    assert rows(tables.read_by_year(spark, path)) == [(2001, 1.0), (2002, 2.0), (2003, 1.0)]


def test_load_or_build(spark, tmp_path):
    path, built = str(tmp_path / "t"), []

    def build():
        built.append(1)
        return spark.range(3)

    assert tables.load_or_build(spark, path, build).count() == 3
    assert tables.load_or_build(spark, path, build).count() == 3
    assert built == [1]
    with pytest.raises(Exception):
        tables.read_by_year(spark, str(tmp_path / "none")).count()


def test_csv(spark, tmp_path, rows):
    df = spark.createDataFrame([(2000, "x, y", 1, 0.5), (2001, None, 2, 1.0)], schemas.SUMMARY)
    tables.write_csv_by_year(df, str(tmp_path / "by"))
    back = tables.read_csv_dir(spark, str(tmp_path / "by"), "flag string, n bigint, m double, year int")
    assert rows(back, "year", "flag", "n", "m") == rows(df)
    tables.write_single_csv(df, str(tmp_path / "one"))
    assert len(glob.glob(str(tmp_path / "one" / "*.csv"))) == 1
    df.select("flag").write.csv(str(tmp_path / "l.csv"))


def test_lookup_formats(spark, tmp_path, rows):
    df = spark.createDataFrame([("01", "11"), ("02", None)], schemas.HS_CROSSWALK)
    df.write.parquet(str(tmp_path / "x"))
    df.write.csv(str(tmp_path / "x.csv"), header=True)
    assert rows(tables.read_lookup(spark, "hs_crosswalk", str(tmp_path / "x"))) == rows(df)
    assert rows(tables.read_lookup(spark, "hs_crosswalk", str(tmp_path / "x.csv"))) == rows(df)


def test_scratch_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch.scratch_path(spark, "t")
    assert path != scratch.scratch_path(spark, "t")
    assert path.startswith(root.rstrip("/") if root else scratch.scratch_root(spark))
    df = scratch.materialise(spark.range(5).withColumn("v", F.lit(1.5)), "t")
    assert df.count() == 5 and df.inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(
        scratch.scratch_root(spark).split(":", 1)[-1].lstrip("/")
    )


def test_summary_shares(spark, rows):
    df = spark.createDataFrame(
        [(2000, "x")] * 3 + [(2000, "y")] + [(2001, "x")] * 2, "year int, flag string"
    )
    assert rows(imputation.imputation_summary(df)) == [(2000, "x", 3, 0.75), (2000, "y", 1, 0.25), (2001, "x", 2, 1.0)]


def test_years_killed_between_files_are_built_again(spark, tmp_path, rows):
    """A year counts once its manifest entry is there and its files are as entered."""
    path, asked = str(tmp_path / "t"), []

    def build(years):
        asked.append(years)
        return spark.createDataFrame([(y, float(len(asked))) for y in years for _ in range(3)], "year int, v double")

    tables.backfill(spark, path, [2001, 2002, 2003], build)
    # a run that ended after some files of 2004, before the manifest
    spark.createDataFrame([(9.0,)], "v double").write.parquet(f"{path}/year=2004")
    # and one that ended while it wrote 2002 anew
    spark.createDataFrame([(9.0,)], "v double").write.mode("append").parquet(f"{path}/year=2002")
    assert tables.present_years(spark, path) == [2001, 2003]
    assert tables.backfill(spark, path, [2001, 2002, 2003, 2004], build) == [2002, 2004]
    assert asked == [[2001, 2002, 2003], [2002, 2004]]
    assert tables.present_years(spark, path) == [2001, 2002, 2003, 2004]
    assert rows(tables.read_by_year(spark, path)) == sorted((y, v) for y, v in [(2001, 1.0), (2002, 2.0), (2003, 1.0), (2004, 2.0)] for _ in range(3))
    assert tables.present_years(spark, str(tmp_path / "none")) == []


def test_malformed_lines(spark, tmp_path, rows):
    text = ["k,v,d", "1,2.5,2020-01-01", "x,1.0,2020-01-02", "2,,", "3,1.0,not a day", "4,1.0", "5,1.0,2020-01-03,more", '6,"1.5",2020-01-04']
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text("\n".join(text))
    (tmp_path / "c" / "b.csv").write_text("k,v,d\n7,0.5,2020-01-05\nbad line")
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.DoubleType()), T.StructField("d", T.DateType())])
    good, bad = tables.read_csv_checked(spark, str(tmp_path / "c"), schema)
    assert good.columns == ["k", "v", "d"]
    assert sorted(r.k for r in good.select("k").collect()) == [1, 2, 6, 7]
    got = sorted((r.file.rsplit("/", 1)[1], r.line) for r in bad.collect())
    assert got == [("a.csv", text[4]), ("a.csv", text[5]), ("a.csv", text[6]), ("a.csv", text[2]), ("b.csv", "bad line")]
    assert sorted((r.file.rsplit("/", 1)[1], r["count"]) for r in bad.groupBy("file").count().collect()) == [("a.csv", 4), ("b.csv", 1)]


def test_bound_rows(spark, rows):
    a = spark.createDataFrame([(1, 2)], "k int, v int")
    b = spark.createDataFrame([(1.5, 2**40)], "v double, k long")
    c = spark.createDataFrame([("n", None)], "`odd.name` string, v void")
    out = tables.bind_rows([a, b, c])
    assert out.dtypes == [("k", "bigint"), ("v", "double"), ("odd.name", "string")]
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, [(1, 2.0, None), (2**40, 1.5, None), (None, None, "n")]))
    wide = [tables.wider_type(T.DecimalType(10, 2), t) for t in (T.DecimalType(5, 4), T.IntegerType(), T.DoubleType())]
    assert wide == [T.DecimalType(12, 4), T.DecimalType(12, 2), T.DoubleType()]
    assert tables.wider_type(T.LongType(), T.FloatType()) == T.DoubleType()
    assert tables.wider_type(T.DateType(), T.TimestampType()) == T.TimestampType()
    with pytest.raises(TypeError, match="column v"):
        tables.bind_rows([a, a.selectExpr("cast(v as string) as v")])


def test_names_are_cut_per_file(spark, tmp_path):
    """The manifest counts rows by path; no expression on names is evaluated per row."""
    path = str(tmp_path / "t")
    tables.write_by_year(spark.createDataFrame([(2001, 1), (2001, 2), (2002, 3)], "year int, v int"), path)
    files = tables._year_files(spark, path)
    plan = files._jdf.queryExecution().optimizedPlan().toString()
    cut = [line for line in plan.splitlines() if "regexp_extract(" in line]
    assert cut and not any("_metadata" in line.split("regexp_extract(")[1].split(",")[0] for line in cut), plan
    assert sorted((r["year"], r["n_rows"]) for r in files.collect()) == [(2001, 2), (2002, 1)]
    assert tables.present_years(spark, path) == [2001, 2002]
