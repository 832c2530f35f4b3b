"""Partitioned flow trees, year-partitioned tables, CSV tables and model files."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mirrorflow.functions.semantics import bring_first
from mirrorflow.sources import schemas


# --- flows ------------------------------------------------------------------------------------


def read_flow_tree(spark: SparkSession, path: str) -> DataFrame:
    """One classification's tree, partitioned by level, flow, year and reporter."""
    return spark.read.schema(schemas.FLOWS).parquet(path)


def read_flows(spark: SparkSession, old_dir: str, new_dir: str, cutover_year: int) -> DataFrame:
    """All years: before ``cutover_year`` from the old classification's tree, then the new one.

    Both year conditions are partition filters, so no directory is read twice or in vain.
    """
    old = read_flow_tree(spark, old_dir).filter(F.col("year") < cutover_year)
    new = read_flow_tree(spark, new_dir).filter(F.col("year") >= cutover_year)
    return old.unionByName(new)


def write_flow_tree(flows: DataFrame, path: str) -> None:
    """Write flows as a partitioned tree. Rebalancing splits a hot directory over many tasks."""
    (
        flows.hint("rebalance", *schemas.FLOW_PARTITIONS)
        .write.partitionBy(*schemas.FLOW_PARTITIONS)
        .mode("overwrite")
        .parquet(path)
    )


# --- tables partitioned by year ---------------------------------------------------------------


def write_by_year(df: DataFrame, path: str, only_these_years: bool = False) -> None:
    """Write one directory per year, then the manifest of the years written.

    ``only_these_years`` replaces the partitions present in ``df`` and leaves the others alone.
    The rebalance hint lets AQE split large years and merge small ones into well-sized files.
    """
    writer = df.hint("rebalance", "year").write.partitionBy("year").mode("overwrite")
    if only_these_years:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    commit_years(df.sparkSession, path)


_MANIFEST = "_years"  # Spark does not look for data in folders that start with an underscore


def _year_files(spark: SparkSession, path: str) -> DataFrame | None:
    """Per year ``n_rows``, ``n_files`` and a digest of the names, sizes and rows of its files.

    Rows are counted by the paths of their files, no column is read; names are cut from the paths per file, not
    per row. Only the files' names gather in one place, per year.
    """
    found = try_read(spark, path)
    if found is None or "year" not in found.columns:
        return None
    paths = found.groupBy("year", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    paths = paths.agg(F.count(F.lit(1)).alias("n"))
    name = F.regexp_extract("path", "[^/]*$", 0)
    files = paths.groupBy(F.col("year").cast("int").alias("year"), name.alias("name"), "size")
    files = files.agg(F.sum("n").alias("n"))
    # a sum of digests of its files tells a year's files without a list of them
    mark = F.xxhash64("name", "size", "n").cast("decimal(38,0)")
    return files.groupBy("year").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_files"), F.sum(mark).cast("string").alias("digest")
    )


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """The last entry of each year."""
    entries = try_read(spark, f"{path}/{_MANIFEST}")
    if entries is None:
        return None
    last = F.max(F.struct("entered", "n_rows", "n_files", "digest")).alias("e")
    return entries.groupBy("year").agg(last).select("year", "e.n_rows", "e.n_files", "e.digest")


def commit_years(spark: SparkSession, path: str) -> None:
    """Enter the years whose files the manifest does not know as they are; called when all files are written."""
    files, known = _year_files(spark, path), _manifest(spark, path)
    if files is None:
        return
    if known is not None:
        files = files.join(known, ["year", "n_rows", "n_files", "digest"], "left_anti")
    entry = files.withColumn("entered", F.unix_micros(F.current_timestamp()))
    entry.coalesce(1).write.mode("append").parquet(f"{path}/{_MANIFEST}")


def read_by_year(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read a table partitioned by year, the year column first."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return bring_first(reader.parquet(path), "year")


def read_year(
    spark: SparkSession, path: str, year: int, schema: T.StructType | str | None = None
) -> DataFrame:
    """One year only; the condition is a partition filter."""
    return read_by_year(spark, path, schema).filter(F.col("year") == year)


def try_read(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """The Parquet table at ``path``, or None if there is none."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def load_or_build(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    partition_by: Iterable[str] = (),
) -> DataFrame:
    """Read the table at ``path``; if there is none, build it, write it there and read it."""
    found = try_read(spark, path)
    if found is not None:
        return found
    df = build()
    df.write.partitionBy(*partition_by).mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def present_years(spark: SparkSession, path: str) -> list[int]:
    """Years of the table at ``path`` that were written to the end: those whose files are as in its manifest.

    A run that ends between files leaves no entry, or one that its files do not match. Years, not files, reach
    the driver.
    """
    known = _manifest(spark, path)
    files = _year_files(spark, path) if known is not None else None
    if files is None:
        return []
    whole = files.join(known, ["year", "n_rows", "n_files", "digest"], "left_semi")
    return sorted(r["year"] for r in whole.select("year").collect())


def missing_years(years: DataFrame, present: Iterable[int]) -> DataFrame:
    """Distinct years asked for that are not among ``present``."""
    asked = years.select(F.col("year").cast("int").alias("year")).distinct()
    return asked.filter(~F.col("year").isin(list(present)))


def backfill(
    spark: SparkSession,
    path: str,
    years: Iterable[int],
    build: Callable[[list[int]], DataFrame],
) -> list[int]:
    """Build and write only the years that are not there as a whole; returns those years.

    ``build`` gets the whole list at once, so the missing years make one job, not a loop.
    """
    todo = sorted({int(y) for y in years} - set(present_years(spark, path)))
    if todo:
        write_by_year(build(todo), path, only_these_years=True)
    return todo


# --- CSV --------------------------------------------------------------------------------------


def write_csv_by_year(df: DataFrame, path: str) -> None:
    df.hint("rebalance", "year").write.partitionBy("year").mode("overwrite").csv(path, header=True)


def read_csv_dir(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All CSV files below ``path`` as one table, with a given schema (no inference pass)."""
    return spark.read.schema(schema).csv(path, header=True)


_BAD = "_malformed"


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rows of the CSV files below ``path`` that fit the schema, and those that do not.

    The second table is the quarantine: ``file`` (its path), and ``line`` as it stands there. A line is malformed
    if a cell is not of its column's type or if it has more or fewer cells than the schema; empty cells are null and fine.
    Both are readers of the files, without a pass of their own.
    """
    wide = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    rows = spark.read.schema(wide).csv(path, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD)
    rows = rows.withColumn("_file", F.col("_metadata.file_path"))
    # the parser judges only the cells it is asked for: a condition that always holds asks for all of them
    asked = F.xxhash64(*[F.col(f"`{c}`") for c in schema.fieldNames()]) >= F.lit(-(2**63)).cast("long")
    bad = rows.filter(F.col(_BAD).isNotNull() & asked).select(F.col("_file").alias("file"), F.col(_BAD).alias("line"))
    return rows.filter(F.col(_BAD).isNull() & asked).drop(_BAD, "_file"), bad


# --- tables of different columns --------------------------------------------------------------

_ORDER = ["byte", "short", "integer", "long", "float", "double"]  # each holds those before, with rounding from the fifth on


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds values of both; raises ``TypeError`` if there is none.

    Whole numbers and floats give the wider one (long and float a double), decimals grow as needed, a
    date and a timestamp give a timestamp, null gives way to anything. Strings mix with strings only.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    names = [a.typeName(), b.typeName()]
    if all(n in _ORDER for n in names):
        if "float" in names and any(n in ("integer", "long") for n in names):
            return T.DoubleType()
        return a if _ORDER.index(names[0]) >= _ORDER.index(names[1]) else b
    if all(isinstance(t, (T.DecimalType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)) for t in (a, b)):
        digits = {"byte": 3, "short": 5, "integer": 10, "long": 20}
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else digits[t.typeName()] for t in (a, b))
        scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in (a, b))
        if whole + scale > 38:
            raise TypeError(f"no decimal holds both {a.simpleString()} and {b.simpleString()}")
        return T.DecimalType(whole + scale, scale)
    if any(isinstance(t, T.DecimalType) for t in (a, b)) and any(n in ("float", "double") for n in names):
        return T.DoubleType()
    if set(names) == {"date", "timestamp"}:
        return T.TimestampType()
    raise TypeError(f"no type holds both {a.simpleString()} and {b.simpleString()}")


def bind_rows(parts: Iterable[DataFrame]) -> DataFrame:
    """All rows of ``parts`` with the columns of any of them, in order of first appearance.

    Columns are matched by name; what a part lacks is null. A column takes the type that holds those of all
    parts, see ``wider_type``; the error for one without such a type names it.
    """
    parts, merged = list(parts), {}
    for part in parts:
        for field in part.schema.fields:
            try:
                merged[field.name] = wider_type(merged.get(field.name, T.NullType()), field.dataType)
            except TypeError as e:
                raise TypeError(f"column {field.name}: {e}") from None
    return reduce(
        DataFrame.unionByName,
        [p.select(*[(F.col(f"`{c}`") if c in p.columns else F.lit(None)).cast(t).alias(c) for c, t in merged.items()]) for p in parts],
    )


def write_single_csv(df: DataFrame, path: str) -> None:
    """One CSV file; for summaries, whose size does not grow with the flows."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


# --- lookups ----------------------------------------------------------------------------------


def read_lookup(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A lookup table by its name in ``schemas.LOOKUPS``, from Parquet or CSV."""
    schema = schemas.LOOKUPS[name]
    if path.endswith(".csv"):
        return spark.read.schema(schema).csv(path, header=True)
    return spark.read.schema(schema).parquet(path)
