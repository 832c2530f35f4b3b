"""Geography, trade agreements, log terms and effect keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorflow.functions import codes
from mirrorflow.functions import semantics as S


def _country(c: str) -> Column:
    return codes.fix_iso_codes(F.lower(c))


def _single(value: Column, message: str) -> Column:
    """The value of a group of one row; raises if the group has more."""
    repeated = F.raise_error(F.lit(message)).cast("int").isNull()
    return F.when(F.when(F.count(F.lit(1)) > 1, repeated).otherwise(F.lit(True)), F.max(value))


def distance_lookup(distances: DataFrame) -> DataFrame:
    """Distances by current country codes; fails if a pair is then listed twice."""
    renamed = distances.select(
        _country("iso_o").alias("reporter_iso"),
        _country("iso_d").alias("partner_iso"),
        "dist", "contig", "colony", "comlang_off",
    )
    measures = ("dist", "contig", "colony", "comlang_off")
    return renamed.groupBy("reporter_iso", "partner_iso").agg(
        *[_single(F.col(c), "distance table: pair listed twice").alias(c) for c in measures]
    )


def landlocked_lookup(countries: DataFrame, side: str) -> DataFrame:
    """One row per country and value; a country may be listed several times."""
    return countries.select(
        _country("iso3").alias(f"{side}_iso"), F.col("landlocked").alias(f"landlocked_{side}")
    ).distinct()


def _join(df: DataFrame, lookup: DataFrame, keys: list[str], how: str) -> DataFrame:
    on = S.same_key("d", "k", [(k, k) for k in keys])
    added = [F.col(f"k.{c}") for c in lookup.columns if c not in keys]
    return df.alias("d").join(lookup.alias("k"), on, how).select("d.*", *added)


def add_gravity(
    df: DataFrame, distances: DataFrame, countries: DataFrame, how: str = "inner"
) -> DataFrame:
    """Distance, contiguity, colony, language and landlockedness of both countries.

    ``how="inner"`` drops rows without a match, ``how="left"`` keeps them with NULLs. Catalyst
    broadcasts the lookups by their size.
    """
    out = _join(df, distance_lookup(distances), ["reporter_iso", "partner_iso"], how)
    out = _join(out, landlocked_lookup(countries, "reporter"), ["reporter_iso"], how)
    return _join(out, landlocked_lookup(countries, "partner"), ["partner_iso"], how)


def rta_lookup(rtas: DataFrame) -> DataFrame:
    """Agreements per year and unordered pair; fails if a pair is listed twice in a year."""
    keys = ["year", "country1", "country2"]
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("agreement table: pair listed twice")).cast("int"))
    return rtas.groupBy(*keys).agg(one.otherwise(F.max(F.col("rta").cast("int"))).alias("rta"))


def add_rta(df: DataFrame, rtas: DataFrame) -> DataFrame:
    """1 if the two countries had a trade agreement in the year, else 0."""
    pair = df.withColumns(
        {
            "_c1": S.pair_first("reporter_iso", "partner_iso"),
            "_c2": S.pair_second("reporter_iso", "partner_iso"),
        }
    )
    on = S.same_key("d", "k", [("year", "year"), ("_c1", "country1"), ("_c2", "country2")])
    return (
        pair.alias("d")
        .join(rta_lookup(rtas).alias("k"), on, "left")
        .select(*[F.col(f"d.{c}") for c in df.columns], F.coalesce("k.rta", F.lit(0)).alias("rta"))
    )


def add_log_terms(df: DataFrame) -> DataFrame:
    """Logs of distance (and its square) and unit value; of the unit ratio if there is one."""
    log_dist = S.ieee_log("dist")
    terms = {
        "log_dist": log_dist,
        "log_dist_sq": log_dist * log_dist,
        "log_uv_exp": S.ieee_log("uv_exp"),
    }
    if "cif_fob_unit_ratio" in df.columns:
        terms["log_cif_fob_unit_ratio"] = S.ieee_log("cif_fob_unit_ratio")
    return df.withColumns(terms)


def add_time_effects(df: DataFrame) -> DataFrame:
    """Exporter-year and importer-year keys."""
    return df.withColumns(
        {"etfe": S.paste("exporter_iso", "year"), "itfe": S.paste("importer_iso", "year")}
    )


def add_pair_id(df: DataFrame) -> DataFrame:
    return df.withColumn("pair_id", S.paste("exporter_iso", "importer_iso"))
