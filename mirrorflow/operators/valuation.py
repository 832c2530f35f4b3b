"""Which countries value imports CIF and which FOB, from scraped reporter notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorflow.functions import codes
from mirrorflow.functions import semantics as S


def clean_valuation(raw: DataFrame, country_codes: DataFrame, trim_first: bool = False) -> DataFrame:
    """Attach country codes to reporter names and drop repeated rows.

    Names lose their parenthesis before the code lookup but the blank left behind only after
    it, so such names miss the lookup and get a code only if they are on the fixed name list.
    ``trim_first`` trims before the lookup instead. Repeated input rows collapse first, before
    any join.
    """

    def trimmed(c: Column) -> Column:
        return F.regexp_replace(c, r"^\s+|\s+$", "")

    name = codes.cut_parenthesis("reporter")
    rows = raw.distinct().select(
        F.col("y").alias("year"),
        (trimmed(name) if trim_first else name).alias("reporter"),
        "trade_flow",
        "valuation",
        F.col("r").alias("uncomtrade_id"),
    )
    on = S.same_key("v", "c", [("reporter", "country_name_english")])
    reporter = trimmed(F.col("v.reporter"))
    code = codes.fix_iso_codes(F.lower("c.iso3_digit_alpha"))
    return (
        rows.alias("v")
        .join(country_codes.alias("c"), on, "left")
        .select(
            "v.year",
            reporter.alias("reporter"),
            codes.override_reporter_code(reporter, code).alias("iso3_digit_alpha"),
            "v.trade_flow",
            "v.valuation",
            "v.uncomtrade_id",
        )
        .distinct()
    )


def sort_valuation(valuation: DataFrame) -> DataFrame:
    return valuation.orderBy("year", "reporter")


def unmatched_reporters(valuation: DataFrame) -> DataFrame:
    """Reporter names without a country code, for checking."""
    return (
        valuation.filter(F.col("iso3_digit_alpha").isNull())
        .select("reporter", "iso3_digit_alpha")
        .distinct()
    )


def valuation_wide(valuation: DataFrame) -> DataFrame:
    """Per year and country: how exports and how imports are valued.

    Of several rows for a flow the first by reporter name, id and valuation counts. Taking it
    as the minimum of a struct needs one shuffle and combines before it.
    """
    kept = valuation.select(
        "year",
        F.col("iso3_digit_alpha").alias("reporter_iso"),
        "trade_flow",
        "valuation",
        F.struct("reporter", "uncomtrade_id", "valuation").alias("_first"),
    ).dropna(how="any", subset=["year", "reporter_iso", "trade_flow", "valuation"])

    def first(flow: str) -> Column:
        return F.min(F.when(F.col("trade_flow") == flow, F.col("_first")))["valuation"]

    return kept.groupBy("year", "reporter_iso").agg(
        first("Export").alias("exports_report"), first("Import").alias("imports_report")
    )


def add_valuation(df: DataFrame, valuation: DataFrame, side: str = "reporter") -> DataFrame:
    """Attach the valuation systems of the exporter (``side="reporter"``) or the importer."""
    if side not in ("reporter", "partner"):
        raise ValueError("side is 'reporter' or 'partner'")
    on = S.same_key("d", "k", [("year", "year"), (f"{side}_iso", "reporter_iso")])
    return (
        df.alias("d")
        .join(valuation_wide(valuation).alias("k"), on, "left")
        .select("d.*", "k.exports_report", "k.imports_report")
    )
