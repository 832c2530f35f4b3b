"""Turning importers' CIF reports into FOB values and choosing between the two sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorflow.functions import codes
from mirrorflow.functions import semantics as S
from mirrorflow.operators.median import Stage
from mirrorflow.sources.scratch import materialise

REPORTER_YEAR = ("year", "reporter_iso")
OUTPUT_KEYS = ("year", "reporter_iso", "partner_iso", "commodity_code")

# What the output's mirror and the fallback for reporters without exports look at.
MIRRORED_FROM = (*OUTPUT_KEYS, "trade_value_usd_exp_imputed", "exports_value")
FALLBACK_FROM = (
    *REPORTER_YEAR, "trade_value_usd_imp", "trade_value_usd_imp_fob", "trade_value_usd_exp_imputed", "exports_value",
)


def label_by_ratio(df: DataFrame) -> DataFrame:
    """Predicted log ratio to ratio; convert where it is at least 1 (+Infinity included)."""
    out = df.withColumn("fitted_unit_ratio", F.exp("fitted_unit_ratio"))
    at_least_one = S.nan_to_null("fitted_unit_ratio") >= 1
    return out.withColumn("fobization", F.when(at_least_one, codes.CONVERT).otherwise(codes.KEEP))


def label_by_unit(df: DataFrame) -> DataFrame:
    """Electrical energy has no transport cost to take off."""
    electric = (F.col("qty_unit_exp") == codes.ELECTRICITY) | (
        F.col("qty_unit_imp") == codes.ELECTRICITY
    )
    return df.withColumn("fobization", F.when(electric, codes.KEEP).otherwise(F.col("fobization")))


def label_by_system(df: DataFrame) -> DataFrame:
    """Imports known not to be valued CIF stay; an unknown system keeps the label."""
    not_cif = F.col("imports_report") != "CIF"
    return df.withColumn("fobization", F.when(not_cif, codes.KEEP).otherwise(F.col("fobization")))


def fob_label(df: DataFrame) -> DataFrame:
    """The three labels in order. Needs ``fitted_unit_ratio`` as the model's linear predictor."""
    return label_by_system(label_by_unit(label_by_ratio(df)))


def impute_trade(df: DataFrame) -> DataFrame:
    """FOB value of the import report; it replaces the export report where it lies strictly
    closer to it than the import report itself does, and conversion is called for."""
    out = df.withColumn(
        "trade_value_usd_imp_fob", S.ieee_div("trade_value_usd_imp", "fitted_unit_ratio")
    )
    reported = F.abs(F.col("trade_value_usd_imp") - F.col("trade_value_usd_exp"))
    converted = F.abs(F.col("trade_value_usd_imp_fob") - F.col("trade_value_usd_exp"))
    closer = (S.nan_to_null(converted) < S.nan_to_null(reported)) & (
        F.col("fobization") == codes.CONVERT
    )
    return out.withColumn(
        "trade_value_usd_exp_imputed",
        F.when(closer, F.col("trade_value_usd_imp_fob")).otherwise(F.col("trade_value_usd_exp")),
    )


def impute_tag(df: DataFrame) -> DataFrame:
    """Flag of where the exporter's value comes from."""
    changed = (F.col("trade_value_usd_exp") != F.col("trade_value_usd_exp_imputed")) & (
        F.col("fobization") == codes.CONVERT
    )
    return df.withColumn(
        "exports_value", F.when(changed, codes.FLAG_RATIO).otherwise(codes.FLAG_UNCHANGED)
    )


def zero_exporters(df: DataFrame, divisor: float, check: bool = True) -> DataFrame:
    """Years and reporters whose imputed exports sum to zero.

    One aggregation also sums what the fallback would give. With ``check`` the query fails if a
    reporter would still have no exports after it.
    """
    totals = df.groupBy(*REPORTER_YEAR).agg(
        S.sum0("trade_value_usd_exp_imputed").alias("before"),
        S.sum0(_fallback_value(divisor)).alias("after"),
    )
    found = totals.filter(F.col("before") == 0)
    keep = F.lit(True)
    if check:
        text = F.concat(
            F.lit("no exports even after the fallback: "),
            F.coalesce("reporter_iso", F.lit("NULL")), F.lit(" "), F.col("year").cast("string"),
        )
        keep = F.when(F.col("after") == 0, F.raise_error(text).cast("boolean")).otherwise(keep)
    return found.select(*REPORTER_YEAR, keep.alias("is_zero"))


def _fallback_value(divisor: float):
    return F.when(S.is_finite("trade_value_usd_imp_fob"), F.col("trade_value_usd_imp_fob")).otherwise(
        S.ieee_div("trade_value_usd_imp", F.lit(float(divisor)))
    )


def zero_exporter_fallback(
    df: DataFrame, divisor: float, stage: Stage = materialise, check: bool = True
) -> DataFrame:
    """Give reporters without any exports the partners' reports: the FOB value if finite, else
    the import value over ``divisor``, whatever the label says.

    The list of such reporters (at most countries x years) is joined back; a window per
    reporter would put each into one task.
    """
    zero = stage(zero_exporters(df, divisor, check), "zero_exporters")
    on = S.same_key("d", "k", [(k, k) for k in REPORTER_YEAR])
    out = df.alias("d").join(zero.alias("k"), on, "left").select("d.*", "k.is_zero")
    finite = S.is_finite("trade_value_usd_imp_fob")
    return out.withColumns(
        {
            "exports_value": F.when(
                F.col("is_zero"), F.when(finite, codes.FLAG_RATIO).otherwise(codes.FLAG_CONSTANT)
            ).otherwise(F.col("exports_value")),
            "trade_value_usd_exp_imputed": F.when(
                F.col("is_zero"), _fallback_value(divisor)
            ).otherwise(F.col("trade_value_usd_exp_imputed")),
        }
    ).drop("is_zero")


def mirror_output(imputed: DataFrame) -> DataFrame:
    """Each flow with its mirror: the value of A to B next to the value of B to A, same flag.

    A full outer join of the table with itself, roles swapped, on year, both countries,
    commodity and flag; repeated keys multiply. The equal keys name the pair in alphabetical
    order, the direction is a further condition: so both sides need the same exchange, which is
    written once and read twice. Rows without any exchange are dropped.
    """
    missing = F.lit("\0")  # sorts before every code and is none
    reporter, partner = F.coalesce("reporter_iso", missing), F.coalesce("partner_iso", missing)
    base = imputed.select(
        *OUTPUT_KEYS,
        F.col("trade_value_usd_exp_imputed").alias("value"),
        F.col("exports_value").alias("flag"),
        F.least(reporter, partner).alias("_lo"),
        F.greatest(reporter, partner).alias("_hi"),
        (reporter <= partner).alias("_forward"),
    )
    same_pair = S.same_key("e", "i", [(k, k) for k in ("year", "_lo", "_hi", "commodity_code", "flag")])
    opposite = (F.col("e._forward") != F.col("i._forward")) | (F.col("e._lo") == F.col("e._hi"))
    both = base.alias("e").join(base.alias("i"), same_pair & opposite, "full")
    zero = F.lit(0.0)
    out = both.select(
        F.coalesce("e.year", "i.year").alias("year"),
        F.coalesce("e.reporter_iso", "i.partner_iso").alias("reporter_iso"),
        F.coalesce("e.partner_iso", "i.reporter_iso").alias("partner_iso"),
        F.coalesce("e.commodity_code", "i.commodity_code").alias("commodity_code"),
        F.coalesce(S.nan_to_null("e.value"), zero).alias("trade_value_usd_exp"),
        F.coalesce(S.nan_to_null("i.value"), zero).alias("trade_value_usd_imp"),
        F.coalesce("e.flag", "i.flag").alias("flag"),
    )
    return out.filter(F.col("trade_value_usd_exp") + F.col("trade_value_usd_imp") > 0)
