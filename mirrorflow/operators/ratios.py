"""Unit values, CIF/FOB ratios and quantity weights of mirrored flows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorflow.functions import semantics as S
from mirrorflow.operators.median import Stage, add_grouped_median
from mirrorflow.sources.scratch import materialise

COMMODITY_YEAR = ("year", "commodity_code")


def add_exporter_unit_value(mirror: DataFrame, stage: Stage = materialise) -> DataFrame:
    """``unit_value_exp`` and its median per commodity and year, ``uv_exp``."""
    out = mirror.withColumn("unit_value_exp", S.ieee_div("trade_value_usd_exp", "qty_exp"))
    return add_grouped_median(out, COMMODITY_YEAR, "unit_value_exp", "uv_exp", stage)


def add_quantity_weight(mirror: DataFrame) -> DataFrame:
    """Inverse of larger over smaller reported quantity: 1 where both sides agree."""
    gap = S.ieee_div(S.row_max("qty_imp", "qty_exp"), S.row_min("qty_imp", "qty_exp"))
    return mirror.withColumn("cif_fob_weights", S.ieee_div(F.lit(1.0), gap))


def compute_ratios(mirror: DataFrame, stage: Stage = materialise) -> DataFrame:
    """Unit values, their ratio, the value ratio, the commodity's median and the weight."""
    out = mirror.withColumn("unit_value_imp", S.ieee_div("trade_value_usd_imp", "qty_imp"))
    out = add_exporter_unit_value(out, stage)
    out = out.withColumns(
        {
            "cif_fob_unit_ratio": S.ieee_div("unit_value_imp", "unit_value_exp"),
            "cif_fob_ratio": S.ieee_div("trade_value_usd_imp", "trade_value_usd_exp"),
        }
    )
    return add_quantity_weight(out)
