"""From reported flows and a fitted model to the harmonised table and its summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mirrorflow.functions import semantics as S
from mirrorflow.operators import flows, gravity, impute, ols, ratios, valuation
from mirrorflow.operators.median import Stage
from mirrorflow.plans.training import Lookups
from mirrorflow.sources import tables
from mirrorflow.sources.scratch import materialise


def netted_mirror(all_flows: DataFrame) -> DataFrame:
    """Exports net of re-exports next to imports net of re-imports."""

    def flow(name: str) -> DataFrame:
        return flows.filter_flow(all_flows, name, columns=flows.FLOW_COLUMNS_WITH_WEIGHT)

    exports = flows.net_reflows(flow("export"), flow("re-export"), flows.EXPORT_KEYS)
    imports = flows.net_reflows(flow("import"), flow("re-import"), flows.IMPORT_KEYS)
    return flows.mirror_join(exports, imports)


def converted_mirror(
    all_flows: DataFrame, crosswalk: DataFrame, cutover_year: int, missing_as_zero: bool = True
) -> DataFrame:
    """``netted_mirror`` with all years in the new classification.

    Converted years lose the difference between 0 and not reported unless ``missing_as_zero`` is
    False; later years keep it.
    """
    return flows.per_vintage(
        all_flows,
        cutover_year,
        old=lambda f: flows.convert_hs(
            netted_mirror(f), crosswalk, flows.IMPUTE_GROUP, flows.IMPUTE_SUMS, missing_as_zero
        ),
        new=lambda f: netted_mirror(f).select(*flows.IMPUTE_GROUP, *flows.IMPUTE_SUMS),
    )


def labelled(
    mirror: DataFrame, lookups: Lookups, model: ols.LinearModel, stage: Stage, side: str = "reporter"
) -> DataFrame:
    """Mirror rows (quantities in kg) with predicted ratio, conversion label and imputed value."""
    out = ratios.add_exporter_unit_value(mirror, stage)
    out = gravity.add_gravity(out, lookups.distances, lookups.countries, "left")
    out = gravity.add_log_terms(out)
    out = S.select_affix(
        out,
        keep=("year", "commodity_code", "reported_by", "qty_exp", "qty_imp", "log_dist",
              "log_dist_sq", "log_uv_exp", "contig"),
        prefixes=("trade_", "qty_unit_", "netweight_", "landlocked_"),
        suffixes=("_iso",),
    )
    out = valuation.add_valuation(out, lookups.valuation, side)
    out = impute.fob_label(ols.predict(out, model, "fitted_unit_ratio"))
    return impute.impute_tag(impute.impute_trade(out))


# What labelling looks at in a mirror row.
LABELLED_FROM = (
    *flows.IMPUTE_GROUP, "trade_value_usd_exp", "trade_value_usd_imp", "qty_exp",
)


def imputed_flows(
    all_flows: DataFrame,
    lookups: Lookups,
    model: ols.LinearModel,
    cutover_year: int,
    stage: Stage = materialise,
    valuation_side: str = "reporter",
    check: bool = True,
    divisor: float | None = None,
    missing_as_zero: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Per mirrored flow the imputed export value and its provenance.

    The mirror table is written once (``stage``) for the medians and the lookups, and the labelled
    rows for the reporters' totals and the result. ``divisor`` is that of reporters without
    exports, 1 + the intercept of ``model`` unless given. With ``columns``, some of the output's, only
    what they need is exchanged and written.
    """
    mirror = converted_mirror(all_flows, lookups.hs_crosswalk, cutover_year, missing_as_zero)
    mirror = flows.quantity_in_kg(flows.reported_by(mirror))
    if columns is not None:
        asked = [c for c in mirror.columns if c in LABELLED_FROM or c in columns]
        mirror = mirror.select(*asked)
    out = labelled(stage(mirror, "mirror"), lookups, model, stage, valuation_side)
    if columns is not None:
        out = out.select(*[c for c in out.columns if c in columns or c in impute.FALLBACK_FROM])
    out = impute.zero_exporter_fallback(
        stage(out, "labelled"), 1.0 + model.intercept if divisor is None else divisor, stage, check
    )
    return out if columns is None else out.select(*columns)


def impute_flows(
    all_flows: DataFrame,
    lookups: Lookups,
    model: ols.LinearModel,
    cutover_year: int,
    stage: Stage = materialise,
    valuation_side: str = "reporter",
    check: bool = True,
    divisor: float | None = None,
    missing_as_zero: bool = True,
) -> DataFrame:
    """The harmonised table: value, mirror value and flag per year, pair and commodity."""
    return impute.mirror_output(
        imputed_flows(
            all_flows, lookups, model, cutover_year, stage, valuation_side, check, divisor, missing_as_zero,
            impute.MIRRORED_FROM,
        )
    )


def backfill_harmonised(
    spark: SparkSession,
    path: str,
    years: list[int],
    all_flows: DataFrame,
    lookups: Lookups,
    model: ols.LinearModel,
    cutover_year: int,
) -> list[int]:
    """Impute and write the years missing at ``path``; returns them."""

    def build(todo: list[int]) -> DataFrame:
        part = all_flows.filter(F.col("year").isin(todo))
        return impute_flows(part, lookups, model, cutover_year)

    return tables.backfill(spark, path, years, build)


def imputation_summary(harmonised: DataFrame) -> DataFrame:
    """Rows per year and flag and their share of the year."""
    counts = harmonised.groupBy("year", "flag").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("year"))
    return counts.withColumn("m", S.ieee_div(F.col("n"), total))


def flag_list(harmonised: DataFrame) -> DataFrame:
    return harmonised.select("flag").distinct()


def pair_total(harmonised: DataFrame, year: int, reporter: str, partner: str) -> DataFrame:
    """Total exports of one country to another in one year, for comparison with its own figure."""
    return harmonised.filter(
        (F.col("year") == year)
        & (F.col("reporter_iso") == reporter)
        & (F.col("partner_iso") == partner)
    ).agg(S.sum0("trade_value_usd_exp").alias("trade_value_usd_exp"))
