"""From reported flows to the regression table and its fit."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from mirrorflow.functions import semantics as S
from mirrorflow.operators import checks, flows, gravity, ols, ratios
from mirrorflow.operators.median import Stage
from mirrorflow.sources.scratch import materialise

RESPONSE = "log_cif_fob_unit_ratio"
REGRESSORS = (
    "log_dist", "log_dist_sq", "log_uv_exp", "contig", "landlocked_reporter", "landlocked_partner",
)
WEIGHT = "cif_fob_weights"
GROUP = "year"


@dataclass
class Lookups:
    """Lookup tables; the valuation table is needed for imputation only."""

    distances: DataFrame
    countries: DataFrame
    hs_crosswalk: DataFrame
    rtas: DataFrame | None = None
    valuation: DataFrame | None = None


def mirrored_reports(all_flows: DataFrame) -> DataFrame:
    """Exports next to the mirror imports, as reported."""
    return flows.mirror_join(
        flows.filter_flow(all_flows, "export"), flows.filter_flow(all_flows, "import")
    )


def comparable_flows(
    all_flows: DataFrame, crosswalk: DataFrame, cutover_year: int, seen: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Mirrored flows in kilograms on both sides, all in the new classification.

    ``seen`` gets the mirrored reports of either classification on their way and returns them.
    """

    def kept(part: DataFrame) -> DataFrame:
        mirrored = mirrored_reports(part)
        return flows.filter_kg(seen(mirrored) if seen else mirrored).select(
            *flows.TRAINING_GROUP, *flows.TRAINING_SUMS
        )

    return flows.per_vintage(
        all_flows,
        cutover_year,
        old=lambda f: flows.convert_hs(
            kept(f), crosswalk, flows.TRAINING_GROUP, flows.TRAINING_SUMS
        ),
        new=kept,
    )


def remaining_share(all_flows: DataFrame, crosswalk: DataFrame, cutover_year: int) -> DataFrame:
    """Per year, the share of mirror rows that enters the regression table.

    Each report is judged before it is mirrored, so that keys and verdicts travel, no units and numbers.
    """

    def judged(reports: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
        passes = F.coalesce(flows.kg_condition(sides=[""]), F.lit(False))
        return reports.select(*keys, passes.alias("passes")).alias(side)

    def mirrored(part: DataFrame) -> DataFrame:
        e = judged(flows.filter_flow(part, "export"), flows.EXPORT_KEYS, "e")
        i = judged(flows.filter_flow(part, "import"), flows.IMPORT_KEYS, "i")
        pairs = list(zip(flows.EXPORT_KEYS, flows.IMPORT_KEYS))
        both = F.col("e.passes") & F.col("i.passes")
        return e.join(i, S.same_key("e", "i", pairs), "full").select(
            *[F.coalesce(f"e.{a}", f"i.{b}").alias(a) for a, b in pairs],
            F.coalesce(both, F.lit(False)).alias("passes"),
        )

    return checks.remaining_share(
        mirrored(all_flows.filter(F.col("year") < cutover_year)),
        mirrored(all_flows.filter(F.col("year") >= cutover_year)),
        crosswalk,
        F.col("passes"),
    )


def observed_comparable(
    all_flows: DataFrame, crosswalk: DataFrame, cutover_year: int, years: Sequence[int], stage: Stage = materialise
) -> tuple[DataFrame, DataFrame]:
    """``comparable_flows`` written, and the share of rows that are left, per year.

    The numbers of rows are observed in the job that writes the table: mirrored reports before the filter, and rows
    written. ``years`` are those of the flows; years without a mirrored row are left out.
    """
    before = [Observation(f"mirrored {side}") for side in ("old", "new")]
    after = Observation("comparable")

    def counts() -> list[Column]:
        return [F.count_if(F.col("year") == int(y)).alias(f"n{int(y)}") for y in years]

    made = iter(before)
    out = comparable_flows(all_flows, crosswalk, cutover_year, lambda df: df.observe(next(made), *counts()))
    table = stage(out.observe(after, *counts()), "comparable")
    total = {y: sum(o.get.get(f"n{int(y)}", 0) or 0 for o in before) for y in years}
    left = after.get
    rows = [(int(y), total[y], left[f"n{int(y)}"], left[f"n{int(y)}"] / total[y]) for y in years if total[y]]
    schema = "year int, n_total bigint, n_remaining bigint, prop_rows_after_filtering double"
    return table, all_flows.sparkSession.createDataFrame(rows, schema)


def training_set(
    all_flows: DataFrame,
    lookups: Lookups,
    cutover_year: int,
    stage: Stage = materialise,
    check: bool = False,
) -> DataFrame:
    """The regression table, one row per year, exporter, importer and commodity.

    ``check`` makes sure keys are unique. Only the new classification's years are looked at:
    the old ones have just been grouped by the key.
    """
    base = stage(comparable_flows(all_flows, lookups.hs_crosswalk, cutover_year), "comparable")
    if check:
        checks.assert_unique(base.filter(F.col("year") >= cutover_year), flows.TRAINING_GROUP)
    out = ratios.compute_ratios(base, stage).select(
        *flows.TRAINING_GROUP, "uv_exp", "cif_fob_unit_ratio", "cif_fob_ratio", "cif_fob_weights"
    )
    out = gravity.add_gravity(out, lookups.distances, lookups.countries, "inner")
    out = gravity.add_rta(out, lookups.rtas)
    out = out.withColumns({c: F.col(c).cast("int") for c in ("contig", "comlang_off", "colony", "rta")})
    out = out.withColumnsRenamed({"reporter_iso": "exporter_iso", "partner_iso": "importer_iso"})
    return gravity.add_pair_id(gravity.add_time_effects(gravity.add_log_terms(out)))


def fit_model(training: DataFrame, rounds: int = 3, two_sided: bool = False) -> tuple[ols.Fit, list[int]]:
    """The model of the log unit ratio after trimming, with the rows used per fit.

    ``training`` should be a written table; it is read once per fit and once for the centre and
    the outlier count.
    """
    fit, used, rows = ols.fit_trimmed(
        training, RESPONSE, REGRESSORS, WEIGHT, GROUP, rounds, two_sided
    )
    fit.outliers = int(ols.count_outliers(rows, fit, two_sided).first()["outliers"])
    return fit, used


def build_training(
    all_flows: DataFrame, lookups: Lookups, cutover_year: int, check: bool = True
) -> DataFrame:
    """``training_set`` written to the scratch folder, its parts materialised on the way."""
    return materialise(
        training_set(all_flows, lookups, cutover_year, materialise, check), "training"
    )
