"""Selecting, netting, mirroring and converting reported trade flows.

Every operator works on all years at once; ``year`` is part of each join and group key.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorflow.functions import codes
from mirrorflow.functions import semantics as S
from mirrorflow.operators import hotkeys

FLOW_COLUMNS = (
    "year", "reporter_iso", "partner_iso", "commodity_code", "trade_value_usd", "qty_unit", "qty",
)
FLOW_COLUMNS_WITH_WEIGHT = (*FLOW_COLUMNS, "netweight_kg")

# Keys of a report, exporter before importer in both. Joins keep this order, so that netted
# exports and netted imports are already partitioned alike when they are mirrored.
EXPORT_KEYS = ("year", "reporter_iso", "partner_iso", "commodity_code")
IMPORT_KEYS = ("year", "partner_iso", "reporter_iso", "commodity_code")

MEASURES = ("trade_value_usd", "qty", "netweight_kg")


def filter_flow(
    flows: DataFrame,
    trade_flow: str,
    years: Iterable[int] | None = None,
    level: int = 6,
    columns: Sequence[str] = FLOW_COLUMNS,
    excluded: Sequence[str] = codes.EXCLUDED_AREAS,
) -> DataFrame:
    """Rows of one flow at one aggregation level, without areas that are not countries.

    Rows with a NULL partner or reporter stay. Level, flow and years reach the scan as partition
    filters, the rest as pushed filters.
    """
    out = flows.filter((F.col("trade_flow") == trade_flow) & (F.col("aggregate_level") == level))
    if years is not None:
        out = out.filter(F.col("year").isin(*[int(y) for y in years]))
    return out.filter(
        S.not_in_keep_null("reporter_iso", excluded) & S.not_in_keep_null("partner_iso", excluded)
    ).select(*columns)


def net_reflows(main: DataFrame, re: DataFrame, keys: Sequence[str] = EXPORT_KEYS) -> DataFrame:
    """Subtract re-exports from exports (or re-imports from imports), never below zero.

    A missing number counts as 0; a difference with an infinite side gives 0. The quantity unit
    is the main flow's.
    """

    def clean(c: str) -> Column:
        zeroed = F.when(S.is_missing(c), F.lit(0.0)).otherwise(F.col(c))
        return F.when(F.abs(zeroed) < F.lit(S.INF), zeroed)

    left = main.alias("m")
    right = re.select(*keys, *MEASURES).alias("r")
    joined = left.join(right, S.same_key("m", "r", [(k, k) for k in keys]), "left")
    return joined.select(
        *[F.col(f"m.{k}") for k in EXPORT_KEYS],
        *[F.greatest(clean(f"m.{c}") - clean(f"r.{c}"), F.lit(0.0)).alias(c) for c in MEASURES],
        F.col("m.qty_unit"),
    )


def mirror_join(exports: DataFrame, imports: DataFrame, split_hot_keys: bool = False) -> DataFrame:
    """Pair the exporter's report of a flow with the importer's report of the same flow.

    Full outer join: in the result the reporter is the exporter and the partner the importer;
    columns end in ``_exp`` and ``_imp``. ``netweight_kg`` is carried if both sides have it.
    ``split_hot_keys`` is for reports that repeat keys often; both sides should then be written tables.
    """
    measures = ["trade_value_usd", "qty_unit", "qty"]
    if "netweight_kg" in exports.columns and "netweight_kg" in imports.columns:
        measures.append("netweight_kg")

    def columns(e: str, i: str) -> list[Column]:
        return [F.coalesce(f"{e}.{a}", f"{i}.{b}").alias(a) for a, b in zip(EXPORT_KEYS, IMPORT_KEYS)] + [
            F.col(f"{s}.{c}").alias(f"{c}_{n}") for c in measures for s, n in ((e, "exp"), (i, "imp"))
        ]

    pairs = list(zip(EXPORT_KEYS, IMPORT_KEYS))
    if split_hot_keys:
        return hotkeys.full_join(exports, imports, pairs, columns)
    e, i = exports.alias("e"), imports.alias("i")
    return e.join(i, S.same_key("e", "i", pairs), "full").select(*columns("e", "i"))


def kg_condition(
    ton: float = 1000.0, min_value: float = 10.0, min_tons: float = 2.0, sides: Sequence[str] = ("_exp", "_imp")
) -> Column:
    """Both sides in kilograms, above ``min_value`` USD and above ``min_tons`` tons.

    ``sides`` are the endings of the columns looked at; ``[""]`` is for the reports of one side.
    """
    terms = (
        [F.col(f"qty_unit{s}") == codes.KILOGRAMS for s in sides]
        + [F.col(f"trade_value_usd{s}") > min_value for s in sides]
        + [F.col(f"qty{s}") > min_tons * ton for s in sides]
    )
    return reduce(lambda a, b: a & b, terms)


def filter_kg(
    mirror: DataFrame, ton: float = 1000.0, min_value: float = 10.0, min_tons: float = 2.0
) -> DataFrame:
    return mirror.filter(kg_condition(ton, min_value, min_tons))


# --- product classification -------------------------------------------------------------------

TRAINING_GROUP = ("year", "reporter_iso", "partner_iso", "commodity_code")
TRAINING_SUMS = ("trade_value_usd_exp", "trade_value_usd_imp", "qty_exp", "qty_imp")
IMPUTE_GROUP = (*TRAINING_GROUP, "qty_unit_exp", "qty_unit_imp")
IMPUTE_SUMS = (*TRAINING_SUMS, "netweight_kg_exp", "netweight_kg_imp")


def first_crosswalk(crosswalk: DataFrame) -> DataFrame:
    """One new code per old code: the smallest, NULL only if there is no other."""
    return crosswalk.groupBy("hs02").agg(F.min("hs12").alias("hs12"))


def to_new_codes(df: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Replace old commodity codes by new ones; codes without a match become "999999".

    Catalyst broadcasts the crosswalk if its size allows; otherwise the join shuffles and AQE
    splits hot codes.
    """
    d, x = df.alias("d"), first_crosswalk(crosswalk).alias("x")
    joined = d.join(x, S.same_key("d", "x", [("commodity_code", "hs02")]), "left")
    new_code = F.coalesce(F.col("x.hs12"), F.lit(codes.UNMATCHED_COMMODITY))
    return joined.select(
        *[new_code.alias(c) if c == "commodity_code" else F.col(f"d.{c}") for c in df.columns]
    )


def convert_hs(
    df: DataFrame,
    crosswalk: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    missing_as_zero: bool = True,
) -> DataFrame:
    """Convert rows in the old classification and sum what falls together.

    The sums skip missing numbers, so a side nobody reported becomes 0 here, or stays missing
    with ``missing_as_zero=False``. Partial sums are formed before the shuffle, which also absorbs
    the hot "999999" code.
    """

    def total(c: str) -> Column:
        some = F.count(S.nan_to_null(c)) > 0
        return S.sum0(c) if missing_as_zero else F.when(some, S.sum0(c))

    return to_new_codes(df, crosswalk).groupBy(*keys).agg(*[total(c).alias(c) for c in sums])


def convert_hs_before(
    df: DataFrame, crosswalk: DataFrame, cutover_year: int, keys: Sequence[str], sums: Sequence[str]
) -> DataFrame:
    """``convert_hs`` for the years before the cut-over; later years pass through unsummed."""
    old = convert_hs(df.filter(F.col("year") < cutover_year), crosswalk, keys, sums)
    new = df.filter(F.col("year") >= cutover_year).select(*keys, *sums)
    return old.unionByName(new)


def per_vintage(flows: DataFrame, cutover_year: int, old, new) -> DataFrame:
    """Union of ``old(flows before the cut-over)`` and ``new(flows from it on)``.

    Splitting at the scan lets each branch read its own years only. Splitting after a full
    outer join would not: its year is a coalesce of two columns and no filter passes that.
    """
    return old(flows.filter(F.col("year") < cutover_year)).unionByName(
        new(flows.filter(F.col("year") >= cutover_year))
    )


# --- measures on mirrored flows ---------------------------------------------------------------


def reported_by(mirror: DataFrame) -> DataFrame:
    """Which side reported: both, the exporter only or the importer only."""
    e, i = F.col("trade_value_usd_exp"), F.col("trade_value_usd_imp")
    label = (
        F.when(e.isNotNull() & i.isNotNull(), "both parties")
        .when(e.isNotNull(), "exporter only")
        .when(i.isNotNull(), "importer only")
    )
    return mirror.withColumn("reported_by", label)


def quantity_in_kg(mirror: DataFrame) -> DataFrame:
    """Quantity in kilograms: reported as such, else net weight; NULL if the unit is unknown."""

    def kg(side: str) -> Column:
        unit = F.col(f"qty_unit_{side}")
        return F.when(unit == codes.KILOGRAMS, F.col(f"qty_{side}")).when(
            unit != codes.KILOGRAMS, F.col(f"netweight_kg_{side}")
        )

    return mirror.withColumns({f"qty_{s}": kg(s) for s in ("exp", "imp")})
