"""The registered queries: each operator of the library on the derived tables, whole."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue import model as M
from catalogue import dense_sql, model_sql
from catalogue import oracles as O
from catalogue.derive import CUTOVER_YEAR, SPECIAL_REPORTERS, Fixture, fixture, iso, table
from mirrorflow.functions import codes
from mirrorflow.functions import semantics as S
from mirrorflow.operators import (
    absorb, checks, flows, formula, gravity, hotkeys, impute, median, ols, ppml, ranks, ratios, valuation,
)
from mirrorflow.plans import analysis, imputation, training
from mirrorflow.sources import pages, schemas, tables
from mirrorflow.sources.scratch import materialise, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

KEYS = list(flows.EXPORT_KEYS)
KEY_SQL = ", ".join(KEYS)
TRAINING_KEYS = ["year", "exporter_iso", "importer_iso", "commodity_code"]
TRAINING_KEY_SQL = ", ".join(TRAINING_KEYS)


def register(
    name: str, oracle: str | None = None, extra: dict[str, str] | None = None, derived: bool = True
):
    """Register a query. Those that are not ``derived`` read the given tables only."""

    def add(fn: Callable[[Fixture, SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(fixture(spark, sf_dir) if derived else None, spark, sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = O.sql(oracle, extra)
        return fn

    return add


def nudged(c: Column, digits: int) -> Column:
    return F.round(c + F.lit(O.nudge(digits)), digits) + F.lit(0.0)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, -0.0 as 0.0, to be compared across engines."""
    return S.map_columns(df, ["double"], lambda c: nudged(c, digits))


def select_sql(source: str, plain: str, doubles: list[str], digits: int = 6) -> str:
    return f"SELECT {plain}, {', '.join(O.rnd(c, digits=digits) for c in doubles)} FROM {source}"


# --- shared intermediate results --------------------------------------------------------------


def comparable(fx: Fixture) -> DataFrame:
    return training.comparable_flows(fx.flows, fx.hs_crosswalk, CUTOVER_YEAR)


def converted(fx: Fixture) -> DataFrame:
    return imputation.converted_mirror(fx.flows, fx.hs_crosswalk, CUTOVER_YEAR)


_tables: dict[tuple[int, str], DataFrame] = {}


def written(fx: Fixture, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table several queries start from, written once per fixture."""
    key = (id(fx), name)
    if key not in _tables:
        _tables[key] = materialise(build(), name)
    return _tables[key]


def training_table(fx: Fixture) -> DataFrame:
    return written(
        fx, "training", lambda: training.training_set(fx.flows, fx.lookups, CUTOVER_YEAR, materialise)
    )


def imputed(fx: Fixture) -> DataFrame:
    return written(
        fx, "imputed",
        lambda: imputation.imputed_flows(
            fx.flows, fx.lookups, M.OLS_MODEL, CUTOVER_YEAR, columns=impute.MIRRORED_FROM
        ),
    )


def in_kg(fx: Fixture) -> DataFrame:
    return flows.quantity_in_kg(flows.reported_by(converted(fx)))


def labelled(fx: Fixture) -> DataFrame:
    mirror = written(fx, "mirror", lambda: in_kg(fx))
    return imputation.labelled(mirror, fx.lookups, M.OLS_MODEL, materialise)


def harmonised(fx: Fixture) -> DataFrame:
    return impute.mirror_output(imputed(fx))


# --- flows ------------------------------------------------------------------------------------


@register(
    "q01_flow_filter",
    f"""SELECT {KEY_SQL}, {O.rnd('trade_value_usd')}, qty_unit, {O.rnd('qty')}
FROM (SELECT * FROM flows UNION ALL SELECT * FROM noise) f
WHERE trade_flow = 'export' AND aggregate_level = 6
  AND (reporter_iso IS NULL OR reporter_iso NOT IN ('wld', '0-unspecified'))
  AND (partner_iso IS NULL OR partner_iso NOT IN ('wld', '0-unspecified'))""",
)
def flow_filter(fx, spark, sf_dir):
    return rounded(flows.filter_flow(fx.flows.unionByName(fx.noise), "export"))


@register(
    "q02_vintage_union",
    f"""SELECT aggregate_level, trade_flow, year, count(*) AS n,
  {O.rnd('sum(trade_value_usd)', 'trade_value_usd', 3)}, {O.rnd('sum(netweight_kg)', 'netweight_kg', 3)}
FROM flows GROUP BY aggregate_level, trade_flow, year""",
)
def vintage_union(fx, spark, sf_dir):
    rows = tables.read_flows(spark, fx.old_tree, fx.new_tree, CUTOVER_YEAR)
    return rounded(
        rows.groupBy("aggregate_level", "trade_flow", "year").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("trade_value_usd").alias("trade_value_usd"),
            F.sum("netweight_kg").alias("netweight_kg"),
        ),
        3,
    )


@register(
    "q03_mirror_join",
    select_sql("mirror_t", f"{KEY_SQL}, qty_unit_exp, qty_unit_imp", O.T_SUMS),
)
def mirror_join(fx, spark, sf_dir):
    return rounded(training.mirrored_reports(fx.flows))


@register("q04_kg_filter", select_sql("kg", f"{KEY_SQL}, qty_unit_exp, qty_unit_imp", O.T_SUMS))
def kg_filter(fx, spark, sf_dir):
    return rounded(flows.filter_kg(training.mirrored_reports(fx.flows)))


REMAINING_SHARE = f"""SELECT a.year, a.n AS n_total, coalesce(b.n, 0) AS n_remaining,
  {O.rnd('coalesce(b.n, 0) / CAST(a.n AS DOUBLE)', 'prop_rows_after_filtering', 9)}
FROM (SELECT year, count(*) AS n FROM mirror_t GROUP BY year) a
LEFT JOIN (SELECT year, count(*) AS n FROM comparable GROUP BY year) b ON a.year = b.year"""


@register("q05_remaining_share", REMAINING_SHARE)
def remaining_share(fx, spark, sf_dir):
    return rounded(
        training.remaining_share(fx.flows, fx.hs_crosswalk, CUTOVER_YEAR), 9
    )


@register("q06_crosswalk_first", "SELECT hs02, hs12 FROM xwalk_first")
def crosswalk_first(fx, spark, sf_dir):
    return flows.first_crosswalk(fx.hs_crosswalk)


@register("q07_convert_hs_train", select_sql("comparable", KEY_SQL, O.T_SUMS))
def convert_hs_train(fx, spark, sf_dir):
    return rounded(comparable(fx))


@register(
    "q08_convert_hs_impute",
    select_sql("converted", f"{KEY_SQL}, qty_unit_exp, qty_unit_imp", O.I_SUMS),
)
def convert_hs_impute(fx, spark, sf_dir):
    return rounded(converted(fx))


@register(
    "q09_unit_ratios",
    select_sql(
        "r", KEY_SQL,
        ["unit_value_exp", "unit_value_imp", "uv_exp", "cif_fob_unit_ratio", "cif_fob_ratio",
         "cif_fob_weights"],
    ),
    {
        "u": """SELECT *, trade_value_usd_exp / qty_exp AS unit_value_exp,
                       trade_value_usd_imp / qty_imp AS unit_value_imp FROM kg""",
        "r": """SELECT u.*, m.uv_exp, unit_value_imp / unit_value_exp AS cif_fob_unit_ratio,
                       trade_value_usd_imp / trade_value_usd_exp AS cif_fob_ratio,
                       1.0 / (greatest(qty_imp, qty_exp) / least(qty_imp, qty_exp)) AS cif_fob_weights
                FROM u JOIN (SELECT year, commodity_code, median(unit_value_exp) AS uv_exp FROM u
                             GROUP BY year, commodity_code) m USING (year, commodity_code)""",
    },
)
def unit_ratios(fx, spark, sf_dir):
    base = flows.filter_kg(training.mirrored_reports(fx.flows))
    return rounded(
        ratios.compute_ratios(materialise(base, "in_kilograms")).select(
            *KEYS, "unit_value_exp", "unit_value_imp", "uv_exp", "cif_fob_unit_ratio",
            "cif_fob_ratio", "cif_fob_weights",
        )
    )


@register("q10_unit_value_median", select_sql("medians_i", "year, commodity_code", ["uv_exp"]))
def unit_value_median(fx, spark, sf_dir):
    mirror = written(fx, "mirror", lambda: in_kg(fx))
    rows = mirror.withColumn("uv", S.ieee_div("trade_value_usd_exp", "qty_exp"))
    return rounded(median.grouped_median(rows, ratios.COMMODITY_YEAR, "uv", "uv_exp"))


@register(
    "q11_quantity_weights",
    f"""SELECT {KEY_SQL}, {O.rnd('1.0 / (greatest(qty_imp, qty_exp) / least(qty_imp, qty_exp))', 'cif_fob_weights')}
FROM mirror_t""",
)
def quantity_weights(fx, spark, sf_dir):
    out = ratios.add_quantity_weight(training.mirrored_reports(fx.flows))
    return rounded(out.select(*KEYS, "cif_fob_weights"))


# --- lookups ----------------------------------------------------------------------------------

RAW_CODES = ("ROM", "Yug", "TMP", "zar")


@register(
    "q12_fix_iso",
    f"""SELECT c_custkey, {O.FIX.format('raw')} AS iso3 FROM (
  SELECT c_custkey, lower(CASE c_nationkey % 7
    {' '.join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(RAW_CODES))}
    WHEN 4 THEN NULL ELSE upper({O.iso('c_nationkey')}) END) AS raw FROM customer) t""",
    derived=False,
)
def fix_iso(fx, spark, sf_dir):
    at = F.col("c_nationkey") % 7
    raw = F.when(at > 4, F.upper(iso("c_nationkey")))
    for i, c in enumerate(RAW_CODES):
        raw = raw.when(at == i, c)
    named = table(spark, sf_dir, "customer").select("c_custkey", raw.alias("iso3"))
    lowered = S.map_columns(named, ["string"], F.lower)
    return lowered.withColumn("iso3", codes.fix_iso_codes("iso3"))


GRAVITY = ("dist", "contig", "colony", "comlang_off", "landlocked_reporter", "landlocked_partner")


@register("q13_gravity_inner", f"SELECT {KEY_SQL}, {', '.join(GRAVITY)} FROM gravity_t")
def gravity_inner(fx, spark, sf_dir):
    base = comparable(fx).select(*KEYS)
    return gravity.add_gravity(base, fx.lookups.distances, fx.lookups.countries, "inner")


@register("q14_gravity_left", f"SELECT {KEY_SQL}, {', '.join(GRAVITY)} FROM gravity_i")
def gravity_left(fx, spark, sf_dir):
    base = converted(fx).select(*KEYS)
    return gravity.add_gravity(base, fx.lookups.distances, fx.lookups.countries, "left")


@register(
    "q15_rta_pair",
    f"""SELECT {", ".join("m." + k for k in KEYS)}, coalesce(r.rta, 0) AS rta FROM mirror_t m
LEFT JOIN rtas r ON r.year = m.year AND r.country1 = least(m.reporter_iso, m.partner_iso)
                AND r.country2 = greatest(m.reporter_iso, m.partner_iso)""",
)
def rta_pair(fx, spark, sf_dir):
    return gravity.add_rta(training.mirrored_reports(fx.flows).select(*KEYS), fx.lookups.rtas)


TRAINING_PLAIN = (
    "contig", "colony", "comlang_off", "landlocked_reporter", "landlocked_partner", "rta", "etfe",
    "itfe", "pair_id",
)
TRAINING_DOUBLES = [
    "uv_exp", "cif_fob_unit_ratio", "cif_fob_ratio", "cif_fob_weights", "dist",
    "log_cif_fob_unit_ratio", "log_dist", "log_dist_sq", "log_uv_exp",
]


@register(
    "q16_training_set",
    select_sql("training", f"{TRAINING_KEY_SQL}, {', '.join(TRAINING_PLAIN)}", TRAINING_DOUBLES),
)
def training_set(fx, spark, sf_dir):
    return rounded(
        training.training_set(fx.flows, fx.lookups, CUTOVER_YEAR, materialise, check=True)
    )


@register(
    "q17_unique_key_violations",
    f"SELECT {KEY_SQL}, count(*) AS n FROM converted GROUP BY {KEY_SQL} HAVING count(*) > 1",
)
def unique_key_violations(fx, spark, sf_dir):
    return checks.repeated_keys(converted(fx), KEYS)


# --- netting and quantities -------------------------------------------------------------------

MEASURE_SQL = ", ".join(O.rnd(c) for c in flows.MEASURES)


@register(
    "q18_net_reflows",
    f"""SELECT 'export' AS trade_flow, {KEY_SQL}, qty_unit, {MEASURE_SQL} FROM net_e
UNION ALL SELECT 'import', {KEY_SQL}, qty_unit, {MEASURE_SQL} FROM net_i""",
)
def net_reflows(fx, spark, sf_dir):
    def net(main: str, re: str, keys) -> DataFrame:
        columns = flows.FLOW_COLUMNS_WITH_WEIGHT
        return flows.net_reflows(
            flows.filter_flow(fx.flows, main, columns=columns),
            flows.filter_flow(fx.flows, re, columns=columns),
            keys,
        ).withColumn("trade_flow", F.lit(main))

    return rounded(
        net("export", "re-export", flows.EXPORT_KEYS).unionByName(
            net("import", "re-import", flows.IMPORT_KEYS)
        )
    )


@register(
    "q19_reported_by",
    f"SELECT {KEY_SQL}, qty_unit_exp, qty_unit_imp, reported_by FROM in_kg",
)
def reported_by(fx, spark, sf_dir):
    return flows.reported_by(converted(fx)).select(
        *KEYS, "qty_unit_exp", "qty_unit_imp", "reported_by"
    )


@register(
    "q20_quantity_kg",
    select_sql("in_kg", f"{KEY_SQL}, qty_unit_exp, qty_unit_imp", ["qty_exp", "qty_imp"]),
)
def quantity_kg(fx, spark, sf_dir):
    out = flows.quantity_in_kg(converted(fx))
    return rounded(out.select(*KEYS, "qty_unit_exp", "qty_unit_imp", "qty_exp", "qty_imp"))


# --- valuation --------------------------------------------------------------------------------


@register(
    "q21_valuation_clean",
    "SELECT year, reporter, iso3_digit_alpha, trade_flow, valuation, uncomtrade_id FROM valuation",
)
def valuation_clean(fx, spark, sf_dir):
    return valuation.clean_valuation(fx.valuation_raw, fx.country_codes)


@register(
    "q22_valuation_wide",
    "SELECT year, reporter_iso, exports_report, imports_report FROM valuation_wide",
)
def valuation_wide(fx, spark, sf_dir):
    return valuation.valuation_wide(
        valuation.clean_valuation(fx.valuation_raw, fx.country_codes)
    )


@register(
    "q23_unmatched_reporters",
    """SELECT DISTINCT reporter, iso3_digit_alpha FROM valuation WHERE iso3_digit_alpha IS NULL""",
)
def unmatched_reporters(fx, spark, sf_dir):
    return valuation.unmatched_reporters(
        valuation.clean_valuation(fx.valuation_raw, fx.country_codes)
    )


# --- regression -------------------------------------------------------------------------------

Y, W = training.RESPONSE, training.WEIGHT
X = ["log_dist"]


def moments(source: str, weight: str = "w") -> str:
    """Weighted sums about the weighted means, for one regressor."""
    return f"""
SELECT n, sw, mx, my, sxx, sxy, syy, sxy / sxx AS b, my - sxy / sxx * mx AS a,
       (syy - sxy * sxy / sxx) / (n - 2) AS s2
FROM (
  SELECT count(*) AS n, sum({weight}) AS sw, any_value(mx) AS mx, any_value(my) AS my,
         sum({weight} * (x - mx) * (x - mx)) AS sxx, sum({weight} * (x - mx) * (y - my)) AS sxy,
         sum({weight} * (y - my) * (y - my)) AS syy
  FROM {source}, (SELECT sum({weight} * x) / sum({weight}) AS mx,
                         sum({weight} * y) / sum({weight}) AS my FROM {source}) c) t"""


def diagnosed(source: str, moment: str) -> str:
    """Influence measures of a one-regressor fit."""
    return f"""
SELECT *, r * sqrt((n - 3) / (n - 2 - r * r)) AS stud_resid, r * r * hat / ((1 - hat) * 2) AS cooksd
FROM (SELECT *, sqrt(w) * residual / sqrt(s2 * (1 - hat)) AS r
      FROM (SELECT {source}.*, n, s2, a + b * x AS fitted, y - a - b * x AS residual,
                   w * (1 / sw + (x - mx) * (x - mx) / sxx) AS hat
            FROM {source}, {moment}) p) q"""


def kept(source: str, resid: str = "stud_resid") -> str:
    return f"{resid} < 2 AND cooksd < 4.0 / (n - 3) AND hat < 4.0 / n"


@register(
    "q24_ols_small",
    f"""SELECT '(Intercept)' AS term, {O.rnd('a', 'estimate')},
  {O.rnd('sqrt(s2 * (1 / sw + mx * mx / sxx))', 'std_error')}, n FROM m
UNION ALL SELECT 'log_dist', {O.val('b')}, {O.val('sqrt(s2 / sxx)')}, n FROM m""",
    {"m": moments("xyw")},
)
def ols_small(fx, spark, sf_dir):
    fit = ols.fit_wls(training_table(fx), Y, X, W)
    out = ols.coefficient_table(spark, fit).select("term", "estimate", "std_error")
    return rounded(out.withColumn("n", F.lit(fit.n).cast("long")))


@register(
    "q25_ols_year_effects",
    f"""SELECT '(Intercept)' AS term, {O.rnd('my - b * mx', 'estimate')} FROM g, s WHERE year = y0
UNION ALL SELECT 'log_dist', {O.val('b')} FROM s
UNION ALL SELECT 'year' || g.year, {O.val('(g.my - b * g.mx) - (z.my - b * z.mx)')}
FROM g, s, g z WHERE g.year <> y0 AND z.year = y0""",
    {
        "g": """SELECT year, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my FROM xyw GROUP BY year""",
        "s": """SELECT sum(w * (x - mx) * (y - my)) / sum(w * (x - mx) * (x - mx)) AS b, min(year) AS y0
                FROM xyw JOIN g USING (year)""",
    },
)
def ols_year_effects(fx, spark, sf_dir):
    fit = ols.fit_wls(training_table(fx), Y, X, W, training.GROUP)
    return rounded(ols.coefficient_table(spark, fit).select("term", "estimate"))


INFLUENCE = ["fitted", "residual", "hat", "std_resid", "stud_resid", "cooksd"]


@register(
    "q26_influence_small",
    f"""SELECT {TRAINING_KEY_SQL}, {O.rnd('fitted')}, {O.rnd('residual')}, {O.rnd('hat', digits=9)},
  {O.rnd('r', 'std_resid')}, {O.rnd('stud_resid')}, {O.rnd('cooksd', digits=9)} FROM d""",
    {"m": moments("xyw"), "d": diagnosed("xyw", "m")},
)
def influence_small(fx, spark, sf_dir):
    rows = training_table(fx)
    out = ols.influence(rows, ols.fit_wls(rows, Y, X, W))
    digits = {c: 9 if c in ("hat", "cooksd") else 6 for c in INFLUENCE}
    return out.select(
        *TRAINING_KEYS, *[nudged(F.col(c), d).alias(c) for c, d in digits.items()]
    )


def _rounds() -> dict[str, str]:
    blocks = {"d0": "SELECT x, y, w FROM xyw"}
    for i in range(4):
        blocks[f"m{i}"] = moments(f"d{i}")
        blocks[f"i{i}"] = diagnosed(f"d{i}", f"m{i}")
        blocks[f"d{i + 1}"] = f"SELECT x, y, w FROM i{i} WHERE {kept(f'i{i}')}"
    return blocks


@register(
    "q27_trim_rounds",
    " UNION ALL ".join(
        f"SELECT {i} AS fit, n, {O.val('a')} AS intercept, {O.val('b')} AS log_dist FROM m{i}"
        for i in range(4)
    ),
    _rounds(),
)
def trim_rounds(fx, spark, sf_dir):
    rows = ols.complete_rows(training_table(fx), Y, X, W, None)
    out, centre = [], None
    for i in range(4):
        fit = ols.fit_wls(rows, Y, X, W, centre=centre)
        out.append((i, fit.n, fit.intercept, fit.coefficient("log_dist")))
        centre, rows = fit.centre, ols.remove_outliers(rows, fit)
    return rounded(spark.createDataFrame(out, "fit int, n bigint, intercept double, log_dist double"))


@register(
    "q28_outlier_count",
    f"SELECT count(*) AS outliers FROM i3 WHERE NOT ({kept('i3', 'r')})",
    {k: v for k, v in _rounds().items() if k != "d4"},
)
def outlier_count(fx, spark, sf_dir):
    fit, _, rows = ols.fit_trimmed(training_table(fx), Y, X, W)
    return ols.count_outliers(rows, fit)


@register(
    "q29_predict",
    f"SELECT {TRAINING_KEY_SQL}, {O.rnd(O.PREDICTOR, 'fitted')} FROM training",
)
def predict(fx, spark, sf_dir):
    out = ols.predict(training_table(fx), M.OLS_MODEL, "fitted")
    return rounded(out.select(*TRAINING_KEYS, "fitted"))


# --- imputation -------------------------------------------------------------------------------

ROW_KEYS = [*KEYS, "qty_unit_exp", "qty_unit_imp"]
ROW_KEY_SQL = ", ".join(ROW_KEYS)


@register("q30_fob_label", select_sql("labelled", f"{ROW_KEY_SQL}, fobization", ["fitted_unit_ratio"]))
def fob_label(fx, spark, sf_dir):
    return rounded(labelled(fx).select(*ROW_KEYS, "fobization", "fitted_unit_ratio"))


@register(
    "q31_impute_trade",
    f"""SELECT {ROW_KEY_SQL}, flag AS exports_value, {O.rnd('fob', 'trade_value_usd_imp_fob', 3)},
  {O.rnd('value', 'trade_value_usd_exp_imputed', 3)} FROM imputed""",
)
def impute_trade(fx, spark, sf_dir):
    return rounded(
        labelled(fx).select(
            *ROW_KEYS, "exports_value", "trade_value_usd_imp_fob", "trade_value_usd_exp_imputed"
        ),
        3,
    )


@register("q32_zero_exporters", "SELECT year, reporter_iso FROM zero_exporters")
def zero_exporters(fx, spark, sf_dir):
    found = impute.zero_exporters(labelled(fx), 1.0 + M.OLS_MODEL.intercept)
    return found.filter("is_zero").select("year", "reporter_iso")


VALUES = ["trade_value_usd_exp", "trade_value_usd_imp"]


@register("q33_mirror_output", select_sql("harmonised", f"{KEY_SQL}, flag", VALUES, 3))
def mirror_output(fx, spark, sf_dir):
    return rounded(harmonised(fx), 3)


@register(
    "q34_imputation_summary",
    f"""SELECT year, flag, count(*) AS n,
  {O.rnd('count(*) / CAST(sum(count(*)) OVER (PARTITION BY year) AS DOUBLE)', 'm', 9)}
FROM harmonised GROUP BY year, flag""",
)
def imputation_summary(fx, spark, sf_dir):
    out = imputation.impute_flows(fx.flows, fx.lookups, M.OLS_MODEL, CUTOVER_YEAR)
    return rounded(imputation.imputation_summary(out), 9)


@register("q35_flag_list", "SELECT DISTINCT flag FROM harmonised")
def flag_list(fx, spark, sf_dir):
    return imputation.flag_list(harmonised(fx))


@register(
    "q36_pair_total",
    f"""SELECT {O.rnd('coalesce(sum(trade_value_usd_exp), 0.0)', 'trade_value_usd_exp', 3)}
FROM harmonised WHERE year = 1999 AND reporter_iso = 'n03' AND partner_iso = 'n05'""",
)
def pair_total(fx, spark, sf_dir):
    return rounded(imputation.pair_total(harmonised(fx), 1999, "n03", "n05"), 3)


@register(
    "q37_backfill_years",
    """SELECT DISTINCT year FROM flows EXCEPT SELECT DISTINCT year FROM flows WHERE year < 1999""",
)
def backfill_years(fx, spark, sf_dir):
    path = scratch_path(spark, "backfill")
    rows = flows.filter_flow(fx.flows, "export").filter(F.col("year") < 1999)
    tables.write_by_year(rows, path)
    return tables.missing_years(fx.flows.select("year"), tables.present_years(spark, path))


# --- second model and tests -------------------------------------------------------------------

NEWTON_STEPS = 7


def newton(source: str, squared: bool) -> dict[str, str]:
    """Poisson fit of y on 1, z (and z squared), z = x about its mean; one block per step."""
    blocks = {
        "p": f"""SELECT y, x - (SELECT avg(x) FROM {source}) AS z FROM {source}""",
        "b0": "SELECT ln(avg(y)) AS a, 0.0 AS b, 0.0 AS c FROM p",
    }
    for i in range(1, NEWTON_STEPS + 1):
        sums = f"""SELECT any_value(a) AS a, any_value(b) AS b, any_value(c) AS c,
  sum(mu) AS s0, sum(mu * z) AS s1, sum(mu * z * z) AS s2, sum(mu * z * z * z) AS s3,
  sum(mu * z * z * z * z) AS s4, sum(y - mu) AS g0, sum((y - mu) * z) AS g1, sum((y - mu) * z * z) AS g2
FROM (SELECT y, z, a, b, c, exp(a + b * z + c * z * z) AS mu FROM p, b{i - 1}) t"""
        if squared:
            blocks[f"b{i}"] = f"""
SELECT a + (g0 * (s2 * s4 - s3 * s3) - s1 * (g1 * s4 - s3 * g2) + s2 * (g1 * s3 - s2 * g2)) / det AS a,
       b + (s0 * (g1 * s4 - s3 * g2) - g0 * (s1 * s4 - s3 * s2) + s2 * (s1 * g2 - g1 * s2)) / det AS b,
       c + (s0 * (s2 * g2 - g1 * s3) - s1 * (s1 * g2 - g1 * s2) + g0 * (s1 * s3 - s2 * s2)) / det AS c,
       (s0 * s2 - s1 * s1) / det AS vc
FROM (SELECT *, s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2) AS det
      FROM ({sums}) u) v"""
        else:
            blocks[f"b{i}"] = f"""
SELECT a + (g0 * s2 - s1 * g1) / det AS a, b + (s0 * g1 - s1 * g0) / det AS b, 0.0 AS c,
       s2 / det AS va, s0 / det AS vb, -s1 / det AS vab
FROM (SELECT *, s0 * s2 - s1 * s1 AS det FROM ({sums}) u) v"""
    last = f"b{NEWTON_STEPS}"
    blocks["q"] = f"""
SELECT count(*) AS n, sum((y - mu) * (y - mu) / mu) AS pearson, corr(y, mu) AS r
FROM (SELECT y, exp(a + b * z + c * z * z) AS mu FROM p, {last}) t"""
    return blocks


PPML_Y = "cif_fob_unit_ratio"


@register(
    "q38_ppml",
    f"""SELECT '(Intercept)' AS term, {O.rnd('a - b * xm', 'estimate')},
  {O.rnd('sqrt(pearson / (n - 2) * (va - 2 * xm * vab + xm * xm * vb))', 'std_error')},
  {O.rnd('r * r', 'pseudo_r_squared')} FROM k
UNION ALL SELECT 'log_dist', {O.val('b')}, {O.val('sqrt(pearson / (n - 2) * vb)')},
  {O.val('r * r')} FROM k""",
    {
        "xy": "SELECT log_dist AS x, cif_fob_unit_ratio AS y FROM training",
        **newton("xy", False),
        "k": f"SELECT *, (SELECT avg(x) FROM xy) AS xm FROM b{NEWTON_STEPS}, q",
    },
)
def ppml_small(fx, spark, sf_dir):
    fit = ppml.fit_ppml(training_table(fx), PPML_Y, X)
    rows = [
        (t, b, s, fit.pseudo_r_squared) for t, b, s in zip(fit.terms, fit.estimate, fit.std_error)
    ]
    return rounded(
        spark.createDataFrame(
            rows, "term string, estimate double, std_error double, pseudo_r_squared double"
        )
    )


def normal_tail(z: str) -> str:
    """P(|Z| > |z|) by a rational approximation, good to seven decimals (z is used often)."""
    # Coefficients of the approximation of the complementary error function.
    a = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    x = f"(abs({z}) / sqrt(2.0))"
    t = f"(1 / (1 + 0.3275911 * {x}))"
    return f"exp(-{x} * {x}) * (" + " + ".join(f"({c}) * pow({t}, {i})" for i, c in enumerate(a, 1)) + ")"


# the normal quantile that belongs to a t statistic, for the many degrees of freedom there are here
Z_OF_F = "sqrt(f) * (1 - (f + 1) / (4 * df2) + (13 * f * f + 8 * f + 3) / (96 * df2 * df2))"


@register(
    "q39_reset_ols",
    f"""SELECT {O.rnd('f', 'statistic')}, df1, df2, {O.rnd(normal_tail(f'({Z_OF_F})'), 'p_value', 4)} FROM (
  SELECT (rss0 - rss1) / (rss1 / (n - 3)) AS f, CAST(1.0 AS DOUBLE) AS df1,
  CAST(n - 3 AS DOUBLE) AS df2 FROM (
  SELECT n, rss0, rss0 - suv * suv / suu AS rss1 FROM (
    SELECT any_value(n) AS n, any_value(syy - sxy * sxy / sxx) AS rss0,
           sum(u * u) AS suu, sum(u * (y - my - b * (x - mx))) AS suv FROM v) t) s) o""",
    {
        "d": "SELECT x, y, CAST(1.0 AS DOUBLE) AS w FROM xyw",
        "m": moments("d"),
        # the square of x, free of 1 and x
        "sq": """SELECT avg(z2) AS mz, sum((x - mx) * z2) / any_value(sxx) AS bz
                 FROM (SELECT x, mx, sxx, (x - mx) * (x - mx) AS z2 FROM d, m) t""",
        "v": "SELECT d.*, m.*, (x - mx) * (x - mx) - mz - bz * (x - mx) AS u FROM d, m, sq",
    },
)
def reset_ols(fx, spark, sf_dir):
    rows = training_table(fx)
    test = ols.reset_test(rows, ols.fit_wls(rows, Y, X, W))
    schema = "statistic double, df1 double, df2 double, p_value double"
    out = spark.createDataFrame([tuple(test[c.split()[0]] for c in schema.split(", "))], schema)
    return out.withColumns({c: nudged(F.col(c), 4 if c == "p_value" else 6) for c in out.columns})


@register(
    "q40_reset_ppml",
    f"""SELECT {O.rnd('z', 'statistic', 4)}, {O.rnd(normal_tail('z'), 'p_value', 4)}
FROM (SELECT c / sqrt(pearson / (n - 3) * vc) AS z FROM b{NEWTON_STEPS}, q) t""",
    {"xy": "SELECT log_dist AS x, cif_fob_unit_ratio AS y FROM training", **newton("xy", True)},
)
def reset_ppml(fx, spark, sf_dir):
    rows = training_table(fx)
    test = ppml.reset_ppml(rows, ppml.fit_ppml(rows, PPML_Y, X))
    out = [(test["statistic"], test["p_value"])]
    return rounded(spark.createDataFrame(out, "statistic double, p_value double"), 4)


STEEP = f"{M.STEEP_INTERCEPT!r} + ({M.STEEP_SLOPE!r}) * log_dist"


@register(
    "q41_negative_fits",
    f"""SELECT count(*) FILTER ({STEEP} < 0) AS ols_negative_fitted,
  count(*) FILTER (exp({STEEP}) < 1) AS ppml_negative_fitted FROM training""",
)
def negative_fits(fx, spark, sf_dir):
    return analysis.negative_fits(training_table(fx), M.STEEP_MODEL, M.STEEP_MODEL)


# --- pages and text ---------------------------------------------------------------------------


@register(
    "q43_page_elements",
    r"""SELECT page_id, CAST(i - 1 AS INTEGER) AS position, texts[i] AS text, links[i] AS value
FROM (SELECT page_id, texts, links, unnest(generate_series(1, len(texts))) AS i FROM (
  SELECT page_id, regexp_extract_all(nav, '<a href="[^"]*">([^<]*)</a>', 1) AS texts,
         regexp_extract_all(nav, '<a href="([^"]*)">', 1) AS links
  FROM (SELECT page_id, regexp_extract(html, '<nav>(.*?)</nav>', 1, 's') AS nav FROM pages) a) b) c""",
    derived=False,
)
def page_elements(fx, spark, sf_dir):
    return pages.extract_elements(
        table(spark, sf_dir, "pages"), "nav", "a", "href", keys=["page_id"]
    )


def note_pages(customer: DataFrame) -> DataFrame:
    """A notes page per customer, as a statistics office might serve it."""

    def row(tag: str, *cells: Column | str) -> Column:
        parts = [F.lit("<tr class='r'>")]
        for c in cells:
            parts += [F.lit(f"<{tag}>"), F.lit(c) if isinstance(c, str) else c, F.lit(f"</{tag}>")]
        return F.concat(*parts, F.lit("</tr>\n"))

    name = F.concat(F.col("c_name"), F.lit(" &amp; Co (<i>former</i>)"))
    system = F.when(F.col("c_nationkey") % 6 == 0, "FOB").otherwise("CIF")
    html = F.concat(
        F.lit("<html><table class='menu'><tr><td>menu</td></tr></table>"),
        F.lit("<table id='notes' border=1>\n"),
        row("th", "Reporter", " Trade Flow ", "Valuation", "Currency Code"),
        row("td", name, "Import", system, "USD"),
        row("td", name, "Export", F.lit("FOB"), "USD"),
        F.lit("<tr><td>1</td></tr></table></html>"),
    )
    return customer.select(F.col("c_custkey").alias("r"), html.alias("html"))


NOTE_SQL = "c_name || ' & Co (former)'"


@register(
    "q44_page_tables",
    f"""SELECT c_custkey AS r, 0 AS position, {NOTE_SQL} AS reporter, 'Import' AS trade_flow,
  CASE WHEN c_nationkey % 6 = 0 THEN 'FOB' ELSE 'CIF' END AS valuation, 'USD' AS currency_code FROM customer
UNION ALL SELECT c_custkey, 1, {NOTE_SQL}, 'Export', 'FOB', 'USD' FROM customer""",
    derived=False,
)
def page_tables(fx, spark, sf_dir):
    found = pages.extract_table(
        note_pages(table(spark, sf_dir, "customer")),
        ["reporter", "trade_flow", "valuation", "currency_code"],
        table_attrs={"id": "notes"},
        keys=["r"],
    )
    return pages.drop_pager_rows(found)


@register(
    "q45_split_ids",
    """SELECT o_custkey AS id FROM orders UNION SELECT o_orderkey % 1000 FROM orders""",
    derived=False,
)
def split_ids(fx, spark, sf_dir):
    listed = F.concat_ws(
        ",", F.col("o_custkey").cast("string"), F.lit("all"), (F.col("o_orderkey") % 1000).cast("string")
    )
    ids = pages.split_ids(table(spark, sf_dir, "orders").select(listed.alias("ids")), "ids")
    return ids.select(F.col("id").cast("long").alias("id"))


@register("q46_write_read", select_sql("harmonised", f"{KEY_SQL}, flag", VALUES, 3))
def write_read(fx, spark, sf_dir):
    path = scratch_path(spark, "harmonised")
    tables.write_by_year(harmonised(fx), path)
    one = tables.read_year(spark, path, 1996, schemas.HARMONISED)
    others = tables.read_by_year(spark, path).filter(F.col("year") != 1996)
    return rounded(one.unionByName(others), 3)


@register(
    "q47_csv_round_trip",
    f"""SELECT year, reporter_iso, sum(n) AS n, {O.rnd('sum(v)', 'trade_value_usd', 3)} FROM (
  SELECT year, reporter_iso, count(*) AS n, sum(trade_value_usd) AS v FROM exports
  GROUP BY year, reporter_iso) t GROUP BY year, reporter_iso""",
)
def csv_round_trip(fx, spark, sf_dir):
    path = scratch_path(spark, "csv")
    totals = (
        flows.filter_flow(fx.flows, "export")
        .groupBy("year", "reporter_iso")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("trade_value_usd").alias("trade_value_usd"))
    )
    tables.write_csv_by_year(totals, path)
    schema = "reporter_iso string, n bigint, trade_value_usd double, year int"
    return rounded(tables.read_csv_dir(spark, path, schema), 3)


@register(
    "q48_model_store",
    f"SELECT {TRAINING_KEY_SQL}, {O.rnd('(SELECT a FROM m) + (SELECT b FROM m) * x', 'fitted')} FROM xyw",
    {"m": moments("xyw")},
)
def model_store(fx, spark, sf_dir):
    path = scratch_path(spark, "model")
    rows = training_table(fx)
    ols.save_fit(spark, ols.fit_wls(rows, Y, X, W), path)
    out = ols.predict(rows, ols.load_model(spark, path), "fitted")
    return rounded(out.select(*TRAINING_KEYS, "fitted"))


@register(
    "q49_ppml_year_effects",
    f"""SELECT '(Intercept)' AS term, {O.rnd('ln(m)', 'estimate')} FROM g WHERE year = (SELECT min(year) FROM g)
UNION ALL SELECT 'year' || g.year, {O.val('ln(g.m / z.m)')} FROM g, g z
WHERE z.year = (SELECT min(year) FROM g) AND g.year <> z.year""",
    {"g": "SELECT year, avg(cif_fob_unit_ratio) AS m FROM training GROUP BY year"},
)
def ppml_year_effects(fx, spark, sf_dir):
    fit = ppml.fit_ppml(training_table(fx), PPML_Y, [], training.GROUP)
    rows = list(zip(fit.terms, fit.estimate))
    return rounded(spark.createDataFrame(rows, "term string, estimate double"))


# --- the whole model --------------------------------------------------------------------------

MODEL_ROWS = (
    "SELECT "
    + ", ".join(f"CAST({x} AS DOUBLE) AS x{j}" for j, x in enumerate(training.REGRESSORS, 1))
    + f", {Y} AS y, {W} AS w, year FROM training"
)


@register(
    "q51_model_rounds",
    " UNION ALL ".join(model_sql.coefficient_sql(t, training.REGRESSORS, f"_{t}") for t in range(4)),
    {"mz_d0": MODEL_ROWS, **{k: v for k, v in model_sql.trimmed_blocks("mz_d0", 6, 3).items() if k != "mz_d4"}},
)
def model_rounds(fx, spark, sf_dir):
    """The full model at each of the four fits."""
    rows = ols.complete_rows(training_table(fx), Y, training.REGRESSORS, W, training.GROUP)
    out, centre = [], None
    for t in range(4):
        fit = ols.fit_wls(rows, Y, training.REGRESSORS, W, training.GROUP, centre)
        for term, b, error in zip(fit.terms, fit.estimate, fit.std_error):
            level = term.startswith(training.GROUP)
            out.append((t, term, b, None if level else error, fit.n, fit.r_squared))
        centre = fit.centre
        if t < 3:
            rows = ols.remove_outliers(rows, fit)
    schema = "fit int, term string, estimate double, std_error double, n bigint, r_squared double"
    return rounded(spark.createDataFrame(out, schema))


@register(
    "q52_model_outliers",
    f"""SELECT count(*) AS outliers FROM mz_i_3
WHERE NOT (r < 2 AND cook < 4.0 / (n - p - 1) AND hat < 2.0 * p / n)""",
    {"mz_d0": MODEL_ROWS, **{k: v for k, v in model_sql.trimmed_blocks("mz_d0", 6, 3).items() if k != "mz_d4"}},
)
def model_outliers(fx, spark, sf_dir):
    fit, _ = training.fit_model(training_table(fx))
    return spark.createDataFrame([(fit.outliers,)], "outliers bigint")


TRIMMED = {"mz_d0": MODEL_ROWS, **{k: v for k, v in model_sql.trimmed_blocks("mz_d0", 6, 3).items() if k not in ("mz_i_3", "mz_d4")}}
POISSON_ROWS = MODEL_ROWS.replace(f"{Y} AS y", f"{PPML_Y} AS y")
MODEL_YEARS = sorted(map(int, M.YEAR_EFFECTS))
OLS_DENSE = dense_sql.Dense("mz_d3", 6, MODEL_YEARS, "o")
PPML_DENSE = dense_sql.Dense("mz_q0", 6, MODEL_YEARS, "q")


def exact_tail(z: str) -> str:
    """P(|Z| > |z|) by Simpson's rule; next to nothing beyond 9."""
    x, n = f"least(abs({z}), 9.0)", 600
    weights = f"CASE WHEN i = 0 OR i = {n} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    area = f"list_sum(list_transform(range({n + 1}), lambda i: ({weights}) * exp(-0.5 * pow({x} * i / {n}, 2))))"
    return f"(1 - sqrt(2 / pi()) * {x} / {3 * n} * {area})"


def t_tail(t: str, df: str) -> str:
    """P-value of a t statistic, by the normal quantile that belongs to it."""
    f = f"(({t}) * ({t}))"
    return exact_tail(f"(abs({t}) * (1 - ({f} + 1) / (4 * {df}) + (13 * {f} * {f} + 8 * {f} + 3) / (96 * {df} * {df})))")


@register(
    "q42_coefficient_table",
    OLS_DENSE.terms("ols", training.REGRESSORS, "rss / (n - rank)", "ols", t_tail)
    + " UNION ALL "
    + PPML_DENSE.terms("ppml", training.REGRESSORS, "pearson / (n - rank)", "ppml", lambda z, df: exact_tail(f"({z})")),
    {
        **TRIMMED, **OLS_DENSE.blocks, **OLS_DENSE.least_squares("mz_ro", "w", "ols"),
        "mz_q0": POISSON_ROWS, **PPML_DENSE.blocks, **PPML_DENSE.poisson("mz_rq", "ppml"),
    },
)
def coefficient_table(fx, spark, sf_dir):
    rows = training_table(fx)
    fit, _ = training.fit_model(rows)
    poisson = ppml.fit_ppml(rows, PPML_Y, training.REGRESSORS, training.GROUP)
    out = analysis.coefficient_comparison(spark, fit, poisson)
    return out.withColumns(
        {c: nudged(F.col(c), 6 if c in ("estimate", "std_error") else 4) for c in out.columns[2:]}
    )


RESET_OLS = dense_sql.Dense("mz_d3", 6, MODEL_YEARS, "o", ["sq"])
RESET_PPML = dense_sql.Dense("mz_q0", 6, MODEL_YEARS, "q", ["sq"])


def metric(name: str, value: str, source: str, digits: int = 6) -> str:
    return f"SELECT '{name}' AS metric, {O.val(value, digits)} AS value FROM {source}"


@register(
    "q50_model_analysis",
    " UNION ALL ".join([
        metric("ols_reset_pvalue", exact_tail(f"({Z_OF_F})"), "mz_f", 4),
        metric("ppml_reset_pvalue", exact_tail(f"(t[{RESET_PPML.p}] / sqrt(pearson / (n - rank) * inv[{RESET_PPML.p}][{RESET_PPML.p}]))"), "mz_more", 4),
        metric("ppml_pseudo_rsq", "r * r", "mz_ppml"),
        metric("ols_r_squared", "1 - rss / tss", "mz_ols"),
        metric("ols_n", "n", "mz_ols"),
        metric("ppml_n", "n", "mz_ppml"),
        metric("ols_negative_fitted", f"count(*) FILTER ({OLS_DENSE.index()} < 0)", "mz_ro, mz_ols"),
        metric("ppml_negative_fitted", f"count(*) FILTER (exp({PPML_DENSE.index()}) < 1)", "mz_rq, mz_ppml"),
    ]),
    {
        **TRIMMED, **OLS_DENSE.blocks, **OLS_DENSE.least_squares("mz_ro", "w", "ols"),
        "mz_q0": POISSON_ROWS, **PPML_DENSE.blocks, **PPML_DENSE.poisson("mz_rq", "ppml"),
        **OLS_DENSE.least_squares("mz_ro", "1.0", "plain"),
        "mz_power": f"SELECT mz_ro.*, pow({OLS_DENSE.index()} - (SELECT avg(y) FROM mz_ro), 2) AS sq FROM mz_ro, mz_plain",
        **RESET_OLS.least_squares("mz_power", "1.0", "wider"),
        "mz_f": "SELECT (a.rss - b.rss) / (b.rss / (b.n - b.rank)) AS f, b.n - b.rank AS df2 FROM mz_plain a, mz_wider b",
        "mz_iq": f"SELECT mz_rq.*, {PPML_DENSE.index()} AS ix FROM mz_rq, mz_ppml",
        "mz_sqp": "SELECT *, pow(ix - (SELECT avg(ix) FROM mz_iq), 2) AS sq FROM mz_iq",
        **RESET_PPML.poisson("mz_sqp", "more"),
    },
)
def model_analysis(fx, spark, sf_dir):
    rows = training_table(fx)
    fit, _, used = ols.fit_trimmed(rows, Y, training.REGRESSORS, W, training.GROUP)
    poisson = ppml.fit_ppml(rows, PPML_Y, training.REGRESSORS, training.GROUP)
    out = analysis.model_analysis(used, rows, fit, poisson)
    tail = F.col("metric").endswith("reset_pvalue")
    return out.withColumn("value", F.when(tail, nudged(F.col("value"), 4)).otherwise(nudged(F.col("value"), 6)))


# --- absorbed effects -------------------------------------------------------------------------

ABSORBED_X = ["log_dist", "log_uv_exp"]
EFFECTS = ["etfe", "itfe"]


def absorbed_rows(y: str) -> str:
    return f"""SELECT row_number() OVER () AS id, year, exporter_iso, importer_iso, {y} AS y, log_dist AS x1, log_uv_exp AS x2, {W} AS w
FROM training WHERE isfinite({y}) AND isfinite(log_dist) AND isfinite(log_uv_exp) AND {W} > 0"""


# exporters and importers meet within a year, so a level is redundant in every year
ABSORBED_RANK = """(SELECT count(DISTINCT (year, exporter_iso)) + count(DISTINCT (year, importer_iso)) - count(DISTINCT year) + 2 FROM mz_a)"""


def absorbed_terms(block: str, s2: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{x}' AS term, {O.val(f'b{j}')} AS estimate, {O.val(f'sqrt({s2} * v{j}{j})')} AS std_error, n, {ABSORBED_RANK} AS rank FROM {block}"""
        for j, x in enumerate(ABSORBED_X, 1)
    )


def absorbed_table(spark: SparkSession, fit: absorb.AbsorbedFit) -> DataFrame:
    rows = [(x, b, e, fit.n, fit.rank) for x, b, e in zip(fit.x, fit.estimate, fit.std_error)]
    return rounded(spark.createDataFrame(rows, "term string, estimate double, std_error double, n bigint, rank bigint"))


@register(
    "q61_absorbed_effects",
    absorbed_terms("mz_b", f"(syy - b1 * s1y - b2 * s2y) / (n - {ABSORBED_RANK})"),
    {
        "mz_a": absorbed_rows(Y),
        **dense_sql.two_effects("mz_a", "year", "exporter_iso", "importer_iso", ["x1", "x2", "y"], "_a"),
        "mz_b": dense_sql.two_slopes("mz_o_a", "y", "count(*) AS n"),
    },
)
def absorbed_effects(fx, spark, sf_dir):
    """The weighted model with an effect per exporter and year and one per importer and year."""
    return absorbed_table(spark, absorb.fit_absorbed(training_table(fx), Y, ABSORBED_X, EFFECTS, W))


@register(
    "q62_absorbed_ppml",
    absorbed_terms("mz_pb9", f"(SELECT sum((y - mu) * (y - mu) / mu) FROM mz_pw9) / (n - {ABSORBED_RANK})"),
    {"mz_a": absorbed_rows(PPML_Y), **dense_sql.absorbed_poisson("mz_a", "year", "exporter_iso", "importer_iso")},
)
def absorbed_ppml(fx, spark, sf_dir):
    return absorbed_table(spark, absorb.fit_absorbed_ppml(training_table(fx), PPML_Y, ABSORBED_X, EFFECTS))


YEAR_FIT = {
    "mz_fy": "SELECT year, sum(w) AS sw, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my FROM xyw GROUP BY year",
    "mz_fs": """SELECT sum(w * (x - mx) * (y - my)) / sum(w * (x - mx) * (x - mx)) AS b
                FROM xyw JOIN mz_fy USING (year)""",
    "mz_fa": "SELECT year, my - b * mx AS a, b FROM mz_fy, mz_fs",
    **model_sql.imputation_blocks(
        "(SELECT a + b * p.log_dist FROM mz_fa WHERE mz_fa.year = p.year)",
        "1 + (SELECT a FROM mz_fa WHERE year = (SELECT min(year) FROM mz_fa))",
    ),
}


@register(
    "q53_fit_store_impute",
    f"""SELECT year, flag, count(*) AS n, {O.rnd('sum(trade_value_usd_exp) / 1e6', 'millions', 2)},
  {O.rnd('sum(trade_value_usd_imp) / 1e6', 'millions_mirror', 2)} FROM harmonised_m GROUP BY year, flag""",
    YEAR_FIT,
)
def fit_store_impute(fx, spark, sf_dir):
    """From the regression table to the harmonised one by way of a stored model."""
    path = scratch_path(spark, "model")
    ols.save_fit(spark, ols.fit_wls(training_table(fx), Y, X, W, training.GROUP), path)
    out = imputation.impute_flows(fx.flows, fx.lookups, ols.load_model(spark, path), CUTOVER_YEAR)
    totals = out.groupBy("year", "flag").agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum("trade_value_usd_exp") / 1e6).alias("millions"),
        (F.sum("trade_value_usd_imp") / 1e6).alias("millions_mirror"),
    )
    return rounded(totals, 2)


# --- files ------------------------------------------------------------------------------------


@register(
    "q54_partition_values",
    """SELECT CAST(year AS VARCHAR) AS year, count(*) AS n FROM flows
WHERE trade_flow = 'export' GROUP BY year""",
)
def partition_values(fx, spark, sf_dir):
    """Years taken from the names of the directories the rows lie in."""
    rows = flows.filter_flow(fx.flows, "export").select(
        codes.strip_partition_key(F.regexp_extract(F.input_file_name(), "/(year=[^/]*)/", 1)).alias("year")
    )
    return rows.groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@register("q55_load_or_build", "SELECT hs02, hs12 FROM xwalk_first")
def load_or_build(fx, spark, sf_dir):
    """Built at the first call; the second one has to find the table."""
    path = scratch_path(spark, "built")

    def never() -> DataFrame:
        raise AssertionError("the table is there already")

    tables.load_or_build(spark, path, lambda: flows.first_crosswalk(fx.hs_crosswalk))
    return tables.load_or_build(spark, path, never)


@register(
    "q56_single_csv",
    f"""SELECT year, flag, count(*) AS n,
  {O.rnd('count(*) / CAST(sum(count(*)) OVER (PARTITION BY year) AS DOUBLE)', 'm', 9)}
FROM harmonised GROUP BY year, flag""",
)
def single_csv(fx, spark, sf_dir):
    path = scratch_path(spark, "summary")
    tables.write_single_csv(imputation.imputation_summary(harmonised(fx)), path)
    schema = "year int, flag string, n bigint, m double"
    read = tables.read_csv_dir(spark, path, schema)
    if len(read.inputFiles()) != 1:
        raise AssertionError("the summary is not one file")
    return rounded(read, 9)


@register(
    "q57_sorted_valuation",
    """SELECT year, reporter, row_number() OVER (ORDER BY year NULLS FIRST, reporter NULLS FIRST) - 1 AS position
FROM valuation""",
)
def sorted_valuation(fx, spark, sf_dir):
    """Positions in the sorted lookup table, from ranges of its order."""
    clean = valuation.clean_valuation(fx.valuation_raw, fx.country_codes)
    in_order = ranks.add_position(clean, ["year", "reporter"], "position")
    return in_order.select("year", "reporter", "position")


@register(
    "q58_backfill_written",
    f"""SELECT year, count(*) AS n, {O.rnd('sum(trade_value_usd)', 'trade_value_usd', 3)}
FROM exports GROUP BY year""",
)
def backfill_written(fx, spark, sf_dir):
    """Years written before stay, the missing ones are added by a dynamic overwrite."""
    path = scratch_path(spark, "backfill")
    rows = flows.filter_flow(fx.flows, "export")
    tables.write_by_year(rows.filter(F.col("year") < 1999), path)
    years = [r["year"] for r in rows.select("year").distinct().collect()]
    built = tables.backfill(spark, path, years, lambda todo: rows.filter(F.col("year").isin(todo)))
    if any(y < 1999 for y in built):
        raise AssertionError("a year that was there has been built again")
    back = tables.read_by_year(spark, path)
    totals = back.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("trade_value_usd").alias("trade_value_usd")
    )
    return rounded(totals, 3)


@register(
    "q59_missing_kept",
    select_sql("mz_kept_missing", f"{KEY_SQL}, qty_unit_exp, qty_unit_imp", O.I_SUMS),
    {
        "mz_kept_missing": re.sub(r"coalesce\((sum\([^)]*\)), 0.0\)", r"\1", O.CTES["converted"]),
    },
)
def missing_kept(fx, spark, sf_dir):
    """Conversion that keeps a side nobody reported missing."""
    return rounded(
        imputation.converted_mirror(fx.flows, fx.hs_crosswalk, CUTOVER_YEAR, missing_as_zero=False)
    )


@register(
    "q60_ppml_store",
    f"""SELECT {TRAINING_KEY_SQL}, {O.rnd('ln(m)', 'fitted')} FROM training JOIN (
  SELECT year, avg(cif_fob_unit_ratio) AS m FROM training GROUP BY year) g USING (year)""",
)
def ppml_store(fx, spark, sf_dir):
    path, rows = scratch_path(spark, "ppml"), training_table(fx)
    ppml.save_ppml(spark, ppml.fit_ppml(rows, PPML_Y, [], training.GROUP), path)
    out = ols.predict(rows, ppml.load_ppml(spark, path).model, "fitted")
    return rounded(out.select(*TRAINING_KEYS, "fitted"))


# --- nested and spanning cells ----------------------------------------------------------------


def account_pages(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """A page per nation: one cell names it beside the rows of all its suppliers, one title is above two columns,
    and a cell of each row holds a table of its own."""
    line = F.struct(
        "s_suppkey",
        F.concat(
            F.lit("<td>"), F.col("s_name"), F.lit("<table class='notes'><tr><td> of </td><td>"), F.concat(F.lit("no "), F.col("s_suppkey").cast("string")),
            F.lit("</td></tr></table></td><td>"), F.floor("s_acctbal").cast("string"), F.lit("<td>"),
            F.col("s_suppkey").cast("string"), F.lit("</td>"),
        ).alias("cells"),
    )
    lines = supplier.groupBy("s_nationkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    spanned = F.concat(
        F.lit("<td rowspan=\""), F.size("lines").cast("string"), F.lit("\">"), F.col("n_name"), F.lit("</td>")
    )
    rows = F.transform("lines", lambda x, i: F.concat(F.lit("<tr>"), F.when(i == 0, spanned).otherwise(F.lit("")), x["cells"], F.lit("</tr>\n")))
    html = F.concat(
        F.lit("</table><div><table id=outer><tr><td><table id='accounts' data-x=\"a > b\"><tr><th>Nation<th>Name"),
        F.lit("<th colspan=2>Account</tr>\n"), F.array_join(rows, ""), F.lit("</table></td></tr></table></div>"),
    )
    return lines.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("n_nationkey", html.alias("html"))


@register(
    "q63_spanning_cells",
    """SELECT n_nationkey, CAST(row_number() OVER (PARTITION BY n_nationkey ORDER BY s_suppkey) - 1 AS INT) AS position, n_name AS nation,
  s_name || ' of no ' || s_suppkey AS name, CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR) AS account, CAST(s_suppkey AS VARCHAR) AS account_2
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    derived=False,
)
def spanning_cells(fx, spark, sf_dir):
    made = account_pages(table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation"))
    return pages.extract_table(made, ["nation", "name", "account", "account_2"], {"id": "accounts"}, keys=["n_nationkey"])


@register(
    "q64_nested_tables",
    """SELECT n_nationkey, 0 AS position, 'of' AS first, 'no ' || k AS second FROM (
  SELECT s_nationkey, min(s_suppkey) AS k FROM supplier GROUP BY s_nationkey) JOIN nation ON s_nationkey = n_nationkey""",
    derived=False,
)
def nested_tables(fx, spark, sf_dir):
    """The inner table by its class: the first one of each page, below a header put in front."""
    made = account_pages(table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation"))
    headed = F.replace(F.col("html"), F.lit("<table class='notes'>"), F.lit("<table class='x notes'><tr><th>First</th><th>Second</th></tr>"))
    return pages.extract_table(made.withColumn("html", headed), ["first", "second"], {"class": "notes"}, keys=["n_nationkey"])


# --- hot keys, checks within a job, files of uneven quality -------------------------------------


@register(
    "q65_hot_full_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS l_key, o_key, o_totalprice
FROM lineitem FULL JOIN (SELECT CASE WHEN o_orderkey % 7 = 1 THEN NULL ELSE o_orderkey END AS o_key, o_totalprice FROM orders WHERE o_orderkey % 5 <> 2
  UNION ALL SELECT 0, -1.0) o ON CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END IS NOT DISTINCT FROM o_key""",
    derived=False,
)
def hot_full_join(fx, spark, sf_dir):
    """Line items with their orders, where one key has a third of the lines and null a seventh of the orders."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_orderkey")).cast("long").alias("l_key"),
    )
    placed = table(spark, sf_dir, "orders").filter("o_orderkey % 5 <> 2").select(
        F.when(F.col("o_orderkey") % 7 != 1, F.col("o_orderkey").cast("long")).alias("o_key"), F.col("o_totalprice").cast("double").alias("o_totalprice")
    )
    placed = placed.unionByName(spark.range(1).select(F.col("id").alias("o_key"), F.lit(-1.0).alias("o_totalprice")))
    left, right = materialise(lines, "lines"), materialise(placed, "placed")

    def columns(l: str, r: str) -> list[Column]:
        return [F.col(f"{l}.{c}") for c in left.columns] + [F.col(f"{r}.{c}") for c in right.columns]

    return hotkeys.full_join(left, right, [("l_key", "o_key")], columns)


@register("q66_observed_share", REMAINING_SHARE)
def observed_share(fx, spark, sf_dir):
    """The share of q05, counted by the job that writes the comparable flows."""
    years = [r["year"] for r in fx.flows.select("year").distinct().collect()]
    _, share = training.observed_comparable(fx.flows, fx.hs_crosswalk, CUTOVER_YEAR, sorted(years))
    return rounded(share, 9)


@register(
    "q67_malformed_rows",
    """SELECT 'good' AS kind, s_nationkey, count(*) AS n, CAST(sum(s_suppkey) AS BIGINT) AS suppliers FROM supplier WHERE s_suppkey % 5 > 1 GROUP BY s_nationkey
UNION ALL SELECT 'bad', s_nationkey, count(*), NULL FROM supplier WHERE s_suppkey % 5 <= 1 GROUP BY s_nationkey""",
    derived=False,
)
def malformed_rows(fx, spark, sf_dir):
    """Of the suppliers' lines a fifth has a word for a number, and a fifth a cell too many; one file per nation."""
    key, nation = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    cells = F.when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("none,"), F.col("s_acctbal").cast("string")))
    cells = cells.when(F.col("s_suppkey") % 5 == 1, F.concat(key, F.lit(",1.5,extra"))).otherwise(F.concat(key, F.lit(",")))
    path = scratch_path(spark, "csv")
    rows = table(spark, sf_dir, "supplier").select(F.concat(cells).alias("value"), F.concat(F.lit("n"), nation).alias("part"))
    rows.write.partitionBy("part").text(path)
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType())])
    out = []
    good, bad = tables.read_csv_checked(spark, path, schema, header=False)
    at = F.substring("part", 2, 9).cast("int").alias("s_nationkey")
    out.append(good.groupBy(at).agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("suppliers")).withColumn("kind", F.lit("good")))
    named = F.regexp_extract("file", "part=n([0-9]+)/", 1).cast("int").alias("s_nationkey")
    out.append(bad.groupBy(named).agg(F.count(F.lit(1)).alias("n")).withColumns({"suppliers": F.lit(None).cast("long"), "kind": F.lit("bad")}))
    return out[0].unionByName(out[1]).select("kind", F.col("s_nationkey").cast("int"), "n", "suppliers")


@register(
    "q68_bound_rows",
    """SELECT o_orderkey AS k, CAST(CAST(o_custkey AS INT) AS DOUBLE) AS v, NULL AS note FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, CAST(o_totalprice AS DOUBLE), NULL FROM orders WHERE o_orderkey % 3 = 1
UNION ALL SELECT o_orderkey, NULL, o_orderstatus FROM orders WHERE o_orderkey % 3 = 2""",
    derived=False,
)
def bound_rows(fx, spark, sf_dir):
    """Three tables of one kind, written with fewer columns or narrower types, read as one."""
    orders = table(spark, sf_dir, "orders")
    parts = [
        orders.filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").cast("int").alias("k"), F.col("o_custkey").cast("int").alias("v")),
        orders.filter("o_orderkey % 3 = 1").select(F.col("o_totalprice").cast("double").alias("v"), F.col("o_orderkey").cast("long").alias("k")),
        orders.filter("o_orderkey % 3 = 2").select(F.col("o_orderkey").cast("long").alias("k"), F.col("o_orderstatus").alias("note")),
    ]
    return rounded(tables.bind_rows([materialise(p, "part") for p in parts]))


# --- formulas and the stored analysis ---------------------------------------------------------

FORMULA = " + ".join(["log_dist * contig", "log_dist_sq", "log_uv_exp", "landlocked_reporter", "landlocked_partner", "factor(year)"])
FORMULA_TERMS = [*training.REGRESSORS, "log_dist:contig"]


@register(
    "q69_formula_model",
    model_sql.coefficient_sql(0, FORMULA_TERMS, "_0"),
    {
        "mz_d0": MODEL_ROWS.replace(f", {Y} AS y", f", CAST(log_dist * contig AS DOUBLE) AS x7, {Y} AS y"),
        **model_sql.fit_blocks("mz_d0", 7, "_0"),
    },
)
def formula_model(fx, spark, sf_dir):
    """The full model and an interaction, from the text of a formula."""
    fit = formula.fit_formula(training_table(fx), f"{Y} ~ {FORMULA}", W)
    level = [None] * len(fit.levels[1:])
    errors = [*fit.std_error[: 1 + len(fit.x)], *level]
    rows = [(0, t, b, e, fit.n, fit.r_squared) for t, b, e in zip(fit.terms, fit.estimate, errors)]
    return rounded(spark.createDataFrame(rows, "fit int, term string, estimate double, std_error double, n bigint, r_squared double"))


@register(
    "q70_analysis_store",
    f"""SELECT 'ols_n' AS metric, CAST(count(*) AS DOUBLE) AS value FROM mz_d0
UNION ALL SELECT 'ppml_n', CAST(count(*) AS DOUBLE) FROM mz_d0
UNION ALL SELECT 'ols_r_squared', {O.val('1 - rss / tss')} FROM mz_v_0
UNION ALL SELECT 'ppml:(Intercept)', {O.val('ln(m)')} FROM (
  SELECT avg({PPML_Y}) AS m FROM training WHERE year = (SELECT min(year) FROM training)) t""",
    {"mz_d0": MODEL_ROWS, **{k: v for k, v in model_sql.fit_blocks("mz_d0", 6, "_0").items() if k != "mz_i_0"}},
)
def analysis_store(fx, spark, sf_dir):
    """The analysis of both models, stored and read back: what does not depend on the tests of the form."""
    path, rows = scratch_path(spark, "analysis"), training_table(fx)
    fit = ols.fit_wls(rows, Y, training.REGRESSORS, W, training.GROUP)
    poisson = ppml.fit_ppml(rows, PPML_Y, [], training.GROUP)
    analysis.save_analysis(
        analysis.model_analysis(rows, rows, fit, poisson), analysis.coefficient_comparison(spark, fit, poisson), path
    )
    metrics, terms = analysis.load_analysis(spark, path)
    shown = metrics.filter(F.col("metric").isin("ols_n", "ppml_n", "ols_r_squared"))
    first = terms.filter("model = 'ppml' and term = '(Intercept)'")
    return rounded(shown.unionByName(first.select(F.lit("ppml:(Intercept)").alias("metric"), F.col("estimate").alias("value"))))
