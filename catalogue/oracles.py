"""The registered queries in ANSI SQL for DuckDB, written independently of the library.

``CTES`` holds named building blocks with the blocks they need; ``sql`` puts those a query needs
in front of it. Doubles are rounded to hide summation order; ``+ 0.0`` turns -0.0 into 0.0.
"""

from __future__ import annotations

import re

from catalogue import model as M
from catalogue.derive import CUTOVER_YEAR, EXTRA_CODES, RTA_FROM, SPECIAL_REPORTERS

KG = "weight in kilograms"
ELECTRIC = "electrical energy in thousands of kilowatt-hours"
FLAGS = (
    "exports, no change",
    "imports, divided by cif/fob ratio",
    "imports, divided by 1 + model constant due to NA/Inf values",
)


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def nudge(digits: int) -> float:
    """Added before rounding, so that short decimals never lie halfway, where engines differ."""
    return 3.3 * 10.0 ** -(digits + 4)


def val(expr: str, digits: int = 6) -> str:
    """Rounded double."""
    return f"round({expr} + {nudge(digits)!r}, {digits}) + 0.0"


def rnd(expr: str, name: str | None = None, digits: int = 6) -> str:
    """Rounded double with an alias, the expression's last part unless given."""
    return f"{val(expr, digits)} AS {name or expr.split('.')[-1]}"


def iso(key: str) -> str:
    return f"('n' || lpad(CAST({key} AS VARCHAR), 2, '0'))"


def hs(prefix: str, expr: str) -> str:
    return f"format('{prefix}{{:04d}}', CAST({expr} AS BIGINT))"


def same(a: str, b: str, pairs) -> str:
    pairs = [(p, p) if isinstance(p, str) else p for p in pairs]
    return " AND ".join(f"{a}.{x} IS NOT DISTINCT FROM {b}.{y}" for x, y in pairs)


KEYS = ["year", "reporter_iso", "partner_iso", "commodity_code"]
SWAP = [("year", "year"), ("reporter_iso", "partner_iso"), ("partner_iso", "reporter_iso"),
        ("commodity_code", "commodity_code")]
FIX = (
    "CASE {0} WHEN 'rom' THEN 'rou' WHEN 'yug' THEN 'scg' WHEN 'tmp' THEN 'tls'"
    " WHEN 'zar' THEN 'cod' ELSE {0} END"
)
OVERRIDES = (
    "CASE {0} WHEN 'Belgium-Luxembourg' THEN 'bel' WHEN 'Bolivia' THEN 'bol'"
    " WHEN 'Cabo Verde' THEN 'cpv' WHEN 'Czechia' THEN 'cze'"
    " WHEN 'East and West Pakistan' THEN 'pak' WHEN 'Eswatini' THEN 'swz'"
    " WHEN 'Fmr Arab Rep. of Yemen' THEN 'yem' WHEN 'Fmr Ethiopia' THEN 'eth'"
    " WHEN 'Fmr Fed. Rep. of Germany' THEN 'deu' WHEN 'Fmr Panama, excl.Canal Zone' THEN 'pan'"
    " WHEN 'Fmr Rep. of Vietnam' THEN 'vnm' WHEN 'Fmr Sudan' THEN 'sdn'"
    " WHEN 'India, excl. Sikkim' THEN 'ind' WHEN 'Neth. Antilles and Aruba' THEN 'nld'"
    " WHEN 'North Macedonia' THEN 'mkd' WHEN 'Saint Kitts, Nevis and Anguilla' THEN 'kna'"
    " WHEN 'So. African Customs Union' THEN 'zaf' WHEN 'USA' THEN 'usa' ELSE {1} END"
)


def report(level: str, flow: str, rep: str, par: str, value: str, qty: str, where: str) -> str:
    return (
        f"SELECT {level} AS aggregate_level, '{flow}' AS trade_flow, year, {rep} AS reporter_iso,"
        f" {par} AS partner_iso, kk, round({value}, 6) AS trade_value_usd, round({qty}, 6) AS qq"
        f" FROM base WHERE {where} GROUP BY year, sn, cn, kk"
    )


EXP, IMP = iso("sn"), iso("cn")
REPORTS = [
    report("6", "export", EXP, IMP, "sum(v)", "200 * sum(q)", "ln <> 3 AND sn < 23"),
    report(
        "6", "import", IMP, EXP,
        "sum(v * (1 + t + 2 * d + 0.15 * (1 + (sn + cn) % 3)))", "sum(200 * q * (1 - d / 2))",
        "ln <> 5",
    ),
    report("6", "re-export", EXP, IMP, "0.3 * sum(v)", "60 * sum(q)",
           "ln <> 3 AND sn < 23 AND rf = 'R'"),
    report("6", "re-import", IMP, EXP, "0.1 * sum(v)", "20 * sum(q)", "ln <> 5 AND rf = 'A'"),
]
NOISE = report(
    "CASE WHEN kk % 4 = 3 THEN 4 ELSE 6 END", "noise", EXP,
    f"CASE kk % 4 WHEN 1 THEN 'wld' WHEN 2 THEN '0-unspecified' WHEN 3 THEN {IMP} END",
    "sum(v)", "200 * sum(q)", "ln = 3",
)


def flow_columns(source: str, flow: str = "trade_flow") -> str:
    return f"""
SELECT aggregate_level, {flow} AS trade_flow, year, reporter_iso, partner_iso,
       {hs('01', 'kk')} AS commodity_code, trade_value_usd,
       CASE kk % 10 WHEN 7 THEN 'number of items' WHEN 3 THEN '{ELECTRIC}'
                    WHEN 9 THEN 'no quantity' ELSE '{KG}' END AS qty_unit,
       CASE WHEN kk % 10 = 9 THEN 0.0 ELSE qq END AS qty,
       CASE WHEN kk % 20 <> 9 THEN qq END AS netweight_kg
FROM {source}"""


def mirror(exports: str, imports: str, measures) -> str:
    cols = ", ".join(f"e.{c} AS {c}_exp, i.{c} AS {c}_imp" for c in measures)
    keys = ", ".join(f"coalesce(e.{a}, i.{b}) AS {a}" for a, b in SWAP)
    own = ", ".join(f"i.{b} AS {a}" for a, b in SWAP)
    alone = ", ".join(f"NULL AS {c}_exp, i.{c} AS {c}_imp" for c in measures)
    # the full join as a left join and the imports without a partner
    return (
        f"SELECT {keys}, {cols} FROM {exports} e LEFT JOIN {imports} i ON {same('e', 'i', SWAP)}"
        f" UNION ALL SELECT {own}, {alone} FROM {imports} i"
        f" WHERE NOT EXISTS (SELECT 1 FROM {exports} e WHERE {same('e', 'i', SWAP)})"
    )


def netted(main: str, re_flow: str) -> str:
    """Missing numbers are 0; fixture values are finite."""
    diff = ", ".join(
        f"greatest(coalesce(m.{c}, 0) - coalesce(r.{c}, 0), 0.0) AS {c}"
        for c in ("trade_value_usd", "qty", "netweight_kg")
    )
    keys = ", ".join(f"m.{k}" for k in KEYS)
    return (
        f"SELECT {keys}, {diff}, m.qty_unit FROM (SELECT * FROM flows WHERE trade_flow = '{main}') m"
        f" LEFT JOIN (SELECT * FROM flows WHERE trade_flow = '{re_flow}') r ON {same('m', 'r', KEYS)}"
    )


def converted(source: str, extra, sums) -> str:
    keys = ["year", "reporter_iso", "partner_iso", *extra]
    k = ", ".join(f"d.{c}" for c in keys)
    s = ", ".join(f"coalesce(sum(d.{c}), 0.0) AS {c}" for c in sums)
    plain = ", ".join([*keys, "commodity_code", *sums])
    return f"""
SELECT {k}, coalesce(x.hs12, '999999') AS commodity_code, {s}
FROM {source} d LEFT JOIN xwalk_first x ON d.commodity_code = x.hs02
WHERE d.year < {CUTOVER_YEAR}
GROUP BY {k}, coalesce(x.hs12, '999999')
UNION ALL
SELECT {plain} FROM {source} WHERE year >= {CUTOVER_YEAR}"""


def gravity(source: str, how: str) -> str:
    return f"""
SELECT s.*, x.dist, x.contig, x.colony, x.comlang_off,
       a.landlocked AS landlocked_reporter, b.landlocked AS landlocked_partner
FROM {source} s
{how} JOIN distances x ON lower(x.iso_o) = s.reporter_iso AND lower(x.iso_d) = s.partner_iso
{how} JOIN (SELECT DISTINCT lower(iso3) AS c, landlocked FROM countries) a ON a.c = s.reporter_iso
{how} JOIN (SELECT DISTINCT lower(iso3) AS c, landlocked FROM countries) b ON b.c = s.partner_iso"""


T_SUMS = ["trade_value_usd_exp", "trade_value_usd_imp", "qty_exp", "qty_imp"]
I_SUMS = [*T_SUMS, "netweight_kg_exp", "netweight_kg_imp"]
PREDICTOR = (
    f"{M.INTERCEPT_VALUE!r} + "
    + " + ".join(f"({b!r}) * {c}" for c, b in M.SLOPES.items())
    + " + CASE year "
    + " ".join(f"WHEN {y} THEN {b!r}" for y, b in M.YEAR_EFFECTS.items())
    + " END"
)
SPECIAL = ", ".join(f"({i}, {quote(n)})" for i, n in enumerate(SPECIAL_REPORTERS))
NOTE_YEARS = "(SELECT DISTINCT year(l_shipdate) AS y FROM lineitem) yy"

CTES: dict[str, str] = {
    "base": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, s_nationkey AS sn, c_nationkey AS cn,
       (l_partkey // 2000) * 20 + l_partkey % 20 AS kk, l_linenumber AS ln, l_returnflag AS rf,
       l_extendedprice AS v, l_quantity AS q, l_tax AS t, l_discount AS d
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey""",
    "reports": " UNION ALL ".join(REPORTS),
    "flows": flow_columns("reports"),
    "noise_reports": NOISE,
    "noise": flow_columns("noise_reports", "'export'"),
    # lookups
    "distances": f"""
SELECT upper({iso('a.n_nationkey')}) AS iso_o, upper({iso('b.n_nationkey')}) AS iso_d,
       CAST(200 + 350 * abs(a.n_nationkey - b.n_nationkey)
            + 1500 * CAST(a.n_regionkey <> b.n_regionkey AS INTEGER) AS DOUBLE) AS dist,
       CAST(a.n_regionkey = b.n_regionkey AND abs(a.n_nationkey - b.n_nationkey) <= 5 AS INTEGER) AS contig,
       CAST(a.n_nationkey * b.n_nationkey % 7 = 0 AS INTEGER) AS colony,
       CAST((a.n_nationkey + b.n_nationkey) % 4 = 0 AS INTEGER) AS comlang_off
FROM nation a CROSS JOIN nation b WHERE a.n_nationkey <> 22""",
    "countries": f"""
SELECT upper({iso('n_nationkey')}) AS iso3, CAST(n_nationkey % 5 = 0 AS INTEGER) AS landlocked
FROM nation
UNION ALL
SELECT upper({iso('n_nationkey')}), CAST(n_nationkey % 5 = 0 AS INTEGER)
FROM nation WHERE n_nationkey % 4 = 0""",
    "xwalk_index": """
SELECT DISTINCT (p_partkey // 2000) * 20 AS block, p_partkey % 20 AS k
FROM part WHERE p_partkey % 20 < 18""",
    "xwalk": f"""
SELECT {hs('01', 'block + k')} AS hs02, {hs('02', 'block + k // 2')} AS hs12 FROM xwalk_index
UNION ALL
SELECT {hs('01', 'block + k')}, {hs('02', 'block + k // 2 + 1')} FROM xwalk_index WHERE k % 3 = 0""",
    "xwalk_first": "SELECT hs02, min(hs12) AS hs12 FROM xwalk GROUP BY hs02",
    "rtas": f"""
SELECT CAST(y AS INTEGER) AS year, {iso('a.n_nationkey')} AS country1, {iso('b.n_nationkey')} AS country2, 1 AS rta
FROM nation a JOIN nation b
  ON a.n_nationkey < b.n_nationkey AND (a.n_nationkey + b.n_nationkey) % 3 = 0,
  {NOTE_YEARS} WHERE y >= {RTA_FROM}""",
    "country_codes": f"""
SELECT n_name AS country_name_english, upper({iso('n_nationkey')}) AS iso3_digit_alpha FROM nation
UNION ALL VALUES {", ".join(f"({quote(a)}, {quote(b)})" for a, b in EXTRA_CODES)}""",
    "valuation_notes": f"""
SELECT n.n_nationkey AS n, n.n_name AS name FROM nation n
WHERE n.n_nationkey IN (SELECT c_nationkey FROM customer)""",
    "valuation_raw": f"""
SELECT e.reporter, e.trade_flow, e.valuation, e.r, yy.y FROM (
  SELECT name AS reporter, 'Export' AS trade_flow, 'FOB' AS valuation, n AS r FROM valuation_notes
  UNION ALL
  SELECT name, 'Import', CASE WHEN n % 6 = 0 THEN 'FOB' ELSE 'CIF' END, n
  FROM valuation_notes WHERE n % 6 <> 1
  UNION ALL
  SELECT name, 'Import', CASE WHEN n % 6 = 0 THEN 'FOB' ELSE 'CIF' END, n
  FROM valuation_notes WHERE n % 6 <> 1 AND n % 4 = 0
  UNION ALL
  SELECT name, 'Import', 'FOB', n + 200 FROM valuation_notes WHERE n % 7 = 3
  UNION ALL
  SELECT s.name, 'Import', CASE WHEN s.i % 2 = 0 THEN 'CIF' ELSE 'FOB' END, s.i + 100
  FROM (VALUES {SPECIAL}) s(i, name)
  WHERE s.i IN (SELECT c_custkey % {len(SPECIAL_REPORTERS)} FROM customer)
) e, {NOTE_YEARS}""",
    "valuation": f"""
SELECT DISTINCT CAST(v.y AS INTEGER) AS year, trim(v.name) AS reporter,
       {OVERRIDES.format('trim(v.name)', FIX.format('lower(c.iso3_digit_alpha)'))} AS iso3_digit_alpha,
       v.trade_flow, v.valuation, CAST(v.r AS INTEGER) AS uncomtrade_id
FROM (SELECT *, regexp_replace(reporter, '\\(.*', '') AS name FROM valuation_raw) v
LEFT JOIN country_codes c ON v.name = c.country_name_english""",
    "valuation_ranked": """
SELECT *, row_number() OVER (PARTITION BY year, iso3_digit_alpha, trade_flow
                             ORDER BY reporter, uncomtrade_id, valuation) AS rn
FROM valuation WHERE iso3_digit_alpha IS NOT NULL AND valuation IS NOT NULL AND trade_flow IS NOT NULL""",
    "valuation_wide": """
SELECT year, iso3_digit_alpha AS reporter_iso,
       max(CASE WHEN trade_flow = 'Export' THEN valuation END) AS exports_report,
       max(CASE WHEN trade_flow = 'Import' THEN valuation END) AS imports_report
FROM valuation_ranked WHERE rn = 1 GROUP BY year, iso3_digit_alpha""",
    # training path
    "exports": "SELECT * FROM flows WHERE trade_flow = 'export'",
    "imports": "SELECT * FROM flows WHERE trade_flow = 'import'",
    "mirror_t": mirror("exports", "imports", ["trade_value_usd", "qty_unit", "qty"]),
    "kg": f"""
SELECT * FROM mirror_t
WHERE qty_unit_exp = '{KG}' AND qty_unit_imp = '{KG}'
  AND trade_value_usd_exp > 10 AND trade_value_usd_imp > 10 AND qty_exp > 2000 AND qty_imp > 2000""",
    "comparable": converted("kg", [], T_SUMS),
    "unit_values": """
SELECT *, trade_value_usd_exp / qty_exp AS unit_value_exp, trade_value_usd_imp / qty_imp AS unit_value_imp
FROM {source}""".format(source="comparable"),
    "ratios": """
SELECT u.*, m.uv_exp, unit_value_imp / unit_value_exp AS cif_fob_unit_ratio,
       trade_value_usd_imp / trade_value_usd_exp AS cif_fob_ratio,
       1.0 / (greatest(qty_imp, qty_exp) / least(qty_imp, qty_exp)) AS cif_fob_weights
FROM unit_values u
JOIN (SELECT year, commodity_code, median(unit_value_exp) AS uv_exp FROM unit_values
      GROUP BY year, commodity_code) m USING (year, commodity_code)""",
    "gravity_t": gravity("ratios", "INNER"),
    "training": """
SELECT g.year, g.reporter_iso AS exporter_iso, g.partner_iso AS importer_iso, g.commodity_code,
       g.uv_exp, g.cif_fob_unit_ratio, g.cif_fob_ratio, g.cif_fob_weights, g.dist, g.contig,
       g.colony, g.comlang_off, g.landlocked_reporter, g.landlocked_partner,
       coalesce(r.rta, 0) AS rta, ln(g.cif_fob_unit_ratio) AS log_cif_fob_unit_ratio,
       ln(g.dist) AS log_dist, ln(g.dist) * ln(g.dist) AS log_dist_sq, ln(g.uv_exp) AS log_uv_exp,
       g.reporter_iso || '_' || g.year AS etfe, g.partner_iso || '_' || g.year AS itfe,
       g.reporter_iso || '_' || g.partner_iso AS pair_id
FROM gravity_t g
LEFT JOIN rtas r ON r.year = g.year AND r.country1 = least(g.reporter_iso, g.partner_iso)
                AND r.country2 = greatest(g.reporter_iso, g.partner_iso)""",
    # one-regressor regression: x, y, w
    "xyw": "SELECT *, log_dist AS x, log_cif_fob_unit_ratio AS y, cif_fob_weights AS w FROM training",
    # imputation path
    "net_e": netted("export", "re-export"),
    "net_i": netted("import", "re-import"),
    "mirror_i": mirror("net_e", "net_i", ["trade_value_usd", "qty_unit", "qty", "netweight_kg"]),
    "converted": converted("mirror_i", ["qty_unit_exp", "qty_unit_imp"], I_SUMS),
    "in_kg": f"""
SELECT * REPLACE (
         CASE WHEN qty_unit_exp = '{KG}' THEN qty_exp WHEN qty_unit_exp <> '{KG}' THEN netweight_kg_exp END AS qty_exp,
         CASE WHEN qty_unit_imp = '{KG}' THEN qty_imp WHEN qty_unit_imp <> '{KG}' THEN netweight_kg_imp END AS qty_imp),
       CASE WHEN trade_value_usd_exp IS NOT NULL AND trade_value_usd_imp IS NOT NULL THEN 'both parties'
            WHEN trade_value_usd_exp IS NOT NULL THEN 'exporter only'
            WHEN trade_value_usd_imp IS NOT NULL THEN 'importer only' END AS reported_by
FROM converted""",
    "in_kg_uv": "SELECT *, trade_value_usd_exp / qty_exp AS unit_value_exp FROM in_kg",
    "medians_i": """
SELECT year, commodity_code, median(unit_value_exp) AS uv_exp
FROM in_kg_uv WHERE unit_value_exp IS NOT NULL AND NOT isnan(unit_value_exp)
GROUP BY year, commodity_code""",
    "with_uv": """
SELECT u.*, m.uv_exp FROM in_kg_uv u
LEFT JOIN medians_i m ON m.year = u.year AND m.commodity_code = u.commodity_code""",
    "gravity_i": gravity("with_uv", "LEFT"),
    "predictors": """
SELECT g.*, ln(dist) AS log_dist, ln(dist) * ln(dist) AS log_dist_sq, ln(uv_exp) AS log_uv_exp,
       v.exports_report, v.imports_report
FROM gravity_i g
LEFT JOIN valuation_wide v ON v.year = g.year AND v.reporter_iso = g.reporter_iso""",
    "fitted": f"SELECT *, exp({PREDICTOR}) AS fitted_unit_ratio FROM predictors",
    "labelled": f"""
SELECT *, CASE WHEN imports_report <> 'CIF' THEN 'no fobization'
               WHEN qty_unit_exp = '{ELECTRIC}' OR qty_unit_imp = '{ELECTRIC}' THEN 'no fobization'
               WHEN NOT isnan(fitted_unit_ratio) AND fitted_unit_ratio >= 1 THEN 'fobization'
               ELSE 'no fobization' END AS fobization,
       trade_value_usd_imp / fitted_unit_ratio AS fob
FROM fitted""",
    "imputed": f"""
SELECT *, CASE WHEN fobization = 'fobization' AND value <> trade_value_usd_exp THEN '{FLAGS[1]}'
               ELSE '{FLAGS[0]}' END AS flag
FROM (
  SELECT *, CASE WHEN fobization = 'fobization' AND NOT isnan(fob)
                  AND abs(fob - trade_value_usd_exp) < abs(trade_value_usd_imp - trade_value_usd_exp)
                 THEN fob ELSE trade_value_usd_exp END AS value
  FROM labelled) t""",
    "zero_exporters": """
SELECT year, reporter_iso FROM imputed GROUP BY year, reporter_iso HAVING coalesce(sum(value), 0) = 0""",
    "final": f"""
SELECT i.year, i.reporter_iso, i.partner_iso, i.commodity_code,
       CASE WHEN z.year IS NULL THEN i.value
            WHEN isfinite(i.fob) THEN i.fob
            ELSE i.trade_value_usd_imp / (1 + {M.INTERCEPT_VALUE!r}) END AS value,
       CASE WHEN z.year IS NULL THEN i.flag
            WHEN isfinite(i.fob) THEN '{FLAGS[1]}' ELSE '{FLAGS[2]}' END AS flag
FROM imputed i
LEFT JOIN zero_exporters z ON z.year = i.year AND z.reporter_iso = i.reporter_iso""",
    "harmonised": f"""
SELECT * FROM (
  SELECT {", ".join(f"coalesce(e.{a}, i.{b}) AS {a}" for a, b in SWAP)},
         coalesce(e.value, 0) AS trade_value_usd_exp, coalesce(i.value, 0) AS trade_value_usd_imp,
         coalesce(e.flag, i.flag) AS flag
  FROM final e FULL JOIN final i ON {same('e', 'i', [*SWAP, ('flag', 'flag')])}) t
WHERE trade_value_usd_exp + trade_value_usd_imp > 0""",
}


#: Blocks that others read more than once, or that end in a join on keys that may be null.
MATERIALIZED = ("flows", "mirror_t", "mirror_i", "converted", "final")


def needed(text: str, done: list[str] | None = None) -> list[str]:
    """Names of the blocks a text refers to, each after those it needs itself."""
    done = [] if done is None else done
    for name, body in CTES.items():
        if name not in done and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
            needed(body, done)
            if name not in done:
                done.append(name)
    return done


def sql(query: str, extra: dict[str, str] | None = None) -> str:
    """The query with the blocks it needs; ``extra`` blocks come after them, in order."""
    extra = extra or {}
    blocks = needed(" ".join([query, *extra.values()]))
    parts = [
        f"{n} AS {'MATERIALIZED ' if n in MATERIALIZED else ''}(\n{CTES[n].strip()}\n)" for n in blocks
    ]
    for n, b in extra.items():
        kind = "MATERIALIZED " if n.startswith("mz_") or n.removesuffix("_m") in MATERIALIZED else ""
        parts.append(f"{n} AS {kind}(\n{b.strip()}\n)")
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + query.strip()
