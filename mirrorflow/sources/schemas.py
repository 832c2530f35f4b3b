"""Schemas of the tables the engine reads and writes, as the DDL text readers accept."""

FLOWS = (
    "commodity_code string, partner_iso string, trade_value_usd double, qty_unit string,"
    " qty double, netweight_kg double,"
    " aggregate_level int, trade_flow string, year int, reporter_iso string"
)
FLOW_PARTITIONS = ["aggregate_level", "trade_flow", "year", "reporter_iso"]

DISTANCES = (
    "iso_o string, iso_d string, dist double, contig int, colony int, comlang_off int"
)
COUNTRIES = "iso3 string, landlocked int"
HS_CROSSWALK = "hs02 string, hs12 string"
RTAS = "year int, country1 string, country2 string, rta int"
COUNTRY_CODES = "country_name_english string, iso3_digit_alpha string"
VALUATION_RAW = "reporter string, trade_flow string, valuation string, r int, y int"
VALUATION = (
    "year int, reporter string, iso3_digit_alpha string, trade_flow string,"
    " valuation string, uncomtrade_id int"
)
HARMONISED = (
    "reporter_iso string, partner_iso string, commodity_code string,"
    " trade_value_usd_exp double, trade_value_usd_imp double, flag string, year int"
)
SUMMARY = "year int, flag string, n bigint, m double"

LOOKUPS = {
    "distances": DISTANCES,
    "countries": COUNTRIES,
    "hs_crosswalk": HS_CROSSWALK,
    "rtas": RTAS,
    "country_codes": COUNTRY_CODES,
    "valuation_raw": VALUATION_RAW,
    "valuation": VALUATION,
}
