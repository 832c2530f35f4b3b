"""Code lists and text clean-up. The literal values are fixed by the data, not by design."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from mirrorflow.functions.semantics import as_col

# --- fixed values -----------------------------------------------------------------------------

# reporters and partners that are not countries
EXCLUDED_AREAS = ("wld", "0-unspecified")

# commodity code given to products without a counterpart in the newer classification
UNMATCHED_COMMODITY = "999999"

# quantity units
KILOGRAMS = "weight in kilograms"
ELECTRICITY = "electrical energy in thousands of kilowatt-hours"

# provenance flags of the harmonised table
FLAG_UNCHANGED = "exports, no change"
FLAG_RATIO = "imports, divided by cif/fob ratio"
FLAG_CONSTANT = "imports, divided by 1 + model constant due to NA/Inf values"

# conversion labels
CONVERT = "fobization"
KEEP = "no fobization"

# country codes that changed over the period
ISO_RENAMES = {
    "rom": "rou",
    "yug": "scg",
    "tmp": "tls",
    "zar": "cod",
}

# reporter names whose code cannot be found by name
REPORTER_CODES = {
    "Belgium-Luxembourg": "bel",
    "Bolivia": "bol",
    "Cabo Verde": "cpv",
    "Czechia": "cze",
    "East and West Pakistan": "pak",
    "Eswatini": "swz",
    "Fmr Arab Rep. of Yemen": "yem",
    "Fmr Ethiopia": "eth",
    "Fmr Fed. Rep. of Germany": "deu",
    "Fmr Panama, excl.Canal Zone": "pan",
    "Fmr Rep. of Vietnam": "vnm",
    "Fmr Sudan": "sdn",
    "India, excl. Sikkim": "ind",
    "Neth. Antilles and Aruba": "nld",
    "North Macedonia": "mkd",
    "Saint Kitts, Nevis and Anguilla": "kna",
    "So. African Customs Union": "zaf",
    "USA": "usa",
}

# --- columns ----------------------------------------------------------------------------------


def _lookup(value: Column, table: dict[str, str], default: Column) -> Column:
    out = None
    for old, new in table.items():
        out = F.when(value == old, new) if out is None else out.when(value == old, new)
    return out.otherwise(default)


def fix_iso_codes(value: Column | str) -> Column:
    """Replace outdated country codes; all others, and NULL, pass through."""
    value = as_col(value)
    return _lookup(value, ISO_RENAMES, value)


def override_reporter_code(name: Column | str, code: Column | str) -> Column:
    """The code from the fixed name list where the name is listed, else the given code."""
    return _lookup(as_col(name), REPORTER_CODES, as_col(code))


def cut_parenthesis(value: Column | str) -> Column:
    """Drop everything from the first opening parenthesis on; the blank before it stays."""
    return F.regexp_replace(as_col(value), r"\(.*", "")


def strip_partition_key(value: Column | str) -> Column:
    """``key=value`` to ``value``, for directory values read as plain text."""
    return F.regexp_replace(as_col(value), ".*=", "")


def snake_case(header: str) -> str:
    """Header text to a column name: lower case, words joined by one underscore."""
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", header.strip())
    text = re.sub(r"[^0-9A-Za-z]+", "_", text).strip("_").lower()
    if not text:
        return "x"
    return f"x{text}" if text[0].isdigit() else text


def snake_case_names(headers: list[str]) -> list[str]:
    """``snake_case`` over a header row; repeated names get the suffixes _2, _3, ..."""
    seen: dict[str, int] = {}
    out = []
    for name in map(snake_case, headers):
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out


def snake_case_column(header: Column | str) -> Column:
    """``snake_case`` as a column expression, for header cells that are data."""
    text = F.regexp_replace(F.trim(as_col(header)), r"([a-z0-9])([A-Z])", "$1_$2")
    text = F.lower(F.regexp_replace(F.regexp_replace(text, r"[^0-9A-Za-z]+", "_"), r"^_+|_+$", ""))
    return F.regexp_replace(text, r"^(?=[0-9]|\z)", "x")
