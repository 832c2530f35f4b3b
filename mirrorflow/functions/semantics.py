"""Column helpers that fix the meaning of NULL, NaN and infinity.

The engine distinguishes three states of a double: NULL (not reported), NaN (undefined, 0/0)
and +-Infinity (x/0). Spark's ANSI mode raises on x/0 and returns NULL for log(0), and it sorts
NaN above every number, so the library uses the helpers below in place of a bare ``/`` or
``log``. All of them are built-in expressions and stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INF = float("inf")
NAN = float("nan")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ieee_div(a: Column | str, b: Column | str) -> Column:
    """a / b with IEEE results for b = 0; NULL if either side is NULL."""
    a, b = as_col(a).cast("double"), as_col(b).cast("double")
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when(b != 0, F.try_divide(a, b))
        .when(F.isnan(a) | (a == 0), F.lit(NAN))
        .when(a > 0, F.lit(INF))
        .otherwise(F.lit(-INF))
    )


def ieee_log(a: Column | str) -> Column:
    """Natural logarithm: -Infinity at 0, NaN below 0, NULL for NULL."""
    a = as_col(a).cast("double")
    return (
        F.when(a.isNull(), F.lit(None).cast("double"))
        .when(F.isnan(a) | (a < 0), F.lit(NAN))
        .when(a == 0, F.lit(-INF))
        .otherwise(F.log(a))
    )


def nan_to_null(a: Column | str) -> Column:
    a = as_col(a)
    return F.when(~F.isnan(a), a)


def is_missing(a: Column | str) -> Column:
    """NULL or NaN."""
    a = as_col(a)
    return a.isNull() | F.isnan(a)


def is_finite(a: Column | str) -> Column:
    """TRUE for an ordinary number; FALSE (never NULL) for NULL, NaN and infinities."""
    a = as_col(a)
    return a.isNotNull() & ~F.isnan(a) & (F.abs(a) < F.lit(INF))


def not_in_keep_null(a: Column | str, values: Iterable[str]) -> Column:
    """NOT IN that keeps NULL rows. Written as an OR so the scan can still push it down."""
    a = as_col(a)
    return a.isNull() | ~a.isin(*values)


def sum0(a: Column | str) -> Column:
    """Sum that skips NULL and NaN and is 0 for an empty group."""
    return F.coalesce(F.sum(nan_to_null(a)), F.lit(0.0))


def row_max(a: Column | str, b: Column | str) -> Column:
    """Larger of two numbers, skipping NULL and NaN."""
    return F.greatest(nan_to_null(a), nan_to_null(b))


def row_min(a: Column | str, b: Column | str) -> Column:
    """Smaller of two numbers, skipping NULL and NaN."""
    return F.least(nan_to_null(a), nan_to_null(b))


def pair_first(a: Column | str, b: Column | str) -> Column:
    """Alphabetically first of two codes; NULL if either is NULL."""
    a, b = as_col(a), as_col(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def pair_second(a: Column | str, b: Column | str) -> Column:
    """Alphabetically second of two codes; NULL if either is NULL."""
    a, b = as_col(a), as_col(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def paste(*cols: Column | str, sep: str = "_") -> Column:
    """Join parts as text; a NULL part becomes the text "NA"."""
    return F.concat_ws(sep, *[F.coalesce(as_col(c).cast("string"), F.lit("NA")) for c in cols])


def same_key(left: str, right: str, pairs: Iterable[tuple[str, str]]) -> Column:
    """Null-safe equality of aliased column pairs, usable as an equi-join condition."""
    cond = None
    for a, b in pairs:
        term = F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{b}"))
        cond = term if cond is None else cond & term
    return cond


def map_columns(df: DataFrame, types: Iterable[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Apply ``fn`` to every column whose Spark type name is listed, in one projection."""
    types = set(types)
    return df.select(*[fn(F.col(c)).alias(c) if t in types else F.col(c) for c, t in df.dtypes])


def bring_first(df: DataFrame, *names: str) -> DataFrame:
    """Same columns, the named ones first."""
    return df.select(*names, *[c for c in df.columns if c not in names])


def select_affix(
    df: DataFrame,
    keep: Iterable[str] = (),
    prefixes: Iterable[str] = (),
    suffixes: Iterable[str] = (),
) -> DataFrame:
    """Keep columns by name, prefix or suffix, in their present order."""
    keep, prefixes, suffixes = set(keep), tuple(prefixes), tuple(suffixes)
    return df.select(
        *[c for c in df.columns if c in keep or c.startswith(prefixes) or c.endswith(suffixes)]
    )
