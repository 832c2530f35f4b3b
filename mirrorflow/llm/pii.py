"""Personal data: proposed by regular expressions, confirmed by checksums, scored by context.

Everything is an expression on one row. A text is split at the matches of a kind, so the places of
all matches follow from the lengths of the pieces, in one pass, whatever their number. Patterns start
only where a match can start and give nothing back, which keeps them linear in the length of a text.
Account numbers are proposed from every place where one can start, since what looks like one may
reach into the next; the text is then split at those whose checksum holds.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorflow.llm.text import prefix_sums

# Two-letter codes and lengths of international bank account numbers.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21,
    "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24,
    "SE": 24, "SI": 19, "SK": 24,
}

# An account number stands alone and has the length of its country, spaces not counted.
ALONE = "[0-9A-Za-z-]"
IBAN = "|".join(
    rf"(?:{'|'.join(c for c, n in IBAN_LENGTHS.items() if n == length)})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{length - 4}}}"
    for length in sorted(set(IBAN_LENGTHS.values()))
)

IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
BEFORE, AFTER = 40, 20
KEEP_SCORE = 0.5
CONTEXT_BONUS = 0.3


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = _digits(match)
    return F.char_length(digits).between(14, 19) & F.call_function("luhn_check", digits)


def _mod_97(match: Column) -> Column:
    plain = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    code = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda acc, c: F.when(c == "", acc)
        .when(F.ascii(c) >= 65, F.pmod(acc * 100 + F.ascii(c) - 55, F.lit(97)))
        .otherwise(F.pmod(acc * 10 + F.ascii(c) - 48, F.lit(97))),
    )
    lengths = [F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair]
    wanted = F.element_at(F.create_map(*lengths), F.substring(plain, 1, 2))
    return (F.char_length(plain) == wanted) & (code == 1)


def _ok(match: Column) -> Column:
    return F.lit(True)


def _ip(match: Column) -> Column:
    return match.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")


def _phone(match: Column) -> Column:
    return F.char_length(_digits(match)).between(10, 15)


@dataclass(frozen=True)
class Kind:
    """``score`` counts without context; ``base`` kinds are reported whatever their score.

    The first group of an ``everywhere`` pattern is looked for from each place, also inside others;
    of the valid ones that overlap the first is taken.
    """

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True
    needs: str | None = None
    everywhere: bool = False


KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        _ok, 0.9, "mail|contact|write", needs="@",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", _ip, 0.6, "ip|host|server|address|login"),
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){13,18}+(?![\x20-]?[0-9])",
        _luhn, 0.7, "card|visa|credit|karte|tarjeta|carte",
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, 0.6, "phone|tel|call|mobile|fax", needs="+"),
    Kind(
        "iban", rf"(?<!{ALONE})(?=[A-Z]{{2}}[0-9]{{2}})(?=((?:{IBAN})(?!{ALONE})))",
        _mod_97, 0.7, "iban|account|bank|konto|cuenta|compte", base=False, everywhere=True,
    ),
    Kind(
        "ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", _ok, 0.3, "ssn|social security|tax id", base=False, needs="-",
    ),
)


def _pieces(df: DataFrame, kind: Kind, text: str) -> DataFrame:
    """Adds the matches of a kind, the pieces between them and whether each match holds."""
    m, g, c, k, p = (f"_{x}_{kind.name}" for x in "mgckp")
    none = F.array().cast("array<string>")
    pattern = F.lit(kind.pattern)
    found = F.regexp_extract_all(F.col(text), pattern, F.lit(0))
    if kind.everywhere:
        held = F.filter(F.regexp_extract_all(F.col(text), pattern, F.lit(1)), kind.valid)
        df = df.withColumn(m, F.array_distinct(held))
        spelled = F.concat(
            F.lit(f"(?<!{ALONE})(?=[A-Z]{{2}}[0-9]{{2}})(?:"), F.array_join(m, "|"), F.lit(f")(?!{ALONE})")
        )
        df = df.withColumn(p, F.when(F.size(m) > 0, spelled))
        pattern = F.col(p)
        found = F.when(F.size(m) > 0, F.regexp_extract_all(F.col(text), pattern, F.lit(0))).otherwise(none)
    if kind.needs:
        found = F.when(F.contains(F.col(text), F.lit(kind.needs)), found).otherwise(none)
    df = df.withColumn(m, found)
    df = df.withColumn(g, F.when(F.size(m) > 0, F.split(F.col(text), pattern)).otherwise(none))
    if kind.everywhere:
        df = df.drop(p)

    def context(i: Column) -> Column:
        before, after = F.get(g, i), F.get(g, i + 1)
        tail = F.substring(before, -BEFORE, BEFORE)
        near = F.concat(tail, F.lit(" "), F.substring(after, 1, AFTER))
        bonus = F.when(F.lower(near).rlike(rf"(?:^|[^a-z])(?:{kind.context})"), F.lit(CONTEXT_BONUS))
        return F.lit(kind.score) + bonus.otherwise(F.lit(0.0))

    def holds(x: Column, i: Column) -> Column:
        good = kind.valid(x)
        if kind.base:
            return good
        alone = ~F.get(g, i).rlike(f"{ALONE}$") & ~F.get(g, i + 1).rlike(f"^{ALONE}")
        return good & alone & (context(i) >= KEEP_SCORE)

    df = df.withColumn(c, F.transform(m, lambda x, i: F.least(F.lit(1.0), context(i))))
    return df.withColumn(k, F.transform(m, holds))


def _spans(df: DataFrame, rank: int, kind: Kind) -> DataFrame:
    """Adds ``_s_kind``: spans of the matches that hold, and drops their pieces."""
    m, g, c, k, s = (f"_{x}_{kind.name}" for x in "mgcks")
    lengths = F.transform(
        m, lambda x, i: (F.char_length(x) + F.char_length(F.get(g, i))).cast("long")
    )
    df = df.withColumn(s, lengths).withColumn(s, prefix_sums(F.col(s)))
    span = F.transform(
        s,
        lambda end, i: F.struct(
            (end - F.char_length(F.get(m, i))).alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(kind.name).alias("kind"),
            end.alias("end"),
            F.get(c, i).alias("score"),
            F.get(k, i).alias("holds"),
        ),
    )
    return df.withColumn(s, F.filter(span, lambda x: x["holds"])).drop(m, g, c, k)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` (start, rank, kind, end, score) of each row, by start, then kind.

    Places are code points, the end exclusive. A null text is an empty one and has no spans. Rows
    are looked at one by one, so repeated rows and null ids give what any row gives; other columns
    are not looked at.
    """
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    for kind in KINDS:
        df = _pieces(df, kind, "_text")
    df = df.drop("_text")
    for rank, kind in enumerate(KINDS):
        df = _spans(df, rank, kind)
    return df.select(
        "doc_id", F.array_sort(F.concat(*[F.col(f"_s_{kind.name}") for kind in KINDS])).alias("spans")
    )


#: Wider kinds first, so that a part of one is not taken for another.
REDACTION_ORDER = ("email", "iban", "phone", "card", "ip", "ssn")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each match that holds replaced by its kind in angle brackets.

    Kinds are replaced one after the other in ``REDACTION_ORDER``. Texts without a match, null ones
    included, and all other columns stay as they are.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    df = docs.select(row.alias("_row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    by_name = {kind.name: kind for kind in KINDS}
    for name in REDACTION_ORDER:
        df = _pieces(df, by_name[name], "_text")
        m, g, c, k = (f"_{x}_{name}" for x in "mgck")
        masked = F.transform(m, lambda x, i: F.when(F.get(k, i), F.lit(f"<{name.upper()}>")).otherwise(x))
        pieces = F.transform(F.col(g), lambda x, i: F.concat(x, F.coalesce(F.get("_masked", i), F.lit(""))))
        df = df.withColumn("_masked", masked)
        df = df.withColumn("_text", F.when(F.size(m) > 0, F.array_join(pieces, "")).otherwise(F.col("_text")))
        df = df.drop(m, g, c, k, "_masked")
    text = F.when(F.col("_row")[text_col].isNotNull(), F.col("_text")).alias(text_col)
    return df.select(*[text if x == text_col else F.col("_row")[x].alias(x) for x in docs.columns])
