"""Models given as a formula: ``y ~ a + b * c + factor(year) | effect_1 + effect_2``.

A term is a column, ``factor(column)`` (a column per value), or an interaction ``a:b`` of such; ``a * b`` stands
for ``a + b + a:b`` and ``- a:b`` takes a term back. Text columns are factors. Effects after the bar are absorbed. A
formula becomes columns of the rows, which Spark computes as it reads them; the fits are those of ``ols``,
``ppml`` and ``absorb``.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorflow.operators import absorb, ols, ppml

Term = tuple[str, ...]

_PART = re.compile(r"factor\(\w+\)|\w+")


@dataclass(frozen=True)
class Formula:
    """Response, terms by number of parts and then as written, and absorbed effects."""

    y: str
    terms: tuple[Term, ...]
    effects: tuple[str, ...] = ()


@dataclass(frozen=True)
class Design:
    """Rows with a column per regressor ``x``, and the factor ``group`` whose values have effects."""

    rows: DataFrame
    x: list[str]
    group: str | None


def _parts(text: str) -> Term:
    parts = [p.strip() for p in text.split(":")]
    for p in parts:
        if not _PART.fullmatch(p):
            raise ValueError(f"not a column or factor(column): {p!r}")
    return tuple(dict.fromkeys(parts))


def _crossed(text: str) -> list[Term]:
    """The terms of ``a * b * c``: each of them and all their interactions."""
    sides = [_parts(s) for s in text.split("*")]
    chosen = itertools.chain.from_iterable(itertools.combinations(sides, n) for n in range(1, len(sides) + 1))
    return [tuple(dict.fromkeys(itertools.chain.from_iterable(c))) for c in chosen]


def _terms(text: str, before: Sequence[Term]) -> tuple[Term, ...]:
    if re.search(r"[+-]\s*([+-]|$)", text):
        raise ValueError(f"a sign without a term in {text!r}")
    found: dict[frozenset[str], Term] = {}
    for sign, piece in re.findall(r"([+-]?)([^+-]+)", text):
        piece = piece.strip()
        if piece == "1" and sign != "-":
            continue
        new = list(before) if piece == "." else _crossed(piece)
        for term in new:
            if sign == "-":
                found.pop(frozenset(term), None)
            else:
                found.setdefault(frozenset(term), term)
    return tuple(sorted(found.values(), key=len))


def parse(text: str, old: Formula | None = None) -> Formula:
    """The formula of ``text``. With ``old``, a dot stands for its response, terms or effects."""
    left, tilde, right = text.partition("~")
    if not tilde:
        raise ValueError(f"no ~ in {text!r}")
    shape, _, absorbed = right.partition("|")
    y = left.strip()
    if y in ("", ".") and old:
        y = old.y
    if not re.fullmatch(r"\w+", y):
        raise ValueError(f"not a response: {y!r}")
    if not old and re.search(r"(^|[\s+*:|-])\.", right):
        raise ValueError("a dot needs a formula to update")
    effects = [e.strip() for e in absorbed.split("+") if e.strip()]
    effects = [n for e in effects for n in (old.effects if e == "." and old else [e])]
    return Formula(y, _terms(shape, old.terms if old else ()), tuple(dict.fromkeys(effects)))


def update(formula: Formula, text: str) -> Formula:
    """``formula`` changed as ``text`` says, e.g. ``~ . + predict2``; effects stay unless a bar is given."""
    new = parse(text, formula)
    return new if "|" in text else replace(new, effects=formula.effects)


def _coded(rows: DataFrame, part: str, levels: dict[str, list[str]], all_levels: bool) -> dict[str, Column]:
    """Columns of one part of a term by name: itself, or one per level, of which the first is the base."""
    if part not in levels:
        return {part: F.col(part).cast("double")}
    name = _column(part)
    shown = levels[part] if all_levels else levels[part][1:]
    key = F.col(name).cast("string")
    return {f"{name}{v}": F.when(key.isNotNull(), (key == v).cast("double")) for v in shown}


def _column(part: str) -> str:
    return part[7:-1] if part.startswith("factor(") else part


def design(df: DataFrame, formula: Formula, weight: str | None = None) -> Design:
    """The columns of a formula on the complete rows of ``df``.

    The first factor that stands alone becomes the group. Another factor, and one in an interaction, has a
    column per value but the first, or for every value if the term without it is not in the formula (then the
    columns would not depend on it). A factor has ``ols.MAX_LEVELS`` values at most (an error beyond); finer ones
    are to be absorbed. Rows that lack the response, the weight or a column of a term are left out first.
    """
    parts = list(dict.fromkeys(p for t in formula.terms for p in t))
    names = list(dict.fromkeys(_column(p) for p in parts))
    kinds = dict(df.dtypes)
    missing = [c for c in [formula.y, *names, *formula.effects] if c not in kinds]
    if missing:
        raise ValueError(f"not in the table: {', '.join(missing)}")
    needed = [*names, *formula.effects]
    rows = ols.complete_rows(df, formula.y, needed, weight, None)
    factors = [p for p in parts if p != _column(p) or kinds[p] == "string"]
    levels = {p: ols.check_levels(rows, _column(p)) for p in factors}

    present = {frozenset(t) for t in formula.terms}
    # absorbed effects take the place of the group
    alone = [t[0] for t in formula.terms if len(t) == 1 and t[0] in levels] if not formula.effects else []
    group = alone[0] if alone else None
    columns: dict[str, Column] = {}
    for term in formula.terms:
        if term == (group,):
            continue
        coded = []
        for p in term:
            rest = frozenset(term) - {p}
            coded.append(_coded(rows, p, levels, bool(rest) and rest not in present))
        for chosen in itertools.product(*[c.items() for c in coded]):
            columns[":".join(n for n, _ in chosen)] = reduce(lambda a, b: a * b, [c for _, c in chosen])
    kept = [formula.y, *([weight] if weight else []), *formula.effects, *([_column(group)] if group else [])]
    clash = set(columns) & set(kept)
    if clash:
        raise ValueError(f"both a term and another part of the model: {', '.join(sorted(clash))}")
    kept = list(dict.fromkeys(kept))
    out = rows.select(*kept, *[c.alias(n) for n, c in columns.items()])
    return Design(out, list(columns), _column(group) if group else None)


def fit_formula(
    df: DataFrame, formula: str | Formula, weight: str | None = None, poisson: bool = False
) -> ols.Fit | ppml.PoissonFit | absorb.AbsorbedFit:
    """Fit a formula by least squares, or the Poisson model, absorbing the effects after its bar.

    Levels of factors are compared as text. The Poisson model takes no weight. Its table should be a written one: it is read
    once per step.
    """
    if isinstance(formula, str):
        formula = parse(formula)
    if poisson and weight:
        raise ValueError("the Poisson model takes no weight")
    made = design(df, formula, weight)
    if formula.effects:
        if poisson:
            return absorb.fit_absorbed_ppml(made.rows, formula.y, made.x, list(formula.effects))
        return absorb.fit_absorbed(made.rows, formula.y, made.x, list(formula.effects), weight)
    if poisson:
        return ppml.fit_ppml(made.rows, formula.y, made.x, made.group)
    return ols.fit_wls(made.rows, formula.y, made.x, weight, made.group)
