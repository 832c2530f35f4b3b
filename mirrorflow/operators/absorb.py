"""Regressions with absorbed effects: any number of effect columns with any number of levels.

No column is made per level, and nothing per level reaches the driver. Each column of the model is taken
about its effects by alternating projections: the level values of one effect are the weighted means of what the
others leave, in turn, until they settle. They are kept as one small table per effect, found by an aggregation
and joined back to the rows, whose table is not written again. The regressors so cleared are solved for on
the driver by sums over the rows. The Poisson model repeats that with the weights and the response of each
of its steps, which start from the level values of the step before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorflow.functions import semantics as S
from mirrorflow.functions.distributions import normal_two_sided, t_two_sided
from mirrorflow.operators.ols import Centre, complete_rows, find_centre, independent, scaled
from mirrorflow.operators.ppml import NotConvergedError
from mirrorflow.sources.scratch import materialise

Stage = Callable[[DataFrame, str], DataFrame]

CLEARED = 1e-10  # share of a regressor's squares left by the effects that counts as none


@dataclass(frozen=True)
class AbsorbedFit:
    """Slopes with their errors; those the effects or earlier regressors explain are None.

    ``effects`` holds a table (``level``, ``value``) per effect column. The sum of the effects and of the slopes
    times the regressors is the linear index; how much of a common constant is in which effect is
    arbitrary. ``dispersion`` is the error variance of least squares, or Pearson's of the Poisson model.
    """

    y: str
    x: list[str]
    effects: dict[str, DataFrame]
    estimate: list[float | None]
    std_error: list[float | None]
    dispersion: float
    n: int
    rank: int
    poisson: bool

    @property
    def statistic(self) -> list[float | None]:
        return [b / s if b is not None and s else None for b, s in zip(self.estimate, self.std_error)]

    @property
    def p_value(self) -> list[float | None]:
        df = self.n - self.rank
        tail = normal_two_sided if self.poisson else (lambda t: t_two_sided(t, df))
        return [None if t is None else tail(t) for t in self.statistic]


def _with_levels(rows: DataFrame, tables: dict[str, DataFrame], columns: Sequence[str]) -> tuple[DataFrame, dict[str, Column]]:
    """``rows`` joined with the level tables, and for each column what the levels add up to.

    The tables are written, so Catalyst knows their sizes: it broadcasts small ones and shuffles large ones.
    """
    parts: dict[str, Column] = {c: F.lit(0.0) for c in columns}
    for i, (effect, table) in enumerate(tables.items()):
        own = table.select(
            F.col("level").alias(f"_level{i}"), *[F.col(c).alias(f"_part{i}_{c}") for c in columns]
        )
        rows = rows.join(own, F.col(effect) == F.col(f"_level{i}"), "left")
        for c in columns:
            parts[c] = parts[c] + F.coalesce(F.col(f"_part{i}_{c}"), F.lit(0.0))
    return rows, parts


def project_out(
    rows: DataFrame, columns: Sequence[str], weight: str, effects: Sequence[str],
    start: dict[str, DataFrame] | None = None, tolerance: float = 1e-10, max_cycles: int = 2000, stage: Stage = materialise,
) -> tuple[dict[str, DataFrame], int]:
    """Level values of each effect that take ``columns`` about all effects, and the cycles it took.

    ``rows`` is a written table with positive weights and no missing value. A cycle forms the values of each
    effect in turn; it settles when no value of the last effect moves by more than ``tolerance``, so columns
    should be of order one. A single effect needs one cycle. Raises ``NotConvergedError`` after ``max_cycles``.
    """
    tables = dict(start or {})
    for cycle in range(1, max_cycles + 1):
        for effect in effects:
            others = {e: tables[e] for e in effects if e != effect and e in tables}
            joined, parts = _with_levels(rows, others, columns)
            w = F.col(weight)
            means = joined.groupBy(F.col(effect).alias("level")).agg(
                *[(F.sum(w * (F.col(c) - parts[c])) / F.sum(w)).alias(c) for c in columns]
            )
            old = tables.get(effect)
            if old is None:
                moved = F.lit(float("inf"))
            else:
                before = old.select(F.col("level").alias("_old"), *[F.col(c).alias(f"_old_{c}") for c in columns])
                means = means.join(before, F.col("level") == F.col("_old"), "left")
                gaps = [F.coalesce(F.abs(F.col(c) - F.col(f"_old_{c}")), F.lit(float("inf"))) for c in columns]
                moved = F.greatest(*gaps) if len(gaps) > 1 else gaps[0]
            tables[effect] = stage(means.select("level", *columns, moved.alias("moved")), "effect_levels")
        if len(effects) == 1 or (tables[effects[-1]].agg(F.max("moved")).first()[0] or 0.0) <= tolerance:
            return tables, cycle
    raise NotConvergedError(f"the effects did not settle in {max_cycles} cycles")


def cleared(rows: DataFrame, columns: Sequence[str], tables: dict[str, DataFrame]) -> DataFrame:
    """``rows`` with each of ``columns`` less its level values."""
    joined, parts = _with_levels(rows, tables, columns)
    kept = [F.col(c) for c in rows.columns if c not in columns]
    return joined.select(*kept, *[(F.col(c) - parts[c]).alias(c) for c in columns])


def _normal_equations(rows: DataFrame, names: Sequence[str], weight: str, more: dict[str, Column]) -> tuple[np.ndarray, dict[str, float]]:
    sums = {
        f"s_{i}_{j}": F.sum(F.col(weight) * F.col(names[i]) * F.col(names[j]))
        for i in range(len(names)) for j in range(i, len(names))
    }
    row = rows.agg(*[c.alias(n) for n, c in (sums | more).items()]).first()
    m = np.zeros((len(names), len(names)))
    for i in range(len(names)):
        for j in range(i, len(names)):
            m[i, j] = m[j, i] = row[f"s_{i}_{j}"] or 0.0
    return m, {n: float(row[n] or 0.0) for n in more}


def _solve(m: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Slopes, the inverse cross products and the regressors kept; the last column of ``m`` is the response.

    A regressor of whose squares (``before``) the effects leave next to nothing is dropped.
    """
    k = m.shape[0] - 1
    there = [j for j in range(k) if m[j, j] > CLEARED * before[j]]
    kept = [there[j] for j in independent(m[np.ix_(there, there)])]
    own, beta, inverse = np.ix_(kept, kept), np.zeros(k), np.zeros((k, k))
    if kept:
        beta[kept] = np.linalg.solve(m[own], m[kept, k])
        inverse[own] = np.linalg.inv(m[own])
    return beta, inverse, kept


def _prepared(df: DataFrame, y: str, x: list[str], weight: str | None, effects: list[str], stage: Stage) -> tuple[DataFrame, Centre]:
    """Rows without a missing value and with a positive weight: ``_y``, scaled ``_x0``, ..., ``_w``, the effects."""
    if not effects:
        raise ValueError("name at least one effect")
    rows = complete_rows(df, y, [*x, *effects], weight, None)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    centre = find_centre(rows, y, x)
    out = rows.select(
        *[F.col(e).cast("string").alias(e) for e in effects], F.col(y).cast("double").alias("_y"), w.alias("_w"),
        *[z.alias(f"_x{i}") for i, z in enumerate(scaled(x, centre))],
    ).filter("_w > 0")
    bad = F.lit(False)
    for c in ["_y", "_w", *[f"_x{i}" for i in range(len(x))]]:
        bad = bad | ~S.is_finite(c)
    out = stage(out, "absorbed_rows")
    if out.filter(bad).limit(1).count():
        raise ValueError("model columns hold infinite or NaN values")
    return out, centre


def _parts(rows: DataFrame, first: str, second: str, stage: Stage) -> int:
    """Parts into which the levels of two effects fall, those that share a row hanging together.

    Each level takes the least name that reaches it; names pass over the distinct pairs of levels until
    none changes. Only the number of parts reaches the driver.
    """
    pairs = stage(rows.select(F.col(first).alias("a"), F.col(second).alias("b")).distinct(), "level_pairs")
    names = stage(pairs.select("a", F.col("a").alias("name")).distinct(), "level_names")
    while True:
        far = pairs.join(names, "a").groupBy("b").agg(F.min("name").alias("name"))
        near = pairs.join(far, "b").groupBy("a").agg(F.min("name").alias("new")).join(names, "a")
        near = stage(near.select("a", F.col("new").alias("name"), (F.col("new") < F.col("name")).alias("moved")), "level_names")
        names = near.select("a", "name")
        if near.filter("moved").limit(1).count() == 0:
            return names.select("name").distinct().count()


def _rank(rows: DataFrame, tables: dict[str, DataFrame], kept: int, stage: Stage) -> int:
    """Slopes and levels, less the redundant ones: one per part of the first two effects, one per further effect."""
    effects = list(tables)
    rank = kept + sum(t.count() for t in tables.values())
    if len(effects) > 1:
        rank -= _parts(rows, effects[0], effects[1], stage) + len(effects) - 2
    return rank


def _level_values(tables: dict[str, DataFrame], response: str, names: Sequence[str], beta: np.ndarray) -> dict[str, DataFrame]:
    """Per effect the values of the linear index: those of the response less those of the regressors."""
    out = {}
    for effect, table in tables.items():
        value = F.col(response)
        for name, b in zip(names, beta):
            value = value - F.col(name) * F.lit(float(b))
        out[effect] = table.select("level", value.alias("value"))
    return out


def _unscaled(values: dict[str, DataFrame], beta: np.ndarray, centre: Centre, y: float = 0.0) -> dict[str, DataFrame]:
    """Level values for the regressors as given; the constant goes to the first effect."""
    constant = y - float(sum(b * m / s for b, m, s in zip(beta, centre.mean, centre.scale)))
    first = next(iter(values))
    return {
        e: t.select("level", (F.col("value") + F.lit(constant if e == first else 0.0)).alias("value"))
        for e, t in values.items()
    }


def fit_absorbed(
    df: DataFrame, y: str, x: Sequence[str], effects: Sequence[str], weight: str | None = None,
    tolerance: float = 1e-10, stage: Stage = materialise,
) -> AbsorbedFit:
    """Least squares of ``y`` on ``x`` and one effect per value of each of the ``effects`` columns.

    Rows with a missing value or a weight of 0 are left out. The rank is exact for up to two effects; of a
    third and any further one a single level is taken to be redundant.
    """
    x, effects = list(x), list(effects)
    rows, centre = _prepared(df, y, x, weight, effects, stage)
    rows = rows.withColumn("_y", F.col("_y") - F.lit(centre.y))
    names = [f"_x{i}" for i in range(len(x))]
    columns = [*names, "_y"]
    tables, _ = project_out(rows, columns, "_w", effects, None, tolerance, stage=stage)
    squares = {f"b_{i}": F.sum(F.col("_w") * F.col(c) * F.col(c)) for i, c in enumerate(columns)}
    more = squares | {"n": F.count(F.lit(1))}
    full = {n: float(v or 0.0) for n, v in rows.agg(*[c.alias(n) for n, c in more.items()]).first().asDict().items()}
    m, _ = _normal_equations(cleared(rows, columns, tables), columns, "_w", {})
    beta, inverse, kept = _solve(m, np.array([full[f"b_{i}"] for i in range(len(x))]))
    n, rank = int(full["n"]), _rank(rows, tables, len(kept), stage)
    k = len(x)
    rss = max(float(m[k, k] - beta @ m[:k, k]), 0.0)
    sigma2 = rss / (n - rank) if n > rank else float("nan")
    values = _unscaled(_level_values(tables, "_y", names, beta), beta, centre, centre.y)
    return _reported(y, x, values, beta, inverse * sigma2, kept, centre, sigma2, n, rank, False)


def _reported(
    y: str, x: list[str], values: dict[str, DataFrame], beta: np.ndarray, variance: np.ndarray, kept: list[int],
    centre: Centre, dispersion: float, n: int, rank: int, poisson: bool,
) -> AbsorbedFit:
    return AbsorbedFit(
        y=y, x=x, effects=values,
        estimate=[float(beta[j] / centre.scale[j]) if j in kept else None for j in range(len(x))],
        std_error=[float(variance[j, j] ** 0.5 / centre.scale[j]) if j in kept else None for j in range(len(x))],
        dispersion=dispersion, n=n, rank=rank, poisson=poisson,
    )


def _without_empty_levels(rows: DataFrame, effects: Sequence[str], stage: Stage) -> DataFrame:
    """Rows of levels whose responses are all zero are fitted exactly by no finite effect; they go.

    That may empty further levels, so it is repeated until none is left.
    """
    while True:
        before = rows.count()
        for effect in effects:
            used = rows.filter("_y > 0").select(F.col(effect).alias("_used")).distinct()
            rows = rows.join(used, F.col(effect) == F.col("_used"), "left_semi")
        rows = stage(rows, "absorbed_rows")
        if rows.count() == before:
            return rows


def fit_absorbed_ppml(
    df: DataFrame, y: str, x: Sequence[str], effects: Sequence[str], max_steps: int = 50, tolerance: float = 1e-9,
    stage: Stage = materialise,
) -> AbsorbedFit:
    """Fit E[y] = exp(x'b + one effect per value of each of the ``effects`` columns), quasi-Poisson errors.

    Each step is a weighted least squares fit with absorbed effects; how exactly its effects have to settle follows
    how much the step before moved, down to ``tolerance`` at the end. Rows with a missing value and rows
    of levels without a positive response are left out. Raises ``ValueError`` for negative responses
    and ``NotConvergedError`` if ``max_steps`` are not enough.
    """
    x, effects = list(x), list(effects)
    rows, centre = _prepared(df, y, x, None, effects, stage)
    if rows.filter("_y < 0").limit(1).count():
        raise ValueError("the response holds negative values")
    if not centre.y > 0:
        raise ValueError("the response must not be all zero")
    rows = _without_empty_levels(rows, effects, stage)
    names = [f"_x{i}" for i in range(len(x))]
    columns = [*names, "_z"]
    beta, values, tables = np.zeros(len(x)), None, None
    moved, deviance = 1.0, float("inf")

    def at(values: dict[str, DataFrame] | None, beta: np.ndarray) -> DataFrame:
        """Rows with the linear index ``_index`` and the fitted value ``_mu``."""
        if values is None:
            start = (F.col("_y") + F.lit(centre.y)) / 2
            return rows.withColumn("_index", S.ieee_log(start)).withColumn("_mu", start)
        joined, parts = _with_levels(rows, values, ["value"])
        index = parts["value"]
        for name, b in zip(names, beta):
            index = index + F.col(name) * F.lit(float(b))
        out = joined.select(*rows.columns, index.alias("_index"))
        return out.withColumn("_mu", F.exp("_index"))

    for _ in range(max_steps):
        work = at(values, beta).withColumn("_w", F.col("_mu"))
        work = work.withColumn("_z", F.col("_index") + (F.col("_y") - F.col("_mu")) / F.col("_mu"))
        work = stage(work.select(*effects, *columns, "_w", "_y", "_mu"), "absorbed_step")
        inner = max(tolerance, min(1e-2, 0.1 * moved))
        tables, _ = project_out(work, columns, "_w", effects, tables, inner, stage=stage)
        fitted = F.col("_y") * F.when(F.col("_y") > 0, S.ieee_log(S.ieee_div("_y", "_mu"))).otherwise(0.0)
        more = {"deviance": F.sum(fitted - (F.col("_y") - F.col("_mu")))}
        more |= {f"b_{i}": F.sum(F.col("_w") * F.col(f"_raw{i}") * F.col(f"_raw{i}")) for i in range(len(x))}
        raw = work.withColumns({f"_raw{i}": F.col(c) for i, c in enumerate(names)})
        m, found = _normal_equations(cleared(raw, columns, tables), columns, "_w", more)
        new, inverse, kept = _solve(m, np.array([found[f"b_{i}"] for i in range(len(x))]))
        change = float(np.abs(new - beta).max(initial=0.0))
        fall = abs(deviance - found["deviance"]) / max(abs(found["deviance"]), 1e-12) if np.isfinite(deviance) else 1.0
        beta, deviance = new, found["deviance"]
        values = _level_values(tables, "_z", names, beta)
        moved = max(change, fall)
        if inner <= tolerance and change <= 10 * tolerance and fall <= 10 * tolerance:
            break
    else:
        raise NotConvergedError(f"the fit did not converge in {max_steps} steps")
    gap = F.col("_y") - F.col("_mu")
    n, pearson = at(values, beta).agg(F.count(F.lit(1)), F.sum(gap * gap / F.col("_mu"))).first()
    rank = _rank(rows, tables, len(kept), stage)
    dispersion = pearson / (n - rank) if n > rank else float("nan")
    return _reported(
        y, x, _unscaled(values, beta, centre), beta, inverse * dispersion, kept, centre, dispersion, n, rank, True
    )


def predict_absorbed(df: DataFrame, fit: AbsorbedFit, name: str) -> DataFrame:
    """The linear index; NULL where a regressor is missing or a level has no value."""
    index, out = F.lit(0.0), df
    for c, b in zip(fit.x, fit.estimate):
        if b is not None:
            index = index + F.col(c) * F.lit(float(b))
    for i, (effect, table) in enumerate(fit.effects.items()):
        own = table.select(F.col("level").alias(f"_level{i}"), F.col("value").alias(f"_value{i}"))
        out = out.join(own, F.col(effect).cast("string") == F.col(f"_level{i}"), "left")
        index = index + F.col(f"_value{i}")
    return out.select(*df.columns, index.alias(name))


def reset_absorbed_ppml(df: DataFrame, fit: AbsorbedFit, stage: Stage = materialise) -> dict[str, float]:
    """z test on the squared linear index, added as the last regressor of the model with its effects.

    The index is taken about its mean, which with effects in the model changes neither term nor error.
    """
    rows = complete_rows(df, fit.y, [*fit.x, *fit.effects], None, None)
    rows = stage(predict_absorbed(rows, fit, "_index").filter("_index is not null"), "reset_rows")
    mean = rows.agg(F.avg("_index")).first()[0]
    wider = rows.withColumn("predict2", (F.col("_index") - F.lit(mean)) * (F.col("_index") - F.lit(mean)))
    more = fit_absorbed_ppml(wider, fit.y, [*fit.x, "predict2"], list(fit.effects), stage=stage)
    z = more.statistic[-1]
    if z is None:
        raise ValueError("the squared index depends on the regressors: the test is not defined")
    return {"statistic": z, "p_value": normal_two_sided(z)}
