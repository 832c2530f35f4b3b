"""Weighted least squares with a group effect, on sums formed by Spark.

A fit needs one aggregation over the rows: the cross products of the (centred, scaled) regressors
per group. There are as many result rows as groups (years), whatever the number of flows, and
partial sums are formed before the shuffle. The p x p system is solved on the driver, p being
the number of coefficients. Prediction and influence measures are column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorflow.functions import semantics as S
from mirrorflow.functions.distributions import f_upper, t_two_sided

INTERCEPT = "(Intercept)"
ALIAS_TOLERANCE = 1e-11  # squared length left of a column after removing the earlier ones
FULL_LEVERAGE = 1.0 - 1e-8
MAX_LEVELS = 1000


@dataclass
class Centre:
    """Shift and scale of each regressor and shift of the response; any values near the data do."""

    mean: list[float]
    scale: list[float]
    y: float


@dataclass
class LinearModel:
    """What a prediction needs: estimates by term name, regressors, group column, its levels.

    The first level is the base and has no term of its own.
    """

    coefficients: dict[str, float | None]
    x: list[str]
    group: str | None = None
    levels: list[str] = field(default_factory=list)

    @property
    def intercept(self) -> float:
        return self.coefficients[INTERCEPT]


@dataclass
class Fit:
    """A fitted model. Lists follow ``terms``; aliased terms have estimate None."""

    y: str
    x: list[str]
    weight: str | None
    group: str | None
    levels: list[str]
    terms: list[str]
    estimate: list[float | None]
    std_error: list[float | None]
    centre: Centre
    beta: np.ndarray  # coefficients of intercept, scaled regressors, levels; 0 where aliased
    ginv: np.ndarray  # inverse cross products in the same coordinates; 0 where aliased
    n: int
    rank: int
    rss: float
    tss: float
    outliers: int | None = field(default=None)

    @property
    def p(self) -> int:
        """Number of coefficients, aliased ones included."""
        return len(self.terms)

    @property
    def df_residual(self) -> int:
        return self.n - self.rank

    @property
    def sigma2(self) -> float:
        return self.rss / self.df_residual if self.df_residual > 0 else float("nan")

    @property
    def r_squared(self) -> float:
        return 1.0 - self.rss / self.tss

    @property
    def intercept(self) -> float:
        return self.estimate[0]

    def coefficient(self, term: str) -> float | None:
        return self.estimate[self.terms.index(term)]

    @property
    def model(self) -> LinearModel:
        return LinearModel(dict(zip(self.terms, self.estimate)), self.x, self.group, self.levels)


# --- fitting ----------------------------------------------------------------------------------


def complete_rows(
    df: DataFrame, y: str, x: Sequence[str], weight: str | None, group: str | None
) -> DataFrame:
    """The model columns of rows without a missing one (NULL or NaN).

    Written as NOT NULL conditions, which Catalyst pushes to the scan and which spare the
    expressions built on these columns their NULL checks.
    """
    names = list(dict.fromkeys([y, *x, *([weight] if weight else []), *([group] if group else [])]))
    out = df.select(*names)
    for c, t in out.dtypes:
        out = out.filter(F.col(c).isNotNull())
        if t in ("double", "float"):
            out = out.filter(~F.isnan(c))
    return out


def find_centre(df: DataFrame, y: str, x: Sequence[str]) -> Centre:
    """Means and standard deviations, from one aggregation."""
    aggs = [F.avg(y)]
    for c in x:
        aggs += [F.avg(c), F.stddev_pop(c)]
    row = df.agg(*aggs).first()
    if row is None or row[0] is None:
        raise ValueError("no complete rows to fit")
    return Centre(
        mean=[float(row[1 + 2 * i]) for i in range(len(x))],
        scale=[float(row[2 + 2 * i]) or 1.0 for i in range(len(x))],
        y=float(row[0]),
    )


def scaled(x: Sequence[str], centre: Centre) -> list[Column]:
    return [
        (F.col(c) - F.lit(m)) * F.lit(1.0 / s)
        for c, m, s in zip(x, centre.mean, centre.scale)
    ]


def cross_products(
    df: DataFrame,
    y: str,
    x: Sequence[str],
    weight: str | None,
    group: str | None,
    centre: Centre,
) -> DataFrame:
    """Per group: n, and the weighted sums of products of 1, the regressors and the response."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    z = [F.lit(1.0), *scaled(x, centre), F.col(y) - F.lit(centre.y)]
    names = [f"_z{i}" for i in range(len(z))]
    group_col = F.col(group).cast("string") if group else F.lit("all")
    rows = df.select(
        group_col.alias("_g"), w.alias("_w"), *[c.alias(n) for c, n in zip(z, names)]
    )
    finite = S.is_finite("_w")
    for n in names:
        finite = finite & S.is_finite(n)
    sums = [
        F.sum(F.col("_w") * F.col(names[i]) * F.col(names[j])).alias(f"s_{i}_{j}")
        for i in range(len(names))
        for j in range(i, len(names))
    ]
    return rows.groupBy("_g").agg(
        F.count_if(F.col("_w") != 0).alias("n"), F.count_if(~finite).alias("n_bad"), *sums
    )


def independent(m: np.ndarray) -> list[int]:
    """Columns kept when those that depend on earlier ones are dropped in order."""
    kept: list[int] = []
    for j in range(m.shape[0]):
        left = m[j, j]
        if left <= 0:
            continue
        if kept:
            cross = m[np.ix_(kept, [j])]
            left = left - float((cross.T @ np.linalg.solve(m[np.ix_(kept, kept)], cross))[0, 0])
        if left > ALIAS_TOLERANCE * m[j, j]:
            kept.append(j)
    return kept


def check_levels(rows: DataFrame, group: str) -> list[str]:
    """The values of ``group`` in ascending order; raises if there are more than ``MAX_LEVELS``.

    A fit keeps a row per value on the driver, and the square of their number there. Finer groups
    have to be absorbed before, by taking all columns about their group means.
    """
    found = rows.select(F.col(group).cast("string").alias("g")).distinct().limit(MAX_LEVELS + 1).collect()
    if len(found) > MAX_LEVELS:
        raise ValueError(f"{group} has more than {MAX_LEVELS} values")
    return sorted(r["g"] for r in found)


def add_group_effect(
    df: DataFrame, group: str, effects: dict[str, float], levels: Sequence[str], name: str
) -> DataFrame:
    """``name``: the effect of the row's group value, 0 for levels without one.

    NULL for a NULL group; a value that is none of ``levels`` raises when the row is computed.
    """
    table = df.sparkSession.createDataFrame(
        [(str(g), float(effects.get(g) or 0.0)) for g in levels], "_level string, _value double"
    )
    key = F.col(group).cast("string")
    # a row per level, of which a fit has MAX_LEVELS at most
    out = df.join(F.broadcast(table), key == F.col("_level"), "left")
    unseen = F.raise_error(F.concat(F.lit(f"{group} not in the model: "), key)).cast("double")
    effect = F.when(key.isNull(), F.lit(None).cast("double"))
    effect = effect.when(F.col("_level").isNull(), unseen).otherwise(F.col("_value"))
    return out.withColumn(name, effect).drop("_level", "_value")


def fit_wls(
    df: DataFrame,
    y: str,
    x: Sequence[str],
    weight: str | None = None,
    group: str | None = None,
    centre: Centre | None = None,
) -> Fit:
    """Least squares of ``y`` on an intercept, ``x`` and one effect per value of ``group``.

    The first group value in ascending order is the base. Rows with a missing model column are
    left out. A regressor that depends linearly on earlier ones gets no estimate. ``centre``
    saves the pass that finds it, e.g. when a model is refitted to part of its rows.
    """
    x = list(x)
    rows = complete_rows(df, y, x, weight, group)
    if centre is None:
        centre = find_centre(rows, y, x)
    if group:
        check_levels(rows, group)
    blocks = sorted(cross_products(rows, y, x, weight, group, centre).collect(), key=lambda r: r["_g"])
    if sum(r["n_bad"] for r in blocks):
        raise ValueError("model columns hold infinite or NaN values")
    blocks = [r for r in blocks if r["n"] > 0]
    if not blocks:
        raise ValueError("no complete rows to fit")

    k = len(x)
    dim = k + 2  # intercept, regressors, response
    levels = [r["_g"] for r in blocks] if group else []
    p = 1 + k + max(len(levels) - 1, 0)
    m, v, yy, wsum, wy = np.zeros((p, p)), np.zeros(p), 0.0, 0.0, 0.0
    for t, r in enumerate(blocks):
        s = np.zeros((dim, dim))
        for i in range(dim):
            for j in range(i, dim):
                s[i, j] = s[j, i] = r[f"s_{i}_{j}"]
        own = list(range(k + 1))
        m[np.ix_(own, own)] += s[: k + 1, : k + 1]
        v[: k + 1] += s[: k + 1, dim - 1]
        if t > 0:  # the level's dummy repeats the intercept's sums of this block
            d = k + t
            m[d, : k + 1] = m[: k + 1, d] = s[0, : k + 1]
            m[d, d] = s[0, 0]
            v[d] = s[0, dim - 1]
        yy += s[dim - 1, dim - 1]
        wsum += s[0, 0]
        wy += s[0, dim - 1]

    kept = independent(m)
    ginv, beta = np.zeros((p, p)), np.zeros(p)
    ginv[np.ix_(kept, kept)] = np.linalg.inv(m[np.ix_(kept, kept)])
    beta[kept] = np.linalg.solve(m[np.ix_(kept, kept)], v[kept])
    n, rank = int(sum(r["n"] for r in blocks)), len(kept)
    rss = max(float(yy - 2 * beta @ v + beta @ m @ beta), 0.0)
    tss = float(yy - wy * wy / wsum)

    # back to the columns as given
    back = np.eye(p)
    for j in range(k):
        back[1 + j, 1 + j] = 1.0 / centre.scale[j]
        back[0, 1 + j] = -centre.mean[j] / centre.scale[j]
    coef = back @ beta
    coef[0] += centre.y
    s2 = rss / (n - rank) if n > rank else float("nan")
    var = np.diag(back @ ginv @ back.T) * s2
    aliased = set(range(p)) - set(kept)
    return Fit(
        y=y,
        x=x,
        weight=weight,
        group=group,
        levels=levels,
        terms=[INTERCEPT, *x, *[f"{group}{g}" for g in levels[1:]]],
        estimate=[None if j in aliased else float(coef[j]) for j in range(p)],
        std_error=[None if j in aliased else float(np.sqrt(var[j])) for j in range(p)],
        centre=centre,
        beta=beta,
        ginv=ginv,
        n=n,
        rank=rank,
        rss=rss,
        tss=tss,
    )


# --- prediction -------------------------------------------------------------------------------


def predict(df: DataFrame, model: LinearModel, name: str) -> DataFrame:
    """Linear predictor; aliased terms (None) count as absent.

    A missing regressor gives NULL (or NaN). A group value the model has not seen raises.
    """
    out = F.lit(float(model.coefficients.get(INTERCEPT) or 0.0))
    for c in model.x:
        if model.coefficients.get(c) is not None:
            out = out + F.col(c) * F.lit(float(model.coefficients[c]))
    if not model.group:
        return df.withColumn(name, out)
    effects = {g: model.coefficients.get(f"{model.group}{g}") for g in model.levels}
    df = add_group_effect(df, model.group, effects, [str(g) for g in model.levels], "_effect")
    return df.withColumn(name, out + F.col("_effect")).drop("_effect")


# --- influence and outliers -------------------------------------------------------------------

DIAGNOSTICS = ("fitted", "residual", "hat", "std_resid", "stud_resid", "cooksd")


def _fit_terms(df: DataFrame, fit: Fit) -> tuple[DataFrame, Column, Column, list[str]]:
    """``df`` with the terms that depend on the group, the fitted value, the leverage, and the
    names of the columns added.

    The group's share of the quadratic form comes from a table with one row per level.
    """
    k = len(fit.x)
    g, b = fit.ginv, fit.beta
    rows = []
    for t, level in enumerate(fit.levels or [None]):
        eff = [0] if t == 0 else [0, k + t]
        lin = [float(2 * sum(g[1 + j, e] for e in eff) / fit.centre.scale[j]) for j in range(k)]
        const = float(sum(g[e, f] for e in eff for f in eff))
        rows.append((level, float(sum(b[e] for e in eff)) + fit.centre.y, const, *lin))
    if fit.group:
        own = [f"_{c}{fit.n}" for c in ("level", "effect", "const", *[f"lin{j}" for j in range(k)])]
        schema = ", ".join(f"{c} {'string' if i == 0 else 'double'} not null" for i, c in enumerate(own))
        per_level = df.sparkSession.createDataFrame(rows, schema)
        # one row per level, all of which were on the driver for the fit: broadcasting is safe
        on = F.col(fit.group).cast("string") == F.col(own[0])
        df = df.join(F.broadcast(per_level), on)
        effect, const, *lin = [F.col(c) for c in own[1:]]
    else:
        own = []
        effect, const, *lin = [F.lit(v) for v in rows[0][1:]]
    # scales go into the coefficients: the expression is evaluated per row and should stay short
    d = [F.col(c) - F.lit(m) for c, m in zip(fit.x, fit.centre.mean)]
    scale = fit.centre.scale
    fitted, quad = effect, const
    for i in range(k):
        fitted = fitted + d[i] * F.lit(float(b[1 + i] / scale[i]))
        inner = lin[i]
        for j in range(i, k):
            a = g[1 + i, 1 + j] * (1 if i == j else 2) / (scale[i] * scale[j])
            inner = inner + d[j] * F.lit(float(a))
        quad = quad + d[i] * inner
    return df, fitted, _weight(fit) * quad, own


def _weight(fit: Fit) -> Column:
    return F.col(fit.weight).cast("double") if fit.weight else F.lit(1.0)


def influence(df: DataFrame, fit: Fit) -> DataFrame:
    """Fitted value, residual, leverage, standardised and studentised residual, Cook's distance.

    ``std_resid`` is scaled by the fit's own error (internal), ``stud_resid`` by the error
    without the row (external). Where the leverage is 1 the last three are NULL. ``df`` holds
    the rows of the fit; rows of a group value it has not seen are dropped.
    """
    out, fitted, hat, own = _fit_terms(df, fit)
    w = _weight(fit)
    out = out.withColumns({"fitted": fitted, "hat": hat}).drop(*own)
    out = out.withColumn("residual", F.col(fit.y) - F.col("fitted"))
    rest = F.when(F.col("hat") <= FULL_LEVERAGE, 1 - F.col("hat"))
    error = F.sqrt(rest) * F.lit(fit.sigma2**0.5)
    out = out.withColumn(
        "std_resid", S.nan_to_null(S.ieee_div(F.sqrt(w) * F.col("residual"), error))
    )
    r2 = F.col("std_resid") * F.col("std_resid")
    left = F.greatest(F.lit(float(fit.df_residual)) - r2, F.lit(0.0))
    studentised = F.col("std_resid") * F.sqrt(S.ieee_div(F.lit(fit.df_residual - 1.0), left))
    cooks = S.ieee_div(r2 * F.col("hat"), rest * F.lit(float(fit.rank)))
    return out.withColumns(
        {"stud_resid": S.nan_to_null(studentised), "cooksd": S.nan_to_null(cooks)}
    )


def _check_spread(fit: Fit) -> None:
    """The rules need an error variance and more rows than coefficients."""
    if fit.n <= fit.p + 1 or not fit.rss > 0:
        raise ValueError("outliers are not defined for a perfect fit or with so few rows")


def remove_outliers(df: DataFrame, fit: Fit, two_sided: bool = False) -> DataFrame:
    """Rows with a studentised residual below 2, Cook's distance below 4/(n-p-1) and leverage
    below 2p/n. Only large positive residuals count as outliers unless ``two_sided``.

    All three rules bound the leverage once the residual is known, so they are written as one
    bound. That keeps the filter small, and the rounds of ``fit_trimmed`` stack up: Catalyst
    pushes each down and inlines what it refers to, and a large method is not compiled by the
    JVM's JIT.
    """
    _check_spread(fit)
    out, fitted, hat, own = _fit_terms(df, fit)
    df_res, s2 = fit.df_residual, fit.sigma2
    e = F.sqrt(_weight(fit)) * (F.col(fit.y) - fitted)
    # studentised, with r = e / sqrt(s2 (1-h)): r^2 (df-1) / (df - r^2) < 4
    large = e if two_sided else F.greatest(e, F.lit(0.0))
    by_residual = 1 - large * large * F.lit((df_res + 3.0) / (4.0 * df_res * s2))
    # Cook: a h < (1-h)^2 with a = e^2 (n-p-1) / (4 rank s2); exp(-2 asinh(sqrt(a)/2)) is the root
    half = 0.5 * ((fit.n - fit.p - 1) / (4.0 * fit.rank * s2)) ** 0.5
    by_cook = F.exp(F.asinh(F.abs(e) * F.lit(half)) * F.lit(-2.0))
    bound = F.least(F.lit(min(2.0 * fit.p / fit.n, FULL_LEVERAGE)), by_residual, by_cook)
    return out.filter(hat < bound).select(*df.columns)


def count_outliers(df: DataFrame, fit: Fit, two_sided: bool = False) -> DataFrame:
    """One row: rows that break a rule, judged by the standardised (internal) residual."""
    _check_spread(fit)
    rows = influence(complete_rows(df, fit.y, fit.x, fit.weight, fit.group), fit)
    r = F.abs("std_resid") if two_sided else F.col("std_resid")
    kept = (
        (r < 2)
        & (F.col("cooksd") < 4.0 / (fit.n - fit.p - 1))
        & (F.col("hat") < 2.0 * fit.p / fit.n)
    )
    return rows.agg(F.count_if(~kept).alias("outliers"))


def fit_trimmed(
    df: DataFrame,
    y: str,
    x: Sequence[str],
    weight: str | None = None,
    group: str | None = None,
    rounds: int = 3,
    two_sided: bool = False,
) -> tuple[Fit, list[int], DataFrame]:
    """Fit, then ``rounds`` times drop outliers and refit.

    Returns the last fit, the rows used by each fit, and the rows of the last fit. Each refit
    reads ``df`` again and applies the earlier rounds' rules as one filter; nothing is cached.
    ``df`` should be a written table.
    """
    rows = complete_rows(df, y, x, weight, group)
    fit = fit_wls(rows, y, x, weight, group)
    used = [fit.n]
    for _ in range(rounds):
        rows = remove_outliers(rows, fit, two_sided)
        fit = fit_wls(rows, y, x, weight, group, fit.centre)
        used.append(fit.n)
    return fit, used, rows


# --- reports and storage ----------------------------------------------------------------------

COEFFICIENTS = "term string, estimate double, std_error double, statistic double, p_value double"


def coefficient_rows(fit: Fit) -> list[tuple]:
    out = []
    for term, b, se in zip(fit.terms, fit.estimate, fit.std_error):
        if b is None or not se > 0:
            out.append((term, b, se, None, None))
        else:
            out.append((term, b, se, b / se, t_two_sided(b / se, fit.df_residual)))
    return out


def coefficient_table(spark: SparkSession, fit: Fit) -> DataFrame:
    return spark.createDataFrame(coefficient_rows(fit), COEFFICIENTS)


def reset_test(
    df: DataFrame, fit: Fit, weight: str | None = None, power: int = 2
) -> dict[str, float]:
    """Does a power of the fitted values add to the model? F statistic and p-value.

    The test regression is unweighted unless ``weight`` names a column.
    """
    rows = complete_rows(df, fit.y, fit.x, fit.weight, fit.group)
    base = fit_wls(rows, fit.y, fit.x, weight, fit.group)
    fitted = predict(rows, base.model, "_fitted")
    wider = fitted.withColumn("_power", F.pow("_fitted", F.lit(float(power))))
    more = fit_wls(wider, fit.y, [*fit.x, "_power"], weight, fit.group)
    if more.coefficient("_power") is None:
        raise ValueError("the power depends on the regressors: the test is not defined")
    df2 = more.n - more.rank
    stat = (base.rss - more.rss) / (more.rss / df2)
    return {"statistic": stat, "df1": 1.0, "df2": float(df2), "p_value": f_upper(stat, 1, df2)}


def save_fit(spark: SparkSession, fit: Fit, path: str) -> None:
    """Store the coefficients and the measures of a fit as two small tables."""
    roles = [("intercept", None)] + [("regressor", None)] * len(fit.x)
    roles += [("level", g) for g in fit.levels[1:]]
    rows = [
        (i, role, level, *c) for i, ((role, level), c) in enumerate(zip(roles, coefficient_rows(fit)))
    ]
    spark.createDataFrame(
        rows, f"position int, role string, level string, {COEFFICIENTS}"
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/coefficients")
    base = fit.levels[0] if fit.levels else None
    spark.createDataFrame(
        [(fit.y, fit.weight, fit.group, base, fit.n, fit.p, fit.rank, fit.rss, fit.tss, fit.outliers)],
        "y string, weight string, group string, base string, n bigint, p int, rank int,"
        " rss double, tss double, outliers bigint",
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/measures")


def load_model(spark: SparkSession, path: str) -> LinearModel:
    terms = spark.read.parquet(f"{path}/coefficients").orderBy("position").collect()
    m = spark.read.parquet(f"{path}/measures").first()
    return LinearModel(
        coefficients={r["term"]: r["estimate"] for r in terms},
        x=[r["term"] for r in terms if r["role"] == "regressor"],
        group=m["group"],
        levels=([m["base"]] if m["base"] else []) + [r["level"] for r in terms if r["role"] == "level"],
    )
