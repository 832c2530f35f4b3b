"""Poisson pseudo-maximum-likelihood by Newton steps on sums formed by Spark.

A step needs one aggregation over the rows: per group the information matrix and the score, with
partial sums before the shuffle. The p x p system is solved on the driver.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorflow.functions import semantics as S
from mirrorflow.functions.distributions import normal_two_sided
from mirrorflow.operators.ols import (
    INTERCEPT, Centre, LinearModel, add_group_effect, check_levels, complete_rows, find_centre,
    independent, predict, scaled,
)


@dataclass
class PoissonFit:
    """Estimates with quasi-Poisson errors (scaled by the Pearson dispersion).

    Terms that depend on earlier ones have no estimate (None).
    """

    y: str
    x: list[str]
    group: str | None
    levels: list[str]
    terms: list[str]
    estimate: list[float | None]
    std_error: list[float | None]
    dispersion: float
    n: int
    pseudo_r_squared: float

    @property
    def model(self) -> LinearModel:
        """The linear index; its exponential is the fitted value."""
        return LinearModel(dict(zip(self.terms, self.estimate)), self.x, self.group, self.levels)

    @property
    def statistic(self) -> list[float | None]:
        return [b / s if b is not None and s else None for b, s in zip(self.estimate, self.std_error)]

    @property
    def p_value(self) -> list[float | None]:
        return [None if z is None else normal_two_sided(z) for z in self.statistic]


class NotConvergedError(RuntimeError):
    """The steps allowed were used up before the estimates settled."""


def _sums(df: DataFrame, y: str, z: list[Column], index: Column, group: Column) -> DataFrame:
    """Per group the information, the score and what the measures of fit need."""
    names = [f"_z{i}" for i in range(len(z) + 1)]
    rows = df.select(
        group.alias("_g"), F.col(y).cast("double").alias("_y"), F.exp(index).alias("_mu"),
        F.lit(1.0).alias(names[0]), *[c.alias(n) for c, n in zip(z, names[1:])],
    )
    finite = S.is_finite("_y") & S.is_finite("_mu") & (F.col("_mu") > 0)
    for n in names:
        finite = finite & S.is_finite(n)
    rows = rows.withColumn("_gap", F.col("_y") - F.col("_mu"))
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.coalesce(finite, F.lit(False))).alias("n_bad"),
        F.count_if(F.col("_y") < 0).alias("n_negative"),
        F.sum("_y").alias("y"), F.sum(F.col("_y") * F.col("_y")).alias("yy"),
        F.sum("_mu").alias("mu"), F.sum(F.col("_mu") * F.col("_mu")).alias("mumu"),
        F.sum(F.col("_y") * F.col("_mu")).alias("ymu"),
        F.sum(S.ieee_div(F.col("_gap") * F.col("_gap"), F.col("_mu"))).alias("pearson"),
    ]
    for i, a in enumerate(names):
        aggs.append(F.sum(F.col("_gap") * F.col(a)).alias(f"g_{i}"))
        for j in range(i, len(names)):
            aggs.append(F.sum(F.col("_mu") * F.col(a) * F.col(names[j])).alias(f"s_{i}_{j}"))
    return rows.groupBy("_g").agg(*aggs)


def _assembled(blocks: list, k: int, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Information matrix and score of intercept, regressors and levels (the first one is the base)."""
    m, v = np.zeros((p, p)), np.zeros(p)
    for t, r in enumerate(blocks):
        s = np.zeros((k + 1, k + 1))
        for i in range(k + 1):
            for j in range(i, k + 1):
                s[i, j] = s[j, i] = r[f"s_{i}_{j}"]
        g = np.array([r[f"g_{i}"] for i in range(k + 1)])
        m[: k + 1, : k + 1] += s
        v[: k + 1] += g
        if t > 0:
            d = k + t
            m[d, : k + 1] = m[: k + 1, d] = s[0]
            m[d, d], v[d] = s[0, 0], g[0]
    return m, v


def fit_ppml(
    df: DataFrame,
    y: str,
    x: Sequence[str],
    group: str | None = None,
    max_steps: int = 50,
    tolerance: float = 1e-9,
) -> PoissonFit:
    """Fit E[y] = exp(intercept + x'b + effect of group), the smallest group value as base.

    Reads ``df`` once per step; it should be a written table. Steps go on until no coefficient (of
    scaled regressors) moves by more than ``tolerance``; raises ``NotConvergedError`` if
    ``max_steps`` are not enough. Raises ``ValueError`` for negative responses, infinite values, and
    fitted values beyond the range of a double, so every row counts in every sum.
    """
    x = list(x)
    rows = complete_rows(df, y, x, None, group)
    centre: Centre = find_centre(rows, y, x)
    z = scaled(x, centre)
    key = F.col(group).cast("string") if group else F.lit("all")
    levels = check_levels(rows, group) if group else []
    if not centre.y > 0 or centre.y == float("inf"):
        raise ValueError("the response has to be finite, not negative, and not all zero")
    k, p = len(x), 1 + len(x) + max(len(levels) - 1, 0)
    beta = np.zeros(p)
    beta[0] = np.log(centre.y)
    kept: list[int] | None = None
    for _ in range(max_steps):
        index, at = F.lit(float(beta[0])), rows
        for c, b in zip(z, beta[1 : k + 1]):
            index = index + c * F.lit(float(b))
        if group:
            at = add_group_effect(rows, group, dict(zip(levels[1:], map(float, beta[k + 1 :]))), levels, "_effect")
            index = index + F.col("_effect")
        blocks = sorted(_sums(at, y, z, index, key).collect(), key=lambda r: r["_g"])
        if sum(r["n_negative"] for r in blocks):
            raise ValueError("the response holds negative values")
        if sum(r["n_bad"] for r in blocks):
            raise ValueError("values or fitted values are infinite, NaN or beyond the range of a double")
        m, v = _assembled(blocks, k, p)
        if kept is None:
            kept = independent(m)
        own = np.ix_(kept, kept)
        step = np.zeros(p)
        step[kept] = np.linalg.solve(m[own], v[kept])
        beta = beta + step
        if np.abs(step).max() <= tolerance:
            break
    else:
        raise NotConvergedError(f"the fit did not converge in {max_steps} steps")

    def total(name: str) -> float:
        return float(sum(r[name] for r in blocks))

    n, rank = int(total("n")), len(kept)
    dispersion = total("pearson") / (n - rank) if n > rank else float("nan")
    cov = total("ymu") - total("y") * total("mu") / n
    spread = (total("yy") - total("y") ** 2 / n) * (total("mumu") - total("mu") ** 2 / n)
    back = np.eye(p)
    for j in range(k):
        back[1 + j, 1 + j] = 1.0 / centre.scale[j]
        back[0, 1 + j] = -centre.mean[j] / centre.scale[j]
    ginv = np.zeros((p, p))
    ginv[own] = np.linalg.inv(m[own])
    coef, var = back @ beta, np.diag(back @ ginv @ back.T) * dispersion
    aliased = set(range(p)) - set(kept)
    return PoissonFit(
        y=y,
        x=x,
        group=group,
        levels=levels,
        terms=[INTERCEPT, *x, *[f"{group}{g}" for g in levels[1:]]],
        estimate=[None if j in aliased else float(coef[j]) for j in range(p)],
        std_error=[None if j in aliased else float(np.sqrt(var[j])) for j in range(p)],
        dispersion=dispersion,
        n=n,
        pseudo_r_squared=cov * cov / spread if spread > 0 else float("nan"),
    )


def reset_ppml(df: DataFrame, fit: PoissonFit) -> dict[str, float]:
    """z test on the squared linear index, added as the last regressor.

    All regressors and the index are taken about their means. With an intercept in the model
    this leaves the tested term and its error as they are, and keeps it apart from the others.
    Raises ``ValueError`` if the squared index depends on the regressors.
    """
    rows = complete_rows(df, fit.y, fit.x, None, fit.group)
    rows = predict(rows, fit.model, "_index")
    names = [*fit.x, "_index"]
    means = rows.agg(*[F.avg(c).alias(c) for c in names]).first()
    rows = rows.withColumns({c: F.col(c) - F.lit(means[c]) for c in names})
    wider = rows.withColumn("predict2", F.col("_index") * F.col("_index"))
    more = fit_ppml(wider, fit.y, [*fit.x, "predict2"], fit.group)
    z = more.statistic[1 + len(fit.x)]
    if z is None:
        raise ValueError("the squared index depends on the regressors: the test is not defined")
    return {"statistic": z, "p_value": normal_two_sided(z)}


def save_ppml(spark: SparkSession, fit: PoissonFit, path: str) -> None:
    """Store a fit as a table of one row."""
    row = [(json.dumps(asdict(fit)),)]
    spark.createDataFrame(row, "fit string").coalesce(1).write.mode("overwrite").parquet(path)


def load_ppml(spark: SparkSession, path: str) -> PoissonFit:
    return PoissonFit(**json.loads(spark.read.parquet(path).first()["fit"]))
