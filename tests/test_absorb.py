"""Absorbed effects against fits with a dummy variable per level, by numpy."""

import numpy as np
import pytest

from mirrorflow.operators import absorb, ppml

SCHEMA = "y double, x1 double, x2 double, x3 double, w double, a string, b string, c int"


def rows_of(seed=0, n=900):
    """Effects of uneven size, some levels seen once, and one level that holds a third of the rows."""
    rng = np.random.default_rng(seed)
    a = np.where(rng.random(n) < 0.33, 0, rng.integers(0, 40, n))
    b, c = rng.integers(0, 12, n), rng.integers(0, 3, n)
    x1 = rng.standard_normal(n) + 0.1 * a
    x2 = rng.random(n) * 50 - 3 * b
    x3 = a * 2.0  # explained by the effect
    mu = np.exp(0.3 * x1 - 0.02 * x2 + 0.05 * a - 0.1 * b + 0.2 * c)
    y = rng.poisson(mu).astype(float)
    w = rng.random(n) + 0.2
    return [
        (float(y[i]), float(x1[i]), float(x2[i]), float(x3[i]), float(w[i]), f"a{a[i]}", f"b{b[i]}", int(c[i]))
        for i in range(n)
    ]


def dummies(rows, effects, x):
    columns = [[r[x_] for x_ in x] for r in rows]
    design = [np.array(columns, float)]
    for e in effects:
        levels = sorted({r[e] for r in rows}, key=str)
        design.append(np.array([[r[e] == level for level in levels] for r in rows], float))
    return np.hstack(design)


def solve(d, y, w, k):
    """Slopes, variances (unscaled) and fitted values, by least squares of any rank."""
    s = np.sqrt(w)
    beta = np.linalg.lstsq(d * s[:, None], y * s, rcond=1e-12)[0]
    inverse = np.linalg.pinv((d * w[:, None]).T @ d, rcond=1e-12)
    return beta[:k], np.diag(inverse)[:k], d @ beta


@pytest.mark.parametrize("effects", [(5,), (5, 6), (5, 6, 7)])
def test_least_squares(spark, effects):
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    names = ["a", "b", "c"][: len(effects)]
    fit = absorb.fit_absorbed(df, "y", ["x1", "x3", "x2"], names, "w")
    d, y, w = dummies(rows, effects, (1, 2)), np.array([r[0] for r in rows]), np.array([r[4] for r in rows])
    beta, variance, fitted = solve(d, y, w, 2)
    rank = np.linalg.matrix_rank(d)
    sigma2 = (w * (y - fitted) ** 2).sum() / (len(rows) - rank)
    assert fit.estimate[1] is None and fit.std_error[1] is None and fit.rank == rank
    assert np.allclose([fit.estimate[0], fit.estimate[2]], beta, rtol=1e-7)
    assert np.allclose([fit.std_error[0], fit.std_error[2]], np.sqrt(variance * sigma2), rtol=1e-7)
    index = absorb.predict_absorbed(df, fit, "index").select("y", "x1", "x2", "index").collect()
    by_row = {(r[0], r[1], r[2]): f for r, f in zip(rows, fitted)}
    assert all(abs(r["index"] - by_row[r["y"], r["x1"], r["x2"]]) < 1e-6 for r in index)


@pytest.mark.parametrize("effects", [(5, 6), (5, 6, 7)])
def test_poisson(spark, effects):
    rows = rows_of(3)
    rows += [(0.0, 0.5, 1.0, 0.0, 1.0, "empty", "b1", 0)] * 4  # a level without a positive response
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    fit = absorb.fit_absorbed_ppml(df, "y", ["x1", "x2"], ["a", "b", "c"][: len(effects)])
    used = [r for r in rows if any(q[0] > 0 for q in rows if q[5] == r[5])]
    d, y = dummies(used, effects, (1, 2)), np.array([r[0] for r in used])
    eta = np.log((y + y.mean()) / 2)
    for _ in range(60):
        mu = np.exp(eta)
        beta, variance, eta = solve(d, eta + (y - mu) / mu, mu, 2)
    mu = np.exp(eta)
    rank = np.linalg.matrix_rank(d)
    pearson = ((y - mu) ** 2 / mu).sum() / (len(used) - rank)
    assert fit.n == len(used) and fit.rank == rank and abs(fit.dispersion - pearson) < 1e-6 * pearson
    assert np.allclose(fit.estimate, beta, rtol=1e-6)
    assert np.allclose(fit.std_error, np.sqrt(variance * pearson), rtol=1e-6)


def test_one_effect_equals_the_model_with_levels(spark):
    df = spark.createDataFrame(rows_of(5), SCHEMA)
    wide, fit = ppml.fit_ppml(df, "y", ["x1", "x2"], "c"), absorb.fit_absorbed_ppml(df, "y", ["x1", "x2"], ["c"])
    assert np.allclose(fit.estimate, wide.estimate[1:3], rtol=1e-7)
    assert np.allclose(fit.std_error, wide.std_error[1:3], rtol=1e-6)
    one, two = ppml.reset_ppml(df, wide), absorb.reset_absorbed_ppml(df, fit)
    assert abs(one["statistic"] - two["statistic"]) < 1e-5 * abs(one["statistic"])


def test_refused_input(spark):
    df = spark.createDataFrame(rows_of(n=30), SCHEMA)
    with pytest.raises(ValueError):
        absorb.fit_absorbed(df, "y", ["x1"], [])
    with pytest.raises(ValueError):
        absorb.fit_absorbed_ppml(df.selectExpr("y - 100 as y", "x1", "a", "b"), "y", ["x1"], ["a", "b"])
    with pytest.raises(ValueError):
        absorb.fit_absorbed(df.selectExpr("y", "x1 / 0.0D as x1", "a").selectExpr("y", "double('Infinity') as x1", "a"), "y", ["x1"], ["a"])
    with pytest.raises(ppml.NotConvergedError):
        rows = absorb.materialise(df.selectExpr("x1", "w", "a", "b"), "t")
        absorb.project_out(rows, ["x1"], "w", ["a", "b"], tolerance=0.0, max_cycles=2)


def test_rows_with_missing_values_are_left_out(spark):
    rows = rows_of(7, 200)
    more = [(None, 1.0, 1.0, 1.0, 1.0, "a1", "b1", 0), (1.0, 1.0, 1.0, 1.0, 1.0, None, "b1", 0), (1.0, 9.0, 1.0, 1.0, 0.0, "zz", "b1", 0)]
    one = absorb.fit_absorbed(spark.createDataFrame(rows, SCHEMA), "y", ["x1"], ["a", "b"], "w")
    two = absorb.fit_absorbed(spark.createDataFrame(rows + more, SCHEMA), "y", ["x1"], ["a", "b"], "w")
    assert one.n == two.n and np.allclose(one.estimate, two.estimate, rtol=1e-9)
