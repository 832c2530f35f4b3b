import math

import numpy as np
import pytest

from mirrorflow.operators import ols, ppml
from mirrorflow.plans import analysis

X = ["log_dist", "log_dist_sq", "contig"]


def data(n=240, seed=3):
    """Distances with their square, a dummy, three years, weights and a noisy response."""
    rng = np.random.default_rng(seed)
    d = rng.uniform(5.5, 9.5, n)
    contig = (rng.uniform(size=n) < 0.4).astype(float)
    year = rng.integers(2000, 2003, n)
    w = rng.uniform(0.2, 1.0, n)
    y = 1.0 - 0.15 * d + 0.01 * d**2 + 0.1 * contig + 0.05 * (year == 2001) + rng.normal(0, 0.3, n)
    y[:8] += 3.0
    return d, contig, year, w, y


def frame(spark, d, contig, year, w, y):
    out = [
        (i, float(a), float(a * a), int(c), int(t), float(b), float(v), float(math.exp(v)))
        for i, (a, c, t, b, v) in enumerate(zip(d, contig, year, w, y))
    ]
    return spark.createDataFrame(
        out, "i int, log_dist double, log_dist_sq double, contig int, year int, w double, y double, ey double"
    ).repartition(4)


def design(d, contig, year):
    return np.column_stack([np.ones_like(d), d, d * d, contig, year == 2001, year == 2002]).astype(float)


def wls(m, y, w):
    g = np.linalg.inv(m.T @ (m * w[:, None]))
    b = g @ (m.T @ (w * y))
    e = y - m @ b
    s2 = (w * e * e).sum() / (len(y) - m.shape[1])
    return b, g, e, s2


def measures(m, y, w):
    b, g, e, s2 = wls(m, y, w)
    n, p = m.shape
    h = w * np.einsum("ij,jk,ik->i", m, g, m)
    r = np.sqrt(w) * e / np.sqrt(s2 * (1 - h))
    t = r * np.sqrt((n - p - 1) / (n - p - r * r))
    return h, r, t, r * r * h / ((1 - h) * p)


@pytest.fixture(scope="module")
def sample(spark):
    cols = data()
    return cols, frame(spark, *cols)


def test_coefficients_and_errors(sample):
    (d, contig, year, w, y), df = sample
    fit = ols.fit_wls(df, "y", X, "w", "year")
    b, g, e, s2 = wls(design(d, contig, year), y, w)
    assert fit.terms == ["(Intercept)", *X, "year2001", "year2002"]
    np.testing.assert_allclose(fit.estimate, b, rtol=1e-8)
    np.testing.assert_allclose(fit.std_error, np.sqrt(np.diag(g) * s2), rtol=1e-8)
    mean = (w * y).sum() / w.sum()
    assert fit.r_squared == pytest.approx(1 - (w * e * e).sum() / (w * (y - mean) ** 2).sum())
    assert (fit.n, fit.p, fit.rank, fit.df_residual) == (len(y), 6, 6, len(y) - 6)


def test_influence_against_leaving_each_row_out(sample):
    (d, contig, year, w, y), df = sample
    m = design(d, contig, year)
    fit = ols.fit_wls(df, "y", X, "w", "year")
    got = {r.i: r for r in ols.influence(df, fit).collect()}
    h, r, t, c = measures(m, y, w)
    b, g, _, s2 = wls(m, y, w)
    assert sum(v.hat for v in got.values()) == pytest.approx(6)
    for i in range(0, len(y), 7):
        assert got[i].hat == pytest.approx(h[i], rel=1e-7)
        assert got[i].std_resid == pytest.approx(r[i], rel=1e-7)
        keep = np.arange(len(y)) != i
        b1, g1, _, s1 = wls(m[keep], y[keep], w[keep])
        gap = y[i] - m[i] @ b1
        alone = gap / math.sqrt(s1 * (1 / w[i] + m[i] @ g1 @ m[i]))
        assert got[i].stud_resid == pytest.approx(alone, rel=1e-6)
        moved = m @ (b - b1)
        assert got[i].cooksd == pytest.approx((w * moved * moved).sum() / (6 * s2), rel=1e-6)


@pytest.mark.parametrize("two_sided", [False, True])
def test_trimming(sample, two_sided):
    (d, contig, year, w, y), df = sample
    m = design(d, contig, year)
    keep, used = np.ones(len(y), bool), []
    for _ in range(4):
        used.append(int(keep.sum()))
        n, p = used[-1], m.shape[1]
        h, r, t, c = measures(m[keep], y[keep], w[keep])
        size = np.abs if two_sided else np.asarray
        last = (size(r) < 2) & (c < 4 / (n - p - 1)) & (h < 2 * p / n)
        final = wls(m[keep], y[keep], w[keep])[0]
        keep[np.flatnonzero(keep)] = (size(t) < 2) & (c < 4 / (n - p - 1)) & (h < 2 * p / n)
    fit, got, rows = ols.fit_trimmed(df, "y", X, "w", "year", two_sided=two_sided)
    assert got == used and used[0] > used[1]
    np.testing.assert_allclose(fit.estimate, final, rtol=1e-6)
    assert ols.count_outliers(rows, fit, two_sided).first()["outliers"] == int((~last).sum())


def test_duplicate_and_constant_columns_get_no_estimate(spark, sample):
    _, df = sample
    doubled = df.selectExpr("*", "2 * log_dist + 1 as again", "5.0 as constant")
    fit = ols.fit_wls(doubled, "y", ["log_dist", "again", "constant", "contig"], "w")
    assert fit.coefficient("again") is None and fit.coefficient("constant") is None
    assert (fit.p, fit.rank) == (5, 3)
    plain = ols.fit_wls(df, "y", ["log_dist", "contig"], "w")
    assert fit.coefficient("log_dist") == pytest.approx(plain.coefficient("log_dist"))
    a = {r.i: r.f for r in ols.predict(doubled, fit.model, "f").collect()}
    b = {r.i: r.f for r in ols.predict(df, plain.model, "f").collect()}
    assert a == pytest.approx(b)


def test_row_with_full_leverage(spark):
    """Diagnostics that are undefined are NULL; the row goes and counts as an outlier."""
    rows = [(i, float(i % 5), 1 if i == 7 else 0, 0.3 * (i % 5) + 0.01 * ((i * 7) % 11)) for i in range(40)]
    df = spark.createDataFrame(rows, "i int, x double, only int, y double")
    fit = ols.fit_wls(df, "y", ["x", "only"])
    one = ols.influence(df, fit).filter("i = 7").first()
    assert one.hat == pytest.approx(1.0)
    assert one.std_resid is None and one.stud_resid is None and one.cooksd is None
    assert ols.remove_outliers(df, fit).filter("i = 7").count() == 0
    refit = ols.fit_wls(ols.remove_outliers(df, fit), "y", ["x", "only"], centre=fit.centre)
    assert refit.coefficient("only") is None and (refit.p, refit.rank) == (3, 2)


def test_missing_rows_are_left_out_and_infinite_ones_refused(spark, sample):
    (d, contig, year, w, y), df = sample
    holes = df.selectExpr("case when i < 5 then null else log_dist end as log_dist", "y")
    assert ols.fit_wls(holes, "y", ["log_dist"]).n == len(y) - 5
    with pytest.raises(ValueError):
        ols.fit_wls(df.selectExpr("case when i = 1 then double('inf') else y end as y", "log_dist"), "y", ["log_dist"])


def test_prediction(spark, sample):
    (d, contig, year, w, y), df = sample
    fit = ols.fit_wls(df, "y", X, "w", "year")
    got = {r.i: r.f for r in ols.predict(df, fit.model, "f").collect()}
    want = design(d, contig, year) @ np.array(fit.estimate)
    np.testing.assert_allclose([got[i] for i in range(len(y))], want, rtol=1e-9)
    part = df.limit(1).selectExpr("cast(null as double) as log_dist", "log_dist_sq", "contig", "year")
    assert ols.predict(part, fit.model, "f").first().f is None
    unseen = df.limit(1).selectExpr("log_dist", "log_dist_sq", "contig", "1999 as year")
    with pytest.raises(Exception, match="not in the model"):
        ols.predict(unseen, fit.model, "f").collect()


def test_model_store(spark, sample, tmp_path):
    _, df = sample
    fit = ols.fit_wls(df, "y", X, "w", "year")
    ols.save_fit(spark, fit, str(tmp_path / "model"))
    back = ols.load_model(spark, str(tmp_path / "model"))
    assert back == fit.model and back.intercept == fit.intercept


def test_reset_of_least_squares(sample):
    (d, contig, year, w, y), df = sample
    fit = ols.fit_wls(df, "y", X, "w", "year")
    m = design(d, contig, year)
    for weight, v in ((None, np.ones_like(w)), ("w", w)):
        b, _, e, _ = wls(m, y, v)
        wide = np.column_stack([m, (m @ b) ** 2])
        e1 = wls(wide, y, v)[2]
        rss0, rss1 = (v * e * e).sum(), (v * e1 * e1).sum()
        stat = (rss0 - rss1) / (rss1 / (len(y) - 7))
        got = ols.reset_test(df, fit, weight)
        assert got["statistic"] == pytest.approx(stat, rel=1e-5)
        assert 0 < got["p_value"] < 1


def poisson(m, y, steps=60):
    b = np.zeros(m.shape[1])
    b[0] = math.log(y.mean())
    for _ in range(steps):
        mu = np.exp(m @ b)
        b = b + np.linalg.solve(m.T @ (m * mu[:, None]), m.T @ (y - mu))
    mu = np.exp(m @ b)
    scale = ((y - mu) ** 2 / mu).sum() / (len(y) - m.shape[1])
    return b, np.sqrt(np.diag(np.linalg.inv(m.T @ (m * mu[:, None]))) * scale), mu


def test_poisson(spark, sample):
    (d, contig, year, w, y), df = sample
    target, m = np.exp(y), design(d, contig, year)
    b, se, mu = poisson(m, target)
    fit = ppml.fit_ppml(df, "ey", X, "year")
    assert fit.terms == ["(Intercept)", *X, "year2001", "year2002"]
    np.testing.assert_allclose(fit.estimate, b, rtol=1e-5)
    np.testing.assert_allclose(fit.std_error, se, rtol=1e-5)
    assert fit.pseudo_r_squared == pytest.approx(np.corrcoef(target, mu)[0, 1] ** 2, rel=1e-7)

    index = m @ b
    wide = np.column_stack([m[:, 0], (index - index.mean()) ** 2, m[:, 1:]])
    b1, se1, _ = poisson(wide, target)
    test = ppml.reset_ppml(df, fit)
    assert test["statistic"] == pytest.approx(b1[1] / se1[1], rel=1e-4)

    out = analysis.coefficient_comparison(spark, ols.fit_wls(df, "y", X, "w", "year"), fit)
    assert out.count() == 12
    counts = analysis.negative_fits(df, fit.model, fit.model).first()
    assert counts["ols_negative_fitted"] == counts["ppml_negative_fitted"] == int((mu < 1).sum())


def test_poisson_that_does_not_converge_raises(spark, sample):
    _, df = sample
    with pytest.raises(ppml.NotConvergedError):
        ppml.fit_ppml(df, "ey", X, "year", max_steps=1)


def test_poisson_refuses_what_it_cannot_fit(spark):
    def frame_of(*ys):
        return spark.createDataFrame([(float(i), y) for i, y in enumerate(ys)], "x double, y double")

    for ys in ((0.0, 0.0, 0.0), (1.0, -1.0, 3.0), (1.0, math.inf, 2.0)):
        with pytest.raises(ValueError):
            ppml.fit_ppml(frame_of(*ys), "y", ["x"])
    twice = frame_of(1.0, 2.0, 3.0, 5.0).selectExpr("*", "2 * x as z")
    fit = ppml.fit_ppml(twice, "y", ["x", "z"])
    assert fit.estimate[2] is None and fit.p_value[2] is None


def test_poisson_store(spark, sample, tmp_path):
    _, df = sample
    fit = ppml.fit_ppml(df, "ey", X, "year")
    ppml.save_ppml(spark, fit, str(tmp_path / "ppml"))
    assert ppml.load_ppml(spark, str(tmp_path / "ppml")) == fit


def test_outliers_of_a_perfect_fit_raise(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(8)], "x double, y double")
    fit = ols.fit_wls(df, "y", ["x"])
    fit.rss = 0.0
    with pytest.raises(ValueError, match="perfect"):
        ols.remove_outliers(df, fit)


def test_too_many_levels_raise(spark, monkeypatch, sample):
    _, df = sample
    monkeypatch.setattr(ols, "MAX_LEVELS", 2)
    with pytest.raises(ValueError, match="more than 2 values"):
        ols.fit_wls(df, "y", X, "w", "year")


def test_tail_probabilities_for_many_rows():
    from mirrorflow.functions import distributions as D

    assert D.t_two_sided(2.0, 1e11) == pytest.approx(D.normal_two_sided(2.0), rel=1e-9)
    # the same on both sides of the change of method
    assert D.t_two_sided(2.5, 1e6 - 1) == pytest.approx(D.t_two_sided(2.5, 1e6 + 1), rel=1e-7)
    assert D.t_two_sided(2.0, 10) == pytest.approx(0.07338803, rel=1e-6)
    assert D.f_upper(3.0, 4, 2e6) == pytest.approx(0.0174, abs=2e-4)
