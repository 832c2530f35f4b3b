import numpy as np
import pytest
from test_model import data, frame, wls

from mirrorflow.operators import absorb, ols
from mirrorflow.operators.formula import Formula, design, fit_formula, parse, update


@pytest.fixture(scope="module")
def sample(spark):
    cols = data()
    return cols, frame(spark, *cols)


def test_terms_of_a_formula():
    f = parse("y ~ a:b + a*c - c + factor(year) + a | e1 + e2")
    assert f == Formula("y", (("a",), ("factor(year)",), ("a", "b"), ("a", "c")), ("e1", "e2"))
    assert parse("y ~ 1") == Formula("y", ())
    assert parse("y ~ b:a + a:b").terms == (("b", "a"),)


def test_update_keeps_what_a_dot_stands_for():
    f = parse("y ~ a + b + a:b | e")
    assert update(f, "~ predict2 + .") == Formula("y", (("predict2",), ("a",), ("b",), ("a", "b")), ("e",))
    assert update(f, "z ~ . - a:b | . + g") == Formula("z", (("a",), ("b",)), ("e", "g"))


@pytest.mark.parametrize("text", ["a + b", "~ a", "y ~ a + log(b)", "y ~ . + a", "y ~ a +", "y ~ a - + b", "y ~ a b"])
def test_what_is_no_formula_raises(text):
    with pytest.raises(ValueError):
        parse(text)


def test_formula_of_the_group_model_is_the_group_model(sample):
    _, df = sample
    a = fit_formula(df, "y ~ log_dist + log_dist_sq + contig + factor(year)", "w")
    b = ols.fit_wls(df, "y", ["log_dist", "log_dist_sq", "contig"], "w", "year")
    assert a.terms == b.terms
    assert np.allclose(a.estimate, b.estimate) and np.allclose(a.std_error, b.std_error)


def test_interaction_of_a_factor_with_a_regressor(sample):
    (d, contig, year, w, y), df = sample
    fit = fit_formula(df, "y ~ log_dist * factor(year)", "w")
    m = np.column_stack([np.ones_like(d), d, d * (year == 2001), d * (year == 2002), year == 2001, year == 2002])
    b, g, _, s2 = wls(m.astype(float), y, w)
    assert fit.terms == ["(Intercept)", "log_dist", "log_dist:year2001", "log_dist:year2002", "year2001", "year2002"]
    assert np.allclose(fit.estimate, b) and np.allclose(fit.std_error, np.sqrt(np.diag(g) * s2))


def test_interaction_without_its_margin_has_every_level(sample):
    (d, contig, year, w, y), df = sample
    fit = fit_formula(df, "y ~ log_dist:factor(year)", "w")
    m = np.column_stack([np.ones_like(d), *[d * (year == t) for t in (2000, 2001, 2002)]])
    b, g, _, s2 = wls(m.astype(float), y, w)
    assert fit.terms[1:] == ["log_dist:year2000", "log_dist:year2001", "log_dist:year2002"]
    assert np.allclose(fit.estimate, b) and np.allclose(fit.std_error, np.sqrt(np.diag(g) * s2))


def test_effects_after_the_bar_are_absorbed(sample):
    _, df = sample
    a = fit_formula(df, "y ~ log_dist * contig | year", "w")
    b = fit_formula(df, "y ~ log_dist * contig + factor(year)", "w")
    assert isinstance(a, absorb.AbsorbedFit)
    assert np.allclose(a.estimate, [b.coefficient(x) for x in a.x], atol=1e-7)


def test_poisson_formula(sample):
    _, df = sample
    fit = fit_formula(df, parse("ey ~ factor(year)"), poisson=True)
    means = {r["year"]: r["m"] for r in df.groupBy("year").agg({"ey": "avg"}).toDF("year", "m").collect()}
    assert np.allclose(fit.estimate, [np.log(means[2000]), np.log(means[2001] / means[2000]), np.log(means[2002] / means[2000])])


def test_rows_that_lack_a_part_are_left_out(spark):
    rows = [(1.0, 2.0, "a"), (2.0, None, "a"), (3.0, 1.0, None), (4.0, 5.0, "b"), (None, 1.0, "c")]
    made = design(spark.createDataFrame(rows, "y double, x double, f string"), parse("y ~ x:f"))
    assert made.x == ["x:fa", "x:fb"] and made.group is None
    assert sorted(map(tuple, made.rows.collect())) == [(1.0, 2.0, 0.0), (4.0, 0.0, 5.0)]


def test_unknown_columns_and_clashing_terms_raise(sample):
    _, df = sample
    with pytest.raises(ValueError, match="not in the table: nowhere"):
        design(df, parse("y ~ nowhere"))
    with pytest.raises(ValueError, match="another part"):
        design(df, parse("y ~ w"), "w")
