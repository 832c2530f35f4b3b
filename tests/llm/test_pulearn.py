"""Positive-unlabelled learning: risk and prior against plain numpy, held-out accuracy on the given tables."""

import math
import random
import zlib

import numpy as np
import pytest
from helpers import awkward_documents, documents, prose

from mirrorflow.llm import pulearn
from mirrorflow.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def plain_risk(prior, x, p, u, w):
    """Value of the non-negative risk, written out row by row."""
    z = x @ w
    plus = prior * np.mean([math.log1p(math.exp(-v)) for v in z[p]])
    minus = np.mean([math.log1p(math.exp(v)) for v in z[u]]) - prior * np.mean([math.log1p(math.exp(v)) for v in z[p]])
    return plus + max(0.0, minus)


@pytest.mark.parametrize("prior", [0.3, 0.99])
def test_risk_and_gradient(spark, prior):
    """The sums formed by Spark give the value of the plain formula, and its slope."""
    rnd = random.Random(3)
    rows = [([rnd.random() for _ in range(pulearn.MEASURES)], i % 3 == 0, i % 4 != 1, True) for i in range(60)]
    df = spark.createDataFrame(rows, "measures array<double>, positive boolean, unlabelled boolean, half boolean")
    fit = pulearn._Fit(df.repartition(3), pulearn.Training())
    x = pulearn.design(np.array([r[0] for r in rows]), fit.mean, fit.deviation, 6.0)
    p, u = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    rng = np.random.default_rng(2)
    w = 0.1 * rng.standard_normal(fit.size)
    value, gradient, _ = pulearn.non_negative_risk(prior)(fit.losses(w))
    assert abs(value - plain_risk(prior, x, p, u, w)) < 1e-10
    for _ in range(5):
        d = rng.standard_normal(fit.size)
        slope = (plain_risk(prior, x, p, u, w + 1e-6 * d) - plain_risk(prior, x, p, u, w - 1e-6 * d)) / 2e-6
        assert abs(slope - gradient @ d) < 1e-6


@pytest.mark.parametrize("prior", [0.2, 0.6, 0.9])
def test_prior_of_a_known_mixture(prior):
    rng = np.random.default_rng(5)
    good, bad = rng.beta(8, 2, 20_000), rng.beta(2, 8, 20_000)
    mixed = np.concatenate([good[: int(20_000 * prior)], bad[: 20_000 - int(20_000 * prior)]])

    def binned(s):
        return np.bincount(np.minimum(((1 - s) * pulearn.BINS).astype(int), pulearn.BINS - 1), minlength=pulearn.BINS).astype(float)

    assert abs(pulearn.estimate_prior(binned(rng.beta(8, 2, 20_000)), binned(mixed), 0.1) - prior) < 0.06


def test_measures_of_awkward_texts():
    for row in awkward_documents():
        m = pulearn.measures_of(row[1])
        assert m.shape == (pulearn.MEASURES,) and np.isfinite(m).all()
    assert not pulearn.measures_of(None).any() and not pulearn.measures_of(" \n\x0b").any()
    assert np.isfinite(pulearn.measures_of("a" * 3_000_000)).all()
    assert np.isfinite(pulearn.measures_of("é | x\n" * 300_000)).all()


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_held_out_accuracy(spark, sf):
    out = {r.doc_id: r for r in QUERIES["op11_positive_unlabelled"](spark, f"/root/testdata/{sf}").collect()}
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out.values())
    held = [(out[r.doc_id].score, r.quality, out[r.doc_id].predicted) for r in labels if r.doc_id in out and out[r.doc_id].held_out]
    good, bad = [s for s, q, _ in held if q], [s for s, q, _ in held if not q]
    above = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert above > 0.96
    assert np.mean([q == p for _, q, p in held]) > (0.97 if sf == "sf0.1" else 0.9)


def test_held_out_labels_are_not_learnt(spark):
    """Turning the labels of held-out rows around changes no score."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - quality else quality end as quality")
    one, two = (sorted(map(tuple, pulearn.quality_scores(docs, x).collect())) for x in (labels, turned))
    assert [r[:2] for r in one] == [r[:2] for r in two]
    assert max(abs(a[2] - b[2]) for a, b in zip(one, two)) < 1e-9


def test_awkward_documents(spark):
    rows = awkward_documents()
    labels = [(r[0], int(i % 5 > 0), 0) for i, r in enumerate(rows)] + [(100, 0, 0), (None, 1, 0), (10**9, 1, 0), (8, None, None)]
    got = pulearn.quality_scores(documents(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert all(math.isfinite(r.score) and 0 <= r.score <= 1 for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)


def test_without_labels_or_rows(spark):
    rows = [(i, prose(i, 60), "en", "s", 1) for i in range(9)]
    for labels in ([], [(1, 0, 0)]):
        got = pulearn.quality_scores(documents(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
        assert [r.score for r in got] == [0.5] * 9
    assert pulearn.quality_scores(documents(spark, []), spark.createDataFrame([], LABELS)).collect() == []
