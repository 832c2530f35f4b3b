"""Components and whitened vectors against a dense decomposition by numpy."""

import math

import numpy as np
import pytest

from mirrorflow.llm import whitening
from mirrorflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def found(spark, rows, components=16):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as x", "2 as component", "3 as n", "4 as v")
    return whitening.whitened(df.repartition(3), components=components).collect()


def plain(vectors, components):
    """n, sums, eigenvalues in falling order and components of the distinct vectors in whole steps."""
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    distinct = np.unique(x, axis=0)
    e, q = np.linalg.eigh(np.cov(distinct.T, bias=True).reshape(x.shape[1], -1))
    return x, distinct, e[::-1][:components], q[:, ::-1][:, :components], e.sum()


def check(rows, got, components=16):
    vectors = [r[1] for r in rows]
    x, distinct, e, q, trace = plain(vectors, components)
    kept = int((e > 1e-12 * e[0]).sum())
    assert len(got) == len(rows) * kept
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    want = (x - distinct.mean(0)) @ (q[:, :kept] / np.sqrt(e[:kept]))
    z = np.array([[by_id[r[0]][c + 1].whitened for c in range(kept)] for r in rows])
    sign = np.sign((z * want).sum(0))
    assert np.abs(z - want * sign).max() < 1e-8
    n, total = len(distinct), [int(v) for v in distinct.sum(0)]
    for r, own in zip(rows, x.tolist()):
        one = by_id[r[0]][1]
        assert int(one.deviation) == sum((n * a - s) ** 2 for a, s in zip(own, total)) and one.n == n
        assert abs(one.explained - e[0] / trace) < 1e-9 and one.identity_error < 1e-9


def test_against_dense_decomposition(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((300, 24)) * np.geomspace(3, 0.2, 24) + 0.5
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[7][1], 0) for i in range(200)]  # a hot group of copies
    check(rows, found(spark, rows))


def test_low_rank_and_repeated_eigenvalues(spark):
    """Fewer components than asked for, and eigenvalues that a single Krylov space would find once."""
    rows = [(2 * i + j, [float(s * 2 * (k == i)) for k in range(5)] + [1.0], 0) for i in range(5) for j, s in enumerate((1, -1))]
    x, distinct, e, _, trace = plain([r[1] for r in rows], 16)
    got = found(spark, rows)
    assert len(got) == 10 * 5 and max(r.identity_error for r in got) < 1e-9
    assert all(abs(r.explained - 0.2) < 1e-9 for r in got)
    line = [(i, [float(i), 2.0 * i, -1.0 * i, 0.25], 0) for i in range(9)]
    check(line, found(spark, line))


def test_awkward_vectors(spark):
    v = [0.5, 0.25, -1.0]
    rows = [
        (1, v, 0), (1, v, 0), (None, v, None), (2, None, 0), (3, [], 0), (4, [0.5, None, 1.0], 0), (5, [math.nan, 1.0, 1.0], 0),
        (6, [math.inf, 1.0, 1.0], 0), (7, [0.0, 0.0, 0.0], 0), (8, [-3.0, 2.0, 1.0], 0), (9, [1.0, 2.0], 0), (10, [100.0, -7.0, 3.0], 1),
    ]
    got = found(spark, rows)
    ids = [r.vec_id for r in got if r.component == 1]
    assert sorted(ids, key=str) == sorted([1, 1, None, 7, 8, 10], key=str)
    assert {r.n for r in got} == {4} and {r.component for r in got} == {1, 2, 3}


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)]])
def test_without_variance(spark, rows):
    assert found(spark, rows) == []


def test_deviations_beyond_64_bits():
    model = whitening.Whitening(10**9, np.array([3, 5]) * 10**15, np.eye(2), np.ones(2), 2.0, 0.0)
    x = np.array([[10**6, 10**7], [0, 1]])
    want = [str(sum((10**9 * a - s) ** 2 for a, s in zip(r, [3 * 10**15, 5 * 10**15]))) for r in x.tolist()]
    assert whitening._deviations(x, model) == want


def test_given_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding), 0) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect() if r.embedding]
    check(rows, QUERIES["op12_whitening"](spark, sf).collect())
