from collections import Counter
from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest

from tests.llm import cases
from tidemark.llm import whitening
from tidemark.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, vectors, kind="float"):
    rows = [(i, v, i % 3) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA.replace("float", kind)).repartition(3)


def vectors(n, d, seed=1, scale=0.3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * scale
    return base.astype(np.float32).tolist()


def brute(rows, d):
    """Whole numbers by plain Python, the covariance as fractions."""
    kept = [(i, [floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows]
    n = len(kept)
    s = [sum(x[j] for _, x in kept) for j in range(d)]
    cov = [
        [Fraction(sum((n * x[a] - s[a]) * (n * x[b] - s[b]) for _, x in kept), n**3) for b in range(d)]
        for a in range(d)
    ]
    deviation = {i: sum((n * x[j] - s[j]) ** 2 for j in range(d)) for i, x in kept}
    return kept, s, np.array(cov, dtype=float), deviation


def check(got, rows, d, components=32):
    kept, s, cov, deviation = brute(rows, d)
    n = len(kept)
    values = np.linalg.eigvalsh(cov)[::-1][:components]
    x = np.array([v for _, v in sorted(kept)], dtype=float)
    centred = x - np.array([a / n for a in s])
    out = {}
    for r in got:
        assert r.n == n and r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-9)
        assert 0 <= r.identity_error < 1e-9
        out[r.vec_id, r.component] = r.whitened
    k = max(c for _, c in out)
    assert len(out) == len(got) == n * k
    w = np.array([[out[i, c] for c in range(1, k + 1)] for i, _ in sorted(kept)])
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-8
    # Column c is the projection on an eigenvector with eigenvalue c.
    axes = np.linalg.lstsq(centred, w * np.sqrt(values[:k]), rcond=None)[0]
    assert np.allclose(cov @ axes, axes * values[:k], atol=1e-6 * values[0])
    return k


def test_against_exact_fractions(spark):
    data = vectors(300, 12)
    got = whiten(frame(spark, data)).collect()
    assert check(got, list(enumerate(data)), 12) == 12


def test_component_limit(spark):
    data = vectors(120, 40)
    got = whiten(frame(spark, data)).collect()
    assert check(got, list(enumerate(data)), 40) == 32


def test_chunks_do_not_matter(spark, monkeypatch):
    data = vectors(200, 5)
    x = np.floor(np.array(data, dtype=np.float64) * 64).astype(np.int64)
    sums = whitening._Sums([12] * 5)
    u = (x - x.min(axis=0)).astype(np.uint64)
    assert int(u.max()) < 1 << 12
    for part in (u[:7], u[7:100], u[100:]):
        sums.add(part)
    total = (sums.limbs * (1 << 32) ** np.arange(sums.limbs.shape[2], dtype=object)).sum(axis=2)
    v = u.astype(np.int64)
    upper = np.triu_indices(5)
    assert (total[:5, :5].astype(np.int64)[upper] == (v.T @ v)[upper]).all()
    assert total[:5, 5].astype(np.int64).tolist() == v.sum(axis=0).tolist() and int(total[5, 5]) == 200


def test_unusable_vectors(spark):
    good = vectors(50, 4)
    bad = [None, [], [1.0, None, 2.0, 3.0], [1.0, float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0], [1e30] * 4]
    df = frame(spark, good + bad)
    got = whiten(df).collect()
    check(got, list(enumerate(good)), 4)
    assert {r.vec_id for r in got} == set(range(50))


def test_wide_range_is_exact(spark):
    rng = np.random.default_rng(3)
    data = [[float(a) for a in v] for v in rng.normal(size=(40, 3)) * [1e12, 1.0, 1e-3]]
    assert all(isfinite(a) for v in data for a in v)
    got = whiten(frame(spark, data, "double")).collect()
    kept, s, cov, deviation = brute(list(enumerate(data)), 3)
    # The others are lost beside the first in double precision.
    assert {r.component for r in got} == {1}
    assert all(r.deviation is None for r in got if deviation[r.vec_id] >= 1 << 63)
    assert all(r.explained == pytest.approx(1.0) for r in got)


def test_constant_dependent_and_repeated(spark):
    data = [[v[0], v[0], 7.0, v[1]] for v in vectors(60, 2)]
    df = frame(spark, data)
    got = whiten(df).collect()
    assert {r.component for r in got} == {1, 2}
    check(got, list(enumerate(data)), 4)
    twice = whiten(df.union(df)).collect()
    assert Counter(r.vec_id for r in twice) == Counter({i: 4 for i in range(60)})
    assert whiten(frame(spark, [[1.0, 2.0]] * 5)).collect() == []
    assert whiten(frame(spark, [[1.0, 2.0]])).collect() == []


def test_empty_table_null_keys_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whiten(empty).collect() == []
    assert whiten(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []
    df = frame(spark, vectors(30, 3)).selectExpr("nullif(vec_id, 4) as vec_id", "embedding")
    plain, extra = whiten(df), whiten(cases.clashing(df))
    assert plain.columns == extra.columns
    key = lambda r: (r.vec_id is None, r.vec_id or 0, r.component)
    a, b = sorted(plain.collect(), key=key), sorted(extra.collect(), key=key)
    assert [(r.vec_id, r.component, r.deviation) for r in a] == [(r.vec_id, r.component, r.deviation) for r in b]
    assert sum(r.vec_id is None for r in a) == 3
