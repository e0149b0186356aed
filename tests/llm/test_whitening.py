"""Whitening against a plain eigendecomposition of exact integers."""

import math

import numpy as np
import pytest

from millrace.llm import whitening as wh
from millrace.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, component int, n string, x binary"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0, 1, "n", None) for i, v in vectors], SCHEMA)


def check(out, vectors, components=16):
    """Every column against whole Python integers and numpy's symmetric eigensolver."""
    ok = [(i, [float(np.float32(c)) for c in v]) for i, v in vectors if v is not None and None not in v and np.isfinite(np.array(v, np.float32)).all()]
    dim = max(len(v) for _, v in ok)
    x = {}
    for i, v in ok:
        x.setdefault(i, []).append(tuple(math.floor(64 * c) + 1000000 for c in v + [0.0] * (dim - len(v))))
    fitted = sorted({t for ts in x.values() for t in ts})
    n, sums = len(fitted), [sum(c) for c in zip(*fitted)]
    z = np.array([[float(n * c - s) / n for c, s in zip(t, sums)] for t in fitted])
    variance = z.T @ z / n
    values, units = np.linalg.eigh(variance)
    values, units = values[::-1], units[:, ::-1]
    k = min(components, int((values > 1e-9 * max(values[0], 1e-300)).sum()))
    assert len(out) == k * sum(map(len, x.values()))
    found = {}
    for r in out:
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(variance), rel=1e-9)
        found.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append((r["deviation"], r["whitened"]))
    w = units[:, :k] / np.sqrt(values[:k])
    signs = np.zeros(k)
    for i, ts in x.items():
        for c in range(1, k + 1):
            assert sorted(d for d, _ in found[i][c]) == sorted(sum((n * a - s) ** 2 for a, s in zip(t, sums)) for t in ts)
        if len(ts) == 1 and k and (np.diff(values[:k + 1]) < -1e-6 * values[0]).all():
            expected = np.array([float(n * c - s) / n for c, s in zip(ts[0], sums)]) @ w
            got = np.array([found[i][c][0][1] for c in range(1, k + 1)])
            np.testing.assert_allclose(np.abs(got), np.abs(expected), atol=1e-8)
            big = np.abs(expected) > 1e-6
            now = np.sign(got * expected) * big
            assert (now * signs >= 0).all()
            signs = np.where(signs == 0, now, signs)


@pytest.mark.parametrize("cells, fan_in", [(wh.CELLS, wh.FAN_IN), (40, 2)])
def test_random_vectors(spark, monkeypatch, cells, fan_in):
    monkeypatch.setattr(wh, "CELLS", cells)
    monkeypatch.setattr(wh, "FAN_IN", fan_in)
    rng = np.random.default_rng(1)
    base = rng.standard_normal((150, 20)) * np.linspace(0.1, 3, 20)
    vectors = [(i, v) for i, v in enumerate(base)] + [(200 + i, base[i]) for i in range(20)] + [(None, base[0]), (7, base[3])]
    vectors += [(300, None), (301, [1.0, None] * 10), (302, [float("nan")] * 20), (303, [float("inf")] + [0.0] * 19), (304, [1.5, -2.0]), (305, [])]
    check(wh.whiten(frame(spark, vectors).repartition(7)).collect(), vectors)


def test_low_rank_and_far_scales(spark):
    rng = np.random.default_rng(2)
    vectors = [(i, np.concatenate((rng.standard_normal(3) @ np.array([[1, 2, 0, 4.0], [0, 1, 1, 0], [2, 0, 0, 1]]) // 0.25, [5.0]))) for i in range(40)]
    out = wh.whiten(frame(spark, vectors)).collect()
    assert {r["component"] for r in out} <= {1, 2, 3, 4}
    check(out, vectors)
    far = [(i, [1e6 * rng.standard_normal(), rng.standard_normal(), 7.0]) for i in range(60)]
    out = wh.whiten(frame(spark, far)).collect()
    assert {r["component"] for r in out} == {1, 2} and max(r["identity_error"] for r in out) < 1e-6


def test_nothing_to_fit(spark):
    assert wh.whiten(frame(spark, [])).count() == 0
    assert wh.whiten(frame(spark, [(1, None), (2, [None])])).count() == 0
    assert wh.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0


def test_entries_beyond_bounds(spark):
    out = wh.whiten(frame(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 4.0])])).collect()
    assert len(out) == 6 and all(r["deviation"] is None for r in out if r["vec_id"] in (1, 2))


def test_exact_sums_of_large_entries():
    model = wh.Fit(3, [3 * (1 << 40) + 1, 5], np.empty((0, 2)), np.empty(0), 1.0)
    x = np.array([[1 << 40, 2], [(1 << 40) + 9, -4]])
    assert model.deviations(x) == [sum((3 * a - s) ** 2 for a, s in zip(r, model.sums)) for r in x.tolist()]


@pytest.mark.parametrize("n, rank", [(1, 1), (5, 5), (30, 30), (31, 12)])
def test_cholesky_and_jacobi(n, rank):
    rng = np.random.default_rng(n)
    a = rng.integers(-9, 10, (n, rank)).astype(float)
    a = a @ a.T
    g = wh.pivoted_cholesky(a)
    assert g.shape == (n, rank)
    np.testing.assert_allclose(g @ g.T, a, atol=1e-9 * np.trace(a))
    units, values = wh.one_sided_jacobi(g)
    np.testing.assert_allclose(units.T @ units, np.eye(rank), atol=1e-12)
    np.testing.assert_allclose(values, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-9)
    np.testing.assert_allclose(units * values @ units.T, a, atol=1e-9 * np.trace(a))


def test_whole_table(spark):
    import pandas as pd
    vectors = [(r.vec_id, list(r.embedding)) for r in pd.read_parquet("/root/testdata/sf0.001/embeddings.parquet").itertuples()]
    check(QUERIES["op13_whitening"](spark, "/root/testdata/sf0.001").collect(), vectors)
