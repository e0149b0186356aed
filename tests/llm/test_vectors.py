"""Near-duplicate vectors against brute force."""

import numpy as np
import pytest

from millrace.llm import caps

SCHEMA = "vec_id long, embedding array<float>, label int, row int, dim string"


def brute(rows):
    ok = [r for r in rows if r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    links = {id(r): [] for r in rows}
    for a in range(len(ok)):
        for b in range(a + 1, len(ok)):
            x, y = np.array(ok[a][1], float), np.array(ok[b][1], float)
            if ok[a][2] == ok[b][2] and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                links[id(ok[a])].append(ok[b])
                links[id(ok[b])].append(ok[a])
    out = []
    for r in rows:
        seen, todo = {id(r): r}, [r]
        while todo:
            for s in links[id(todo.pop())]:
                if id(s) not in seen:
                    seen[id(s)] = s
                    todo.append(s)
        out.append((r[0], len(links[id(r)]), min((s[0] for s in seen.values() if s[0] is not None), default=None)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [512, 7])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(caps, "BLOCK", block)
    rng = np.random.default_rng(4)
    rows = []
    for i in range(160):
        near = rows[int(rng.integers(0, len(rows)))][1] if i % 3 and rows else rng.standard_normal(24)
        v = np.array(near) + rng.standard_normal(24) * 0.12 * (i % 3 == 2)
        rows.append((1000 - i, [float(np.float32(x)) for x in v], i % 2, i, "x"))
    rows += [(5, None, 1, 0, ""), (6, [], 1, 0, ""), (7, [0.0, 0.0], 1, 0, ""), (8, [1.0, None], 1, 0, ""), (9, [1.0, float("nan")], 1, 0, ""),
             (10, [float("inf"), 1.0], 1, 0, ""), (11, [1.0, 2.0], None, 0, ""), (None, [1.0, 2.0], 1, 0, ""), (12, [2.0, 4.0], 1, 0, ""),
             (12, [2.0, 4.0], 1, 0, ""), (13, [3.0], 1, 0, ""), (14, [1.0], 1, 0, "")]
    out = caps.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    found = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out), key=str)
    assert found == brute(rows)
    assert caps.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_recall_of_filters():
    """Share of pairs just at the threshold that meet in a filter."""
    rng = np.random.default_rng(6)
    codes = caps.Codes(64, 50)
    x = caps._units(rng.standard_normal((400, 64)))
    codes.set_heights(x[:200])
    side = rng.standard_normal((400, 64))
    side -= (side * x).sum(axis=1, keepdims=True) * x
    y = 0.98 * x + np.sqrt(1 - 0.98 ** 2) * caps._units(side)
    met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(codes.entered(x), codes.entered(y))]
    assert np.mean(met) >= 0.99


def test_many_words_take_bounded_memory():
    """A batch of vectors is scored some at a time: sixteen million filters add little memory, and change no filter."""
    import tracemalloc

    rng = np.random.default_rng(2)
    codes = caps.Codes(32, 4000)
    x = caps._units(rng.standard_normal((600, 32)))
    codes.set_heights(x[:4])
    tracemalloc.start()
    found = codes.entered(x)
    assert tracemalloc.get_traced_memory()[1] < 60 << 20
    tracemalloc.stop()
    assert all((a == b).all() for a, b in zip(found[::50], (codes.entered(x[i:i + 1])[0] for i in range(0, 600, 50))))
    assert found[0].dtype == np.int32 and caps.Codes(2, 30000).kind == np.int64


def test_doubles_link_like_singles(spark):
    rows = [(i, [float(np.float32(v)) for v in np.random.default_rng(i // 3).standard_normal(8)], 1, 0, "") for i in range(12)]
    single = caps.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    double = caps.near_vectors(spark.createDataFrame(rows, SCHEMA.replace("array<float>", "array<double>"))).collect()
    assert sorted(map(tuple, single)) == sorted(map(tuple, double)) and {r["n_links"] for r in single} == {2}
    wide = spark.createDataFrame([(1, [1e200, 1e200], 1), (2, [2e200, 2e200], 1)], "vec_id long, embedding array<double>, label int")
    assert {r["n_links"] for r in caps.near_vectors(wide).collect()} == {1}


@pytest.mark.parametrize("kind", ["even", "cone", "flat", "two", "one"])
def test_no_pair_at_the_threshold_is_lost(kind):
    """Pairs at the threshold share a filter, however the vectors lie: all over, most in a cone, in a subspace, in two dimensions or one."""
    rng = np.random.default_rng(0)
    dim = {"two": 2, "one": 1}.get(kind, 64)
    x = rng.standard_normal((2000, dim))
    if kind == "cone":
        x[:1900] = caps._units(rng.standard_normal((1, dim))) + 0.05 * rng.standard_normal((1900, dim))
    if kind == "flat":
        x = rng.standard_normal((2000, 6)) @ rng.standard_normal((6, dim))
    x = caps._units(x)
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    y = x if dim == 1 else 0.98 * x + np.sqrt(1 - 0.98 ** 2) * caps._units(side)
    codes = caps.Codes(dim, 16 if dim == 1 else 60)
    codes.set_heights(np.concatenate([x, y])[::8])
    for codes.code in range(caps.CODES):
        assert all(len(np.intersect1d(a, b)) for a, b in zip(codes.entered(x), codes.entered(y)))
