import numpy as np
import pytest

from calipers.llm import embedding_whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n int, component string"


def symmetric(values, seed=0):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0].astype(np.longdouble)
    q = W._orthonormal(q)
    a = (q * np.array(values, dtype=np.longdouble)) @ q.T
    return (a + a.T) / 2, q


@pytest.mark.parametrize(
    "values",
    [
        [5, 5, 5, 1, 0.5, 0.5, 1e-3], [4, 4 - 1e-9, 4 - 2e-9, 3, 3 - 1e-12, 1, 0, 0], [1.0] * 6, list(np.linspace(2, 1, 40)),
        [1, 1e-4, 1e-8, 1e-12], [7.0], [0.0, 0.0], [1e12, 1e12 - 1, 3, 2],
    ],
)
def test_refined_eigenvectors(values):
    a, q = symmetric(values)
    found, x = W.refined(a)
    scale = max(values) or 1
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17
    assert np.abs(a @ x - x * found).max() < 1e-17 * scale
    assert (np.diff(found) <= 0).all() and np.abs(found - np.sort(values)[::-1]).max() < 1e-17 * scale
    order = np.argsort(-np.array(values), kind="stable")
    for i, k in enumerate(order):  # vectors are determined as well as their gap allows
        gap = min((abs(values[k] - v) for j, v in enumerate(values) if j != k), default=1)
        if gap / scale > 1e-3:
            assert np.abs(np.abs(x[:, i]) - np.abs(q[:, k])).max() < 1e-16


def test_better_than_float32_and_float64():
    a, q = symmetric(list(np.linspace(2, 1, 40)))
    off = lambda x: float(np.abs(np.abs(x) - np.abs(q)).max())
    single, double = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1], np.linalg.eigh(a.astype(np.float64))[1][:, ::-1]
    assert off(W.refined(a)[1]) < off(double) < off(single)


def brute(rows, components=4):
    """{(vec_id, component): ...} in plain numpy over the rows that stay."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(256 * np.array([v for _, v in kept], dtype=np.float32).astype(np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    v = np.cov((fit - s / n).T, bias=True)
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    w = (x - s / n) @ q[:, :components] / np.sqrt(e[:components])
    return n, [(i, int(d)) for (i, _), d in zip(kept, ((n * x - s) ** 2).sum(axis=1))], w, e[:components] / e.sum()


def data(seed=3, n=300, d=7):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, d)) @ np.diag([3, 2.5, 2, 1.5, 1, 0.5, 0.2][:d]) + 5
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(m)]
    common = rows[0][1]
    rows += [(n + i, common) for i in range(2 * n)]  # one vector in most rows
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, "c") for i, v in rows], SCHEMA)


def test_brute_force_with_rows_that_go(spark):
    rows = data()
    odd = [(5000, None), (5001, []), (5002, [None] * 7), (5003, [float("nan")] * 7), (5004, [float("inf")] + [0.0] * 6), (None, rows[3][1]), (7, rows[8][1])]
    short = [(5005, [1.0, 2.0])]
    n, ids, w, share = brute(rows + odd)
    for parts in (1, 9):
        out = W.whiten(frame(spark, rows + odd + short).repartition(parts)).collect()
        assert len(out) == 4 * len(ids)
        assert {r["n"] for r in out} == {n} and max(r["identity_error"] for r in out) < 1e-9
        got = sorted((r["vec_id"] is None, r["vec_id"], r["deviation"], r["component"]) for r in out)
        assert got == sorted((i is None, i, d, k) for i, d in ids for k in range(1, 5))
        for k in range(4):
            col = sorted((r["vec_id"] is None, r["vec_id"], r["deviation"], r["whitened"]) for r in out if r["component"] == k + 1)
            want = np.array([x[1] for x in sorted(((i is None, i, d), t) for (i, d), t in zip(ids, w[:, k].tolist()))])
            have = np.array([c[3] for c in col])
            sign = np.sign(have @ want)
            assert np.abs(have * sign - want).max() < 1e-9
            assert all(abs(r["explained"] - share[k]) < 1e-12 for r in out if r["component"] == k + 1)


def test_layout_does_not_matter(spark):
    rows = data(5)
    key = lambda r: (r["vec_id"], r["component"])
    one, many = (sorted(W.whiten(frame(spark, rows).repartition(p)).collect(), key=key) for p in (1, 8))
    assert [r["deviation"] for r in one] == [r["deviation"] for r in many]
    assert max(abs(a["whitened"] - b["whitened"]) for a, b in zip(one, many)) < 1e-12


def test_too_few_vectors(spark):
    assert W.whiten(frame(spark, [])).count() == 0
    assert W.whiten(frame(spark, [(1, None)])).count() == 0
    alone = W.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).orderBy("vec_id", "component").collect()
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in alone] == [
        (i, k, 1, 0, None, None, 0.0) for i in (1, 2) for k in (1, 2)
    ]
    pair = W.whiten(frame(spark, [(1, [0.0, 0.0, 0.0]), (2, [1.0, 1.0, 0.0])])).orderBy("vec_id", "component").collect()
    assert [r["whitened"] is None for r in pair] == [False, True, True] * 2 and abs(abs(pair[0]["whitened"]) - 1) < 1e-12
    assert pair[0]["explained"] == pytest.approx(1) and pair[0]["deviation"] == 2 * 256**2


def test_huge_entries(spark):
    """Sums and products stay exact where doubles would not; a deviation beyond a long is null."""
    rows = [(i, [1e15 + i * 2.0**30, float(i % 3), -3e38 if i == 5 else 1.0]) for i in range(6)]
    out = W.whiten(frame(spark, rows)).collect()
    assert len(out) == 18 and all(r["deviation"] is None for r in out)
    assert max(r["identity_error"] for r in out) < 1e-4
