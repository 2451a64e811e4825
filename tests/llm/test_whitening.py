import math

import numpy as np
import pytest

from clickwell.llm import whitening
from clickwell.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=16):
    ids, x = [], []
    for i, v in rows:
        if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v):
            ids.append(i)
            x.append([math.floor(64 * float(c)) + 1_000_000 for c in v])
    x = np.array(x)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    z = (n * fit - s) / n
    e, q = np.linalg.eigh(z.T @ z / n)
    e, q = e[::-1], q[:, ::-1]
    return ids, n, ((n * x - s) ** 2).sum(axis=1), (n * x - s) / n @ q[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def check(rows, got, k=16):
    ids, n, deviations, white, explained = brute(rows, k)
    assert len(got) == len(ids) * white.shape[1] and {r.n for r in got} == {n}
    at = {}
    for r in got:
        at.setdefault((r.vec_id, r.component), r)
    w = np.array([[at[i, c + 1].whitened for c in range(white.shape[1])] for i in ids])
    assert np.abs(w * np.sign((w * white).sum(axis=0)) - white).max() < 1e-9
    assert [at[i, 1].deviation for i in ids] == deviations.tolist()
    assert np.allclose([at[ids[0], c + 1].explained for c in range(white.shape[1])], explained, rtol=1e-10)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(rows, QUERIES["op11_whitening"](spark, sf).collect())


@pytest.mark.parametrize("kind", ["plain", "graded", "equal", "clusters", "deficient", "identity"])
def test_solver(kind):
    rng, d = np.random.default_rng(3), 48
    m = rng.normal(size=(3 * d, d))
    if kind == "graded":
        m *= np.logspace(0, -8, d)
    if kind in ("equal", "clusters"):
        m = np.linalg.qr(m)[0] * np.repeat([4, 4, 4, 4] if kind == "equal" else [5, 3, 3, 1], d // 4)
    if kind == "deficient":
        m[:, d // 2:] = m[:, :d // 2]
    if kind == "identity":
        m = np.eye(d)
    values, v, total = whitening.solve(np.linalg.qr(m, mode="r"), 16)
    want = np.sort(np.linalg.svd(m, compute_uv=False) ** 2)[::-1][:16]
    assert np.allclose(values, want, rtol=1e-12) and total == pytest.approx((m * m).sum())
    assert np.abs(v.T @ v - np.eye(16)).max() < 1e-11
    assert (np.linalg.norm(m.T @ (m @ v) - v * values, axis=0) / values).max() < 1e-11


def test_dqds_finds_all_values():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 17, 60):
        a, b = rng.normal(size=d), rng.normal(size=d - 1)
        got = sorted(whitening.dqds(a, b))
        want = sorted(np.linalg.svd(np.diag(a) + np.diag(b, 1), compute_uv=False) ** 2)
        assert np.allclose(got, want, rtol=1e-10)


def test_defined_cases(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=3)], i) for i in range(20)]
    odd = [(None, rows[0][1], 1), rows[0], rows[1], (31, None, 1), (32, [1.0, None, 2.0], 1), (33, [1.0, math.nan, 0.0], 1),
           (34, [math.inf, 0.0, 0.0], 1), (35, [], 1), (36, [1.0, 2.0], 1), (37, [3e38, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows + odd, SCHEMA).withColumnRenamed("label", "component")
    got = whitening.components(df, k=16).collect()
    check([(r[0], r[1]) for r in rows], [r for r in got if r.vec_id is not None and r.vec_id < 20][:0] or
          list({(r.vec_id, r.component): r for r in got if r.vec_id is not None}.values()))
    assert len(got) == 23 * 3 and {r.component for r in got} == {1, 2, 3}
    assert sum(r.vec_id is None for r in got) == 3
    assert whitening.components(spark.createDataFrame([], SCHEMA)).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], SCHEMA)
    assert whitening.components(same).count() == 0           # one distinct row has no variance
    flat = spark.createDataFrame([(i, [float(i), 5.0], 0) for i in range(4)], SCHEMA)
    assert {r.component for r in whitening.components(flat).collect()} == {1}
