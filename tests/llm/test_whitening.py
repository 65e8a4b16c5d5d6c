import math

import numpy as np
import pytest

from harborline.llm import whitening


def brute(rows, most=4):
    """{(id, component): (n, deviation, whitened up to its sign, explained)} by NumPy's own eigenvectors."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, s = len(fit), [sum(c) for c in zip(*{tuple(x) for _, x in kept}, strict=True)]
    y = fit - fit.mean(0)
    cov = y.T @ y / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:most], q[:, ::-1][:, :most]
    out = {}
    for i, x in kept:
        dev = sum((n * c - t) ** 2 for c, t in zip(x, s, strict=True))
        for k in range(len(e)):
            out[i, k + 1] = (n, dev, (np.array(x) - fit.mean(0)) @ q[:, k] / e[k] ** 0.5, e[k] / np.trace(cov))
    return out


def check(got, want):
    assert {(r.vec_id, r.component) for r in got} == set(want) and len(got) == len(want)
    signs = {}
    for r in got:
        n, dev, z, share = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, dev) and abs(r.explained - share) < 1e-9 and r.identity_error < 1e-9
        if abs(z) > 1e-3:
            signs.setdefault(r.component, np.sign(z * r.whitened))
        assert abs(r.whitened * signs.get(r.component, 1) - z) < 1e-6


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(whitening.op12_whitening(spark, sf).collect(), brute(rows))


def test_odd_rows(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rnd.normal(size=3) * (3, 2, 1)]) for i in range(80)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, None), (103, [1.0, None, 2.0]), (104, [1.0, float("nan"), 2.0]), (105, [1.0, float("-inf"), 2.0]), (106, [500.0, -500.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    check(whitening.whiten(df).collect(), brute(rows))
    other = df.selectExpr("vec_id", "embedding", "'y' AS n").union(spark.createDataFrame([(200, [1.0], ""), (201, [], "")], "vec_id long, embedding array<double>, n string"))
    check(whitening.whiten(other).collect(), brute(rows))  # other lengths are left out
    twice = whitening.whiten(df.union(df.where("vec_id = 3")).union(df.where("vec_id = 4").selectExpr("NULL", "embedding"))).collect()
    assert sum(r.vec_id == 3 for r in twice) == 6 and sum(r.vec_id is None for r in twice) == 3 and {r.n for r in twice} == {81}


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, []), (2, [])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).collect() == []
    line = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [3.0, 6.0])], schema)).collect()
    assert [r.component for r in line] == [1, 1, 1] and all(abs(r.explained - 1) < 1e-12 for r in line)


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2**22 - i), float(-(2**21) + 7 * i * i)]) for i in range(50)]
    check(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), brute(rows))
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: r.deviation for r in huge}[1] is None and {r.vec_id: r.deviation for r in huge}[3] is not None


@pytest.mark.parametrize("values", [(9, 4, 1, 0.5, 0.1), (5, 5, 5, 1, 1), (3, 3 - 1e-13, 2, 2 - 1e-9, 1), (1e6, 1, 1e-3, 0, 0), (2, 2, 0, 0, 0), (7,)])
def test_counts_and_components(values):
    rnd = np.random.default_rng(7)
    q, _ = np.linalg.qr(rnd.normal(size=(len(values), len(values))))
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    for shift in (-1.0, 0.3, 2.5, 4.5, 8.0):
        assert whitening.eigenvalues_above(v, shift) == sum(x > shift for x in values)
    found = whitening.leading_components(v)
    real = [x for x in values if x > 1e-12 * max(values)][:4]
    assert np.allclose([e for e, _ in found], real, rtol=1e-9, atol=1e-14 * max(values))
    vectors = np.stack([x for _, x in found])
    assert np.allclose(vectors @ vectors.T, np.eye(len(found)), atol=1e-12)
    assert np.abs(v @ vectors.T - vectors.T * [e for e, _ in found]).max() < 1e-10 * max(values)
