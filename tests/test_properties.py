"""Property checks from SURVEY §5: partition independence, no kept pair is similar, Kneedle against
a plain-Python statement of the algorithm, matrix rows sum to 100."""


import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import clustering, dedup, report, similarity


def py_knee(xs, ys, S=1.0):
    """Offline Kneedle for a convex decreasing curve (first knee), straight from the paper's steps."""
    x = np.asarray(xs, float)
    y = np.asarray(ys, float)
    xn = (x - x.min()) / (x.max() - x.min())
    yn = (y - y.min()) / (y.max() - y.min())
    yd = (yn.max() - yn) - xn
    n = len(x)
    prev = np.r_[yd[0], yd[:-1]]
    nxt = np.r_[yd[1:], yd[-1]]
    is_max = (yd >= prev) & (yd >= nxt)
    is_min = (yd <= prev) & (yd <= nxt)
    maxima = np.nonzero(is_max)[0]
    if not len(maxima):
        return None
    tmx = yd - S * abs(np.diff(xn).mean())
    thr, tidx = None, None
    for i in range(maxima[0], n):
        if xn[i] == 1.0:
            break
        if is_max[i]:
            thr, tidx = tmx[i], i
        if is_min[i]:
            thr = 0.0
        if i + 1 < n and yd[i + 1] < thr:
            return x[tidx]
    return None


@pytest.mark.parametrize("seed", range(6))
def test_knee_matches_python(spark, seed):
    rng = np.random.default_rng(seed)
    ks = list(range(2, 12))
    ys = sorted((1000 / (k ** rng.uniform(0.5, 2.5)) + rng.uniform(0, 20) for k in ks), reverse=True)
    m = spark.createDataFrame([(k, float(y), 0.0) for k, y in zip(ks, ys)], "k long, inertia double, silhouette double")
    got = clustering.knee(m).first()["knee"]
    assert got == py_knee(ks, ys)


def test_dedup_partition_independent_and_independent_set(spark):
    rng = np.random.default_rng(11)
    base = rng.standard_normal((5, 4))
    vecs = np.vstack([base[i % 5] + 0.2 * rng.standard_normal(4) for i in range(80)])
    rows = [(i, [float(v) for v in vecs[i]]) for i in range(80)]
    a = spark.createDataFrame(rows, "id long, v array<double>").repartition(1)
    b = spark.createDataFrame(rows, "id long, v array<double>").repartition(7)
    ka = sorted(r["id"] for r in dedup.dedup_greedy(a, "id", "v", 0.85, "id").collect())
    kb = sorted(r["id"] for r in dedup.dedup_greedy(b, "id", "v", 0.85, "id", block_rows=9).collect())
    assert ka == kb
    u = vecs / np.linalg.norm(vecs, axis=1, keepdims=True)
    S = u @ u.T
    kept = set(ka)
    assert all(S[i, j] <= 0.85 for i in kept for j in kept if i < j)
    for j in range(80):
        if j not in kept:
            assert any(S[i, j] > 0.85 for i in kept if i < j)


def test_matrix_rows_sum_to_100(spark):
    rng = np.random.default_rng(3)
    rows = [(f"r{rng.integers(0, 6)}", str(rng.integers(1, 6))) for _ in range(997)]
    m = report.risk_severity_matrix(spark.createDataFrame(rows, "risk string, sev string"), "risk", "sev")
    cols = [c for c in m.columns if c != "risk"]
    for r in m.collect():
        assert abs(sum(r[c] for c in cols) - 100.0) <= 0.05 * len(cols) + 1e-9


def test_lsh_pairs_subset_of_exact(spark):
    rng = np.random.default_rng(5)
    vecs = rng.standard_normal((120, 16))
    vecs[60:90] = vecs[0] + 0.1 * rng.standard_normal((30, 16))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, v array<double>")
    exact = {(r["i_key"], r["j_key"]) for r in similarity.cosine_pairs(df, "id", "v", 0.9).collect()}
    lsh = {(r["i_key"], r["j_key"]) for r in
           similarity.cosine_pairs(df, "id", "v", 0.9, method="lsh", block_rows=8).collect()}
    assert lsh <= exact
    assert len(lsh) >= 0.95 * len(exact)


@pytest.mark.parametrize("small_group", [0, 64])
def test_block_verify_paths_agree(spark, small_group):
    """Hot buckets (block path) and ordinary buckets (self-join path) give the same pairs."""
    rng = np.random.default_rng(9)
    base = rng.integers(0, 50, size=(3, 16))
    rows = []
    for i in range(40):
        sig = base[i % 3].copy()
        sig[rng.integers(0, 16, size=2)] = rng.integers(50, 99, size=2)
        rows.append((i, i, [int(x) for x in sig], int(i % 2)))
    g = spark.createDataFrame(rows, "key long, ord long, u array<long>, g long")
    got = {(r["i_key"], r["j_key"]) for r in
           similarity.block_verify(g, 0.8, 5, kind="minhash", small_group=small_group).collect()}
    want = set()
    for a in rows:
        for b in rows:
            if a[0] < b[0] and a[3] == b[3] and np.mean(np.array(a[2]) == np.array(b[2])) >= 0.8:
                want.add((a[0], b[0]))
    assert got == want
