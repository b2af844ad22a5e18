import numpy as np
from pyspark.sql import functions as F

from tidewater.operators import clustering


def plain(v, c):
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    out = []
    for i in range(len(v)):
        own = c == c[i]
        b = [d[i, c == x].mean() for x in set(c.tolist()) - {c[i]}]
        a = d[i, own].sum() / (own.sum() - 1) if own.sum() > 1 else None
        out.append(0.0 if a is None or not b else (min(b) - a) / max(a, min(b)))
    return out


def test_assignments_share_each_distance(spark, monkeypatch):
    v = np.random.default_rng(2).standard_normal((90, 5)).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist(), i % 7) for i, x in enumerate(v)], "id long, v array<float>, label int")
    dealt, sums = [], clustering._distance_sums
    monkeypatch.setattr(clustering, "_distance_sums", lambda rows, n: dealt.append(rows.count()) or sums(rows, n))
    got = clustering.silhouettes_per_row(df, "id", "v", {k: F.pmod("label", F.lit(k)) for k in (3, 4, 5)}, "k", block_rows=20).collect()
    assert dealt == [90] and len(got) == 270
    for k in (3, 4, 5):
        want = plain(v.astype(float), np.arange(90) % 7 % k)
        np.testing.assert_allclose([r.silhouette for r in sorted(got, key=lambda r: r.key) if r.k == k], want, atol=1e-6)
    one = clustering.silhouette_per_row(df, "id", "v", "label", block_rows=20).collect()
    np.testing.assert_allclose([r.silhouette for r in sorted(one, key=lambda r: r.key)], plain(v.astype(float), np.arange(90) % 7), atol=1e-6)
