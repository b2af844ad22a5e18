"""LDA topics where the vocabulary doesn't lie on the driver."""
import random

import numpy as np

from tidewater.operators import scoring, topics


def planted(n=400, words=30):
    rng = random.Random(2)
    pools = [[f"{t}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(words)] for t in "xyz"]
    return [(" ".join(rng.choice(pools[i % 3]) for _ in range(40)),) for i in range(n)] + [("",), (None,)]


def test_planted_topics_are_found_without_a_vocabulary_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(scoring, "DRIVER_NUMBERS", 10)
    monkeypatch.setattr(scoring.CountVectorizer, "fit", None)
    got = scoring.lda_topics(spark.createDataFrame(planted(), "t string").coalesce(2), "t", k=3, words=6, max_iter=5)
    assert [(c, t) for c, t in got.dtypes] == [("topic", "int"), ("rank", "int"), ("term", "string")]
    rows = got.collect()
    assert [(r.topic, r["rank"]) for r in rows] == [(t, n) for t in range(3) for n in range(6)]
    pools = ["".join(r.term[0] for r in rows if r.topic == t) for t in range(3)]
    assert sorted(max(map(p.count, "xyz")) >= 5 for p in pools) == [True] * 3 and len({max("xyz", key=p.count) for p in pools}) == 3


def test_step_on_documents_equals_a_loop():
    rng = np.random.default_rng(0)
    beta, alpha = rng.uniform(0.01, 1, (7, 3)), np.full(3, 1 / 3)
    starts, words, counts = np.array([0, 3, 4]), np.array([0, 2, 5, 1, 3, 5, 6]), np.array([1.0, 2, 1, 4, 1, 1, 3])
    gamma = rng.uniform(0.5, 1.5, (3, 3))
    got, learnt = topics.fit_documents(beta, gamma, alpha, starts, words, counts)
    want = np.zeros_like(beta)
    theta = lambda g: np.exp(topics.digamma(g) - topics.digamma(g.sum()))
    for d, (a, b) in enumerate(zip(starts, [*starts[1:], len(words)])):
        g, w, n = gamma[d], words[a:b], counts[a:b]
        while True:
            e = theta(g)
            new = e * (beta[w] * (n / (beta[w] @ e))[:, None]).sum(axis=0) + alpha
            done, g = np.abs(new - g).mean() <= 1e-3, new
            if done:
                break
        np.testing.assert_allclose(got[d], g, rtol=1e-9)
        want[w] += theta(g) * (n / (beta[w] @ theta(g)))[:, None]
    np.testing.assert_allclose(learnt, want * beta, rtol=1e-9)


def test_special_functions():
    assert abs(topics.digamma(1.0) + 0.5772156649015329) < 1e-10 and abs(topics.trigamma(1.0) - np.pi ** 2 / 6) < 1e-9
    x = topics._random_gamma(np.arange(20_000), 2, 5)
    assert abs(x.mean() - 1) < 0.01 and abs(x.std() - 0.1) < 0.01
