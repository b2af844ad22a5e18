"""Clusters to named categories, silhouette estimates, searches against word vectors, batch models, appends."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import clustering, dedup, discovery, scoring, upsert

TEXTS = [("a", 1, "Strike at the port, strike again"), ("b", 1, "port strike"), ("c", 1, None), ("d", 2, "Pirates board the ship; pirates flee"),
         ("e", 2, ""), ("f", 3, ""), ("g", None, "lost words"), ("h", 4, "port strike"), ("i", 4, "strike strike port again")]


def plain_terms(rows, n, stop, least):
    tf = {}
    for _, c, t in rows:
        if c is not None:
            words = "".join(x if x.isalpha() else " " for x in (t or "").lower()).split()
            tf.setdefault(c, Counter()).update(w for w in words if len(w) >= least and w not in stop)
    tf = {c: v for c, v in tf.items() if v}
    every = sum(tf.values(), Counter())
    mean = sum(every.values()) / max(1, len(tf))
    out = {}
    for c, v in tf.items():
        total = sum(v.values())
        out[c] = sorted(((-x / total * math.log(1 + mean / every[w]), w) for w, x in v.items()))[:n]
    return {c: [(w, -s) for s, w in v] for c, v in out.items()}


def test_cluster_terms_equal_brute_force(spark):
    df = spark.createDataFrame(TEXTS, "_id string, cluster int, t string")
    want = plain_terms(TEXTS, 3, {"the", "at"}, 3)
    got = {}
    for r in sorted(discovery.cluster_terms(df, "cluster", "t", 3, ["the", "at"]).collect(), key=lambda r: r.rank):
        got.setdefault(r.cluster, []).append((r.term, r.score))
    assert {c: [w for w, _ in v] for c, v in got.items()} == {c: [w for w, _ in v] for c, v in want.items()}
    assert all(abs(x - y) < 1e-12 for c in got for (_, x), (_, y) in zip(got[c], want[c]))
    assert discovery.cluster_terms(df.limit(0), "cluster", "t").count() == 0


def test_names_are_one_to_a_cluster(spark):
    df = spark.createDataFrame(TEXTS, "_id string, cluster int, t string")
    got = {r.cluster: r for r in discovery.named_clusters(df, "cluster", "t", "_id", 2, ["the", "at"]).collect()}
    assert got[1].category == "Strike, Port, Again" and got[1].size == 3 and got[1].sample_texts == ["Strike at the port, strike again", "port strike"]
    assert got[4].category == "Strike, Port, Again (2)"
    assert got[2].category.startswith("Pirates, ") and got[3].category == "Unnamed 3" and got[3].description == "Reports without words."
    assert set(got) == {1, 2, 3, 4}


def test_discovery_appends_updates_and_reports(spark):
    table = spark.createDataFrame([(i, "Others" if i != "h" else "Piracy") for i, _, _ in TEXTS] + [("z", "Delay"), (None, "Others")], "_id string, main_risk string")
    assign = spark.createDataFrame([(i, c) for i, c, _ in TEXTS if c in (1, 2, 3)], "_id string, cluster int")
    df = spark.createDataFrame([r for r in TEXTS if r[1] in (1, 2, 3)], "_id string, cluster int, t string")
    cats = discovery.named_clusters(df, "cluster", "t", "_id")
    seeds = upsert.seed_categories(spark)
    d = discovery.apply_categories(table, assign, cats, seeds)
    new = {r.cluster: r.category for r in cats.collect()}
    assert {(r["_id"], r["final_risk"]) for r in d.table.collect()} == \
        {(i, new.get(c, "Piracy" if i == "h" else "Others")) for i, c, _ in TEXTS} | {("z", "Delay"), (None, "Others")}
    rows = d.catalogue.collect()
    assert len(rows) == 13 + 3 and {r["_id"]: r.category for r in rows if r.origin == "discovered"} == {f"discovered-{c}": n for c, n in new.items()}
    assert sorted(r["_id"] for r in upsert.delete_discovered(d.catalogue).collect()) == sorted(str(i) for i in range(1, 14))
    assert d.modified.first()[0] == 6
    assert {r.category: r.number_of_incidents for r in d.analysis.collect()} == {new[1]: 3, new[2]: 2, new[3]: 1}


def test_append_keeps_the_table_and_adds_the_rows(spark):
    old = spark.createDataFrame([("1", None, 7)], "_id string, a string, n int")
    new = spark.createDataFrame([("1", None), ("2", "x")], "_id string, a string")
    got = sorted(tuple(r) for r in upsert.append_rows(old, new, ["_id", "a"]).select("_id", F.coalesce("a", F.lit("null")).alias("a"), F.coalesce("n", F.lit(-1)).alias("n")).collect())
    assert got == [("1", "", -1), ("1", "null", 7), ("2", "x", -1)]


def test_seed_categories_twice(spark):
    once = upsert.seed_categories(spark)
    own = once.unionByName(spark.createDataFrame([("discovered-0", "Own", "d", "discovered")], once.schema))
    twice = upsert.seed_categories(spark, upsert.seed_categories(spark, own))
    assert sorted(tuple(r) for r in twice.collect()) == sorted(tuple(r) for r in own.collect())


def vectors(spark, n, k, seed, dim=6):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(k, dim)) * 2
    cl = rng.integers(0, k, n)
    v = centre[cl] + rng.normal(size=(n, dim))
    return spark.createDataFrame([(i, [float(x) for x in v[i]], int(cl[i])) for i in range(n)], "id long, v array<double>, c int").repartition(5)


def test_silhouette_bound_holds(spark):
    df = vectors(spark, 1500, 4, 1)
    exact = clustering.silhouette_exact(df, "id", "v", "c")
    for seed in range(4):
        e = clustering.silhouette_estimate(df, "id", "v", "c", sample=200, seed=seed)
        assert (e.sampled, e.rows) == (200, 1500) and abs(e.mean - exact) <= e.margin and 0 < e.margin < 0.2
    whole = clustering.silhouette_estimate(df, "id", "v", "c", sample=1500)
    assert abs(whole.mean - exact) < 1e-6 and whole.margin == 0.0


def test_silhouette_of_odd_rows(spark):
    rows = [(1, [0.0], 0), (1, [0.0], 0), (2, [1.0], 1), (None, [1.0], 1), (3, [5.0], 2), (4, None, 0), (5, [3.0], None)]
    df = spark.createDataFrame(rows, "id long, v array<double>, c int")
    got = sorted(round(r.silhouette, 9) for r in clustering.silhouette_of_sample(df, "id", "v", "c").collect())
    assert got == [0.0, 1.0, 1.0, 1.0, 1.0]
    assert clustering.silhouette_estimate(df.limit(0), "id", "v", "c")[:2] == (0.0, 0.0)
    same = spark.createDataFrame([(i, [1.0], i % 2) for i in range(4)], "id long, v array<double>, c int")
    assert clustering.silhouette_estimate(same, "id", "v", "c").mean == 0.0


def test_sweep_estimates_by_default(spark):
    metrics, fits = clustering.k_sweep(vectors(spark, 300, 3, 2), "id", "v", range(2, 5), sample=100)
    rows = {r.k: r for r in metrics.collect()}
    assert rows[2].silhouette == 0.0 and rows[3].margin > 0
    exact = clustering.silhouette_exact(fits[3][1], "id", "v", "cluster")
    assert abs(rows[3].silhouette - exact) <= rows[3].margin
    with pytest.raises(ValueError):
        clustering.k_sweep(vectors(spark, 10, 2, 1), "id", "v", range(2, 3), silhouette="none")


@pytest.mark.parametrize("head", [1, 8, 1000])
@pytest.mark.parametrize("threshold", [0.95, 0.6])
def test_rows_against_words(spark, head, threshold):
    rng = np.random.default_rng(5)
    docs, words = rng.normal(size=(120, 4)), rng.normal(size=(90, 4))
    docs[3], words[7], docs[9] = 0, 0, 2 * words[11]
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    gone = (unit(docs) @ unit(words).T > threshold).any(axis=1)
    d = spark.createDataFrame([(None if i % 10 == 0 else i // 2, i, [float(x) for x in v]) for i, v in enumerate(docs)], "id long, n long, v array<double>")
    w = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(words)], "w long, u array<double>")
    got = dedup.dedup_against(d, "id", "v", w, "u", threshold, first=[F.col("w")], head=head, keep_flag=True)
    assert {r.n: r.is_unique for r in got.collect()} == {i: not g for i, g in enumerate(gone)}
    assert dedup.dedup_against(d, "id", "v", w.limit(0), "u", threshold).count() == 120
    assert dedup.dedup_against(d.limit(0), "id", "v", w, "u", threshold).count() == 0


def test_word2vec_against_words(spark):
    texts = ["ship ship ship", "port strike ends today in rotterdam", "", None, "cargo lost at sea near the coast of spain", "ship"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    kept = {r.id for r in scoring.dedup_word2vec(df, "id", "t", 0.99, against="words", vector_size=8, partitions=2).collect()}
    assert {2, 3} <= kept and not {0, 5} & kept  # a text of one word is that word's vector
    assert scoring.dedup_word2vec(df.where("id in (2, 3)"), "id", "t", against="words").count() == 2
    with pytest.raises(ValueError):
        scoring.dedup_word2vec(df, "id", "t", against="all")


def test_models_are_loaded_once_a_task_and_asked_in_batches(spark, tmp_path):
    log = str(tmp_path)

    def load():
        import os
        import uuid
        open(os.path.join(log, "load-" + uuid.uuid4().hex), "w").close()

        def model(prompts):
            open(os.path.join(log, f"call-{len(prompts)}-{uuid.uuid4().hex}"), "w").close()
            if "bad" in prompts:
                raise RuntimeError("quota")
            return [p.upper() for p in prompts]
        return model

    df = spark.createDataFrame([(i, "bad" if i == 5 else f"p{i}") for i in range(10)], "i int, p string").coalesce(1)
    got = {r.i: (r.answer, r.answer_error) for r in scoring.infer_batches(df, "p", load, "answer", batch_size=4).collect()}
    assert got == {i: ("Error occurred", "RuntimeError: quota") if i == 5 else (f"P{i}", None) for i in range(10)}
    names = [p.name for p in tmp_path.iterdir()]
    assert sum(n.startswith("load") for n in names) == 1
    assert sorted(n.split("-")[1] for n in names if n.startswith("call")) == ["1"] * 4 + ["2", "4", "4"]


def test_severity_is_written_back(spark):
    df = spark.createDataFrame([("a", "Catastrophic storm", "x", "y", True), ("b", "h", "m", "d", False), (None, "h", "m", "d", True)],
                               "_id string, headline string, main_risk string, description string, is_unique boolean")
    got = {r["_id"]: r.severity_level for r in scoring.write_severity(df).collect()}
    assert got["a"] is not None and got["b"] is None and got[None] is None and len(got) == 3
    with pytest.raises(ValueError):
        scoring.classify_severity(df, model="other")
    with pytest.raises(ValueError):
        scoring.classify_severity(df, model="generative")
