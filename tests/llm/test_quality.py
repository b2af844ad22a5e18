import random

from pyspark.sql import functions as F

from tidewater.llm import zstd_quality as q

WORDS = "the of and river stone window morning letter garden answer quiet table number always people little water".split()


def make(n, seed=3):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(30, 200))]
        good = i % 4 != 0
        docs.append((i, " ".join(words) if good else " | ".join(w.upper() + "!!" for w in words)))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_accuracy_and_edges(spark):
    docs, labels = make(400)
    docs += [(900, None), (901, ""), (902, "x" * 200_000), (None, "the river of stone and water"), (1, docs[1][1])]
    d = spark.createDataFrame([(i, t, "s", 0.5) for i, t in docs], "doc_id long, text string, held_out string, score double")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = q.quality_scores(d, lab)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    truth = {i: y for i, y, _ in labels}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert {r.held_out for r in rows if r.doc_id is None} == {True}


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = make(120)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    flipped = lab.withColumn("quality", F.when(q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    key = lambda df: sorted((r.doc_id, r.score) for r in q.quality_scores(d, df).collect())
    assert key(lab) == key(flipped)


def test_without_labels_and_empty(spark):
    docs, labels = make(20)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in q.quality_scores(d, lab).collect()} == {0.5}
    assert q.quality_scores(d.limit(0), lab).count() == 0
