import math
import random
from collections import Counter

from pyspark.sql import functions as F

from tidewater.operators import scoring


def brute(rows, n):
    docs = {}
    for k, t in rows:
        w = (t or "").lower().split()
        docs.setdefault(k, Counter()).update([*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))])
    df = Counter(p for c in docs.values() for p in c)
    score = lambda c, p: c[p] * math.log((len(docs) + 1) / (df[p] + 1))
    return {(k, r, p) for k, c in docs.items() for r, p in enumerate(sorted(c, key=lambda p: (-round(score(c, p), 9), p))[:n], 1)}


def rows(seed):
    rng = random.Random(seed)
    common, rare = [f"w{chr(97 + i)}" for i in range(20)], ["".join(rng.choices("abcdefgh", k=6)) for _ in range(400)]
    text = lambda: " ".join(rng.choice(common if rng.random() < 0.7 else rare) for _ in range(rng.randrange(1, 120)))
    return [(i, text()) for i in range(60)] + [(200, None), (201, "")]


def test_equals_the_plain_form(spark):
    for extra in ([], [(1, "wa wb wa wb"), (None, "wa wz"), (None, "wz wz"), (2, None)]):
        data = rows(1) + extra
        got = scoring.top_phrases(spark.createDataFrame(data, "doc_id long, text string"), "doc_id", "text", 4).collect()
        assert {(r.doc_id, r["rank"], r.phrase) for r in got} == brute(data, 4) and len(got) == len(brute(data, 4))


def test_few_phrases_are_joined(spark):
    data = [(i, t.split() if t else []) for i, t in rows(2)]
    docs = spark.createDataFrame(data, "key long, words array<string>")
    every = scoring._emitted(docs, lambda counts: counts.items())
    dfreq = every.groupBy("phrase").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    may = scoring.candidate_phrases(docs, dfreq, len(data), 4)
    assert may.count() < every.count() / 3


def test_words_are_made_once_per_slice():
    import pyarrow as pa
    lists = [["a", "b", "a"], None, [], ["c"], ["b", "c"]]
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.string()))], ["words"])
    got = list(scoring._lists(batch, rows=2))
    assert got == [(i, w or []) for i, w in enumerate(lists)]
    whole = list(scoring._lists(batch))
    assert whole[0][1][0] is whole[0][1][2] and scoring._phrase_counts(["a", "b", "a", "b"]) == {"a": 2, "b": 2, "a b": 2, "b a": 1}
