"""LDA topics: only the named words go back to Spark, not the vocabulary."""
from tidewater.operators import scoring


def test_only_named_words_become_rows(spark, monkeypatch):
    df = spark.createDataFrame([(" ".join(f"w{chr(97 + (i + j) % 26)}{chr(97 + j)}" for j in range(20)),) for i in range(30)], "t string")
    sizes, real = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: sizes.append(len(data)) or real(self, data, *a, **k))
    got = scoring.lda_topics(df, "t", k=2, words=3, max_iter=2).collect()
    assert [(r.topic, r["rank"]) for r in got] == [(t, n) for t in range(2) for n in range(3)] and all(r.term for r in got)
    assert sizes and max(sizes) <= 6
