from pyspark.sql import functions as F

from tests.llm.test_pii import mixed
from tidewater.llm import pii


def test_every_document_counts(spark, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(mixed(120))], "doc_id long, text string")
    seen, put = [], pii.store
    monkeypatch.setattr(pii, "store", lambda d, name: seen.append(put(d, name)) or seen[-1])
    monkeypatch.setattr(pii, "SAMPLE_DOCS", 10, raising=False)
    pii.fit(df.unionByName(df))
    every = pii.with_candidates(pii.with_base(df)).select(F.explode("_proposed").alias("x"))
    assert seen[0].select("_pick").distinct().count() > 20
    assert seen[0].dropDuplicates(["_pick", "start", "end", "g"]).count() == every.count()
