from tidewater.llm import pii
from tests.llm.test_pii import mixed


def test_sample_is_scanned_in_parallel(spark, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(mixed(200))], "doc_id long, text string").repartition(4)
    parts = []
    put = getattr(pii, "store", None)
    monkeypatch.setattr(pii, "store", lambda d, name: parts.append(d.rdd.getNumPartitions()) or put(d, name), raising=False)
    model = pii.fit(df)
    assert parts == [4] and model is not None
    # rows in another order give the same trees
    assert pii.fit(df.repartition(3)) == model


def test_repeated_and_unnamed_rows_are_one_document_each(spark):
    texts = mixed(60)
    once = [(i if i % 3 else None, t) for i, t in enumerate(texts)]
    model = pii.fit(spark.createDataFrame(once, "doc_id long, text string"))
    again = once * 2 + [once[0]] * 300
    assert pii.fit(spark.createDataFrame(again, "doc_id long, text string")) == model


def test_many_spans_in_one_text(spark):
    n = 40_000
    text = "\n".join(f"10.{i % 256}.{i // 256 % 256}.7 call {i:07d}" for i in range(n))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([text, *mixed(40)])], "doc_id long, text string")
    model = pii.fit(docs, sample_spans=5000)
    out = {r.doc_id: r for r in pii.personal_data(docs.where("doc_id = 0")).collect()}
    assert out[0].n_ip == n
    red = pii.redact(docs.where("doc_id = 0"), model).first().text.split("\n")
    assert len(red) == n and all(r.startswith("[IP] call") for r in red)
