import hashlib
import random

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as p
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_near_dup import brute as groups
from tidewater.llm import bpe, pii, zstd_quality
from tidewater.llm.util import store

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def corpus():
    rng = random.Random(8)
    vocab = [f"word{k}" for k in range(400)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(k, " ".join(text(20))) for k in range(5)]
    texts, labels = [], []
    for i in range(120):
        w = text(rng.randrange(40, 120))
        if i % 10 == 0:
            w += items[i % 5][1].split()
        if i % 7 == 0:
            w.insert(3, f"user{i}@mail.example.com")
        good = i % 4 != 1
        texts.append(" ".join(w) if good else " | ".join(x.upper() + "!!" for x in w))
        labels.append((i, int(good), 0))
    texts += [texts[2], texts[3], " ".join(texts[4].split()[:-1]), None, ""]
    rows = [(i, t, "en", "src0", len(t or ""), "e") for i, t in enumerate(texts)] + [(None, texts[6], None, None, None, None)]
    return rows, items, labels


def test_stages_equal_brute_force(spark, tmp_path):
    rows, items, labels = corpus()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    key = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))

    stages = dict(p.STAGES)
    one = store(stages["quality"](spark, docs, str(tmp_path)), "t")
    kept = {r.doc_id for r in zstd_quality.quality_scores(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).where("predicted = 1").collect()}
    assert one.columns == docs.columns and key(one) == sorted(str(r) for r in rows if r[0] in kept)
    truth = {i for i, y, _ in labels if not y}
    assert len(truth & kept) <= 1 and len(kept) >= 85

    two = store(stages["near_duplicates"](spark, one, str(tmp_path)), "t")
    old = [tuple(r) for r in one.collect()]
    low = [g for _, _, g in groups([(r[0], r[1]) for r in old])]
    want = [r for r, g in zip(old, low) if r[0] == g]
    assert two.columns == docs.columns and key(two) == sorted(map(str, want))

    three = store(stages["decontaminate"](spark, two, str(tmp_path)), "t")
    want = [r for r in want if not contaminated(r[1], items)[4]]
    assert three.columns == docs.columns and key(three) == sorted(map(str, want))

    four = store(stages["personal_data"](spark, three, str(tmp_path)), "t")
    assert four.columns == docs.columns and four.count() == len(want)
    assert four.where(F.col("text").rlike(pii.PATTERNS["email"])).count() == 0 and four.where("n_chars <> length(text)").count() == 0

    five = stages["tokens"](spark, four, str(tmp_path)).collect()
    lib = Tokenizer.from_file(bpe.default_vocabulary())
    texts = {r.doc_id: r.text or "" for r in four.collect()}
    for r in five:
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_empty_documents(spark, tmp_path):
    rows, items, labels = corpus()
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert p.run(spark, str(tmp_path)).count() == 0
