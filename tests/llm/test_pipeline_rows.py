"""Pipeline stages decide by row: ids that are null or repeat, items without an id."""

import random

import corpus_pipeline as p

SCHEMA = "doc_id long, text string, lang string, n_chars long"


def text(rng, n=60):
    return " ".join(f"w{rng.randrange(500)}" for _ in range(n))


def row(i, t, lang="en"):
    return (i, t, lang, len(t or ""))


def run(spark, stage, rows, sf_dir=""):
    docs = spark.createDataFrame(rows, SCHEMA)
    out = dict(p.STAGES)[stage](spark, docs, sf_dir)
    assert out.columns == docs.columns
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_near_duplicates_by_row(spark):
    rng = random.Random(3)
    a, b, c, d, e = (text(rng) for _ in range(5))
    keep = [row(1, a), row(2, b), row(4, d), row(None, e), row(8, ""), row(8, ""), row(None, None), row(None, None)]
    drop = [row(None, a), row(None, a + " more"), row(2, b), row(10, b + " more"), row(4, a), row(None, e), row(None, e), row(9, d + " x")]
    assert run(spark, "near_duplicates", keep + drop + [row(3, c, "en"), row(3, c, "en")]) == sorted(keep + [row(3, c)], key=str)
    assert len(run(spark, "near_duplicates", [row(2, b), row(2, b + " more"), row(None, b)])) == 1


def test_decontaminate_by_row(spark, tmp_path):
    rng = random.Random(5)
    named, unnamed, clean, other = text(rng, 20), text(rng, 20), text(rng), text(rng)
    spark.createDataFrame([(1, named), (None, unnamed)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    keep = [row(1, clean), row(None, other), row(None, None), row(5, "")]
    drop = [row(1, named), row(None, named + " tail"), row(7, unnamed), row(None, unnamed)]
    assert run(spark, "decontaminate", keep + drop, str(tmp_path)) == sorted(keep, key=str)


def test_columns_with_clashing_names_pass_through(spark, tmp_path):
    rng = random.Random(9)
    names = ["_key", "_text", "_base", "_spans", "_t", "_row", "key", "n_shingles", "kept"]
    rows = [(i, text(rng) + f" me{i}@mail.example.com", "en", 5, *(f"{c} {i}" for c in names)) for i in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA + "".join(f", {c} string" for c in names))
    spark.createDataFrame([(1, text(rng, 20))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for stage in ("near_duplicates", "decontaminate", "personal_data"):
        out = dict(p.STAGES)[stage](spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert sorted(tuple(r)[4:] for r in out.collect()) == sorted(r[4:] for r in rows)
