"""Queries take whole texts of documents into encoders, prompts and record files."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators import scoring
from tidewater.plans import q_files, q_models
from tidewater.sources import records

TEXTS = ["same headline\nbody one", "same headline\nbody two: x\n\nthird line", "", None, "single"]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, t, ["en", "de"][i % 2], f"src{i}", len(t or "")) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 0, 0) for i in range(5)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_discover_categories_reads_whole_texts(spark, sf_dir, monkeypatch):
    seen = []

    def stop(a, key, text, *rest, **named):
        seen.extend(r[0] for r in a.select(text).collect())
        raise InterruptedError

    monkeypatch.setattr(scoring, "discover_categories", stop)
    with pytest.raises(InterruptedError):
        q_models.q_discover_categories(spark, sf_dir)
    assert sorted(map(str, seen)) == sorted(map(str, TEXTS))


def test_encode_covers_document_texts(spark, sf_dir):
    got = {r.doc_id: r.embedding for r in q_models.q_encode(spark, sf_dir).collect()}
    want = scoring.hashed_trigram_encoder()(TEXTS)
    assert len(got) == len(TEXTS) and all(got[i] == want[i].tolist() for i in got)


@pytest.mark.parametrize("query,want", [
    (q_files.q_scan_blank_line_records, [(str(i), f"src{i}", ["en", "de"][i % 2]) for i in range(5)]),
    (q_files.q_drop_incomplete_by_file, [(str(i), f"src{i}") for i in (0, 2, 4)])])
def test_records_hold_whole_texts(spark, sf_dir, monkeypatch, query, want):
    read, seen = records.scan_blank_line_records, []
    monkeypatch.setattr(records, "scan_blank_line_records", lambda *a: seen.append(read(*a)) or seen[-1])
    assert set(want) <= {tuple(r) for r in query(spark, sf_dir).collect()}  # five rows may share no file
    texts = {r.i: r.t for r in seen[0].where(F.size("kv") > 0).select(F.col("kv")["id"].alias("i"), F.col("kv")["Text"].alias("t")).collect()}
    assert texts == {str(i): (t or "").replace("\n", " ") for i, t in enumerate(TEXTS)}


def test_id_blocks_hold_whole_texts(spark, sf_dir, monkeypatch):
    read, paths = records.scan_id_blocks, []
    monkeypatch.setattr(records, "scan_id_blocks", lambda s, path: paths.append(path) or read(s, path))
    got = sorted(tuple(r) for r in q_files.q_scan_id_blocks(spark, sf_dir).collect())
    assert got == [(str(i), f"event {i}", f"src{i}", ["en", "de"][i % 2]) for i in range(5)]
    lines = {r.value for r in spark.read.text(paths[0]).collect()}
    assert {"Text: " + (t or "").replace("\n", " ") for t in TEXTS} <= lines
