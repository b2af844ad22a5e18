import glob

import pytest

from tidewater.plans import q_files
from tidewater.sources import records


@pytest.mark.parametrize("query,reader", [(q_files.q_scan_numbered_sections, "scan_numbered_sections"), (q_files.q_scan_blank_line_records, "scan_blank_line_records"),
                                          (q_files.q_drop_incomplete_by_file, "scan_blank_line_records")])
def test_exports_have_more_files_the_larger_the_table(spark, tmp_path, monkeypatch, query, reader):
    rows = [(i, f"text {i}", "en", f"src{i}", 6 + i) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    read, paths = getattr(records, reader), []
    monkeypatch.setattr(records, reader, lambda s, path: paths.append(path) or read(s, path))
    assert query(spark, str(tmp_path)).count() == 200
    assert len(glob.glob(f"{paths[0]}/part-*")) > 5
