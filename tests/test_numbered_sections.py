"""Numbered sections are cut where lines are read, whatever the parts of a file."""
import random
import re

import pytest

from tidewater.functions import text as T
from tidewater.sources import records


def files():
    rng = random.Random(7)
    bits = ["1. ", "22.\n", "3.\t", "4.", "\n", "\n\n", " \n", "text", "é x", "5. a\n6. b", "Date: d\n", "\r\n", "7.8 no", "x9. no", "10.\r\n", "Port Affected: p\n11.\n\n12. y", "13. "]
    texts = ["".join(rng.choice(bits) + rng.choice(["\n", "", "\n"]) for _ in range(rng.randrange(1, 40))) for _ in range(14)]
    return texts + ["", "1. a", "\n1. a", "a\n1.", "a\n1.\n", "a\n1. ", "a\n1.\n2.\n3.\n4. b", "\n\n\n", "﻿1. a\n2. b", "a\n1. b\n2.", "1.\n2.\n3.\n4.\n5."]


@pytest.mark.parametrize("part", ["24b", "128m"])
def test_sections_equal_a_split_of_the_whole_file(spark, tmp_path, monkeypatch, part):
    for i, t in enumerate(files()):
        (tmp_path / f"f{i:03}.txt").write_bytes(t.encode())
    monkeypatch.setattr(T, "extract_section_fields", lambda s: [s.alias("section")])
    spark.conf.set("spark.sql.files.maxPartitionBytes", part)
    spark.conf.set("spark.sql.files.openCostInBytes", "1m" if part == "128m" else "0")
    try:
        got = records.scan_numbered_sections(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = {(f"f{i:03}.txt", n, s) for i, t in enumerate(files()) for n, s in enumerate(re.split(r"\n[0-9]+\.[ \t\n\x0b\f\r]+", t)) if n}
    assert sorted((r.file.rsplit("/", 1)[-1], r.pos, r.section) for r in got) == sorted(want)


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "one.txt").write_text("Answers\n" + "".join(f"\n{n}. Disruption event: e{n}\nPort Affected: p\n" for n in range(1, 400)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = records.scan_numbered_sections(spark, str(tmp_path))
        rows = got.collect()
        assert got.rdd.getNumPartitions() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r.pos, r.disruption_event) for r in rows) == [(n, f"e{n}") for n in range(1, 400)]
