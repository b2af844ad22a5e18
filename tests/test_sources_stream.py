"""Record files and streaming: round trips through files written by the tests themselves."""

import os
import random
import tempfile

from pyspark.sql import functions as F

from tidewater.sources import records
from tidewater.streaming import keyed


def write(path, name, content):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(content)


def test_id_blocks_drop_first_piece_and_incomplete(spark):
    d = tempfile.mkdtemp(prefix="tw-blocks-")
    write(d, "a.txt", "header\nid: 7\nDisruption event: fire\nPort Affected: Durban\nDate: 1 May\n\n"
                      "id: 8\nDisruption event: no port here\nDate: x\n")
    rows = records.scan_id_blocks(spark, d).collect()
    assert [(r["_id"], r["event"], r["port_affected"], r["date"]) for r in rows] == [("7", "fire", "Durban", "1 May")]


def test_blank_line_records_and_keys(spark):
    d = tempfile.mkdtemp(prefix="tw-recs-")
    write(d, "a.txt", "Disruption event: e1\nPort Affected: p1\n\nDisruption event: e2\nPort Affected: p2")
    write(d, "skip.csv", "Disruption event: nope")
    r = records.scan_blank_line_records(spark, d).select(F.col("kv")["Port Affected"].alias("p")).collect()
    assert sorted(x["p"] for x in r) == ["p1", "p2"]


def test_numbered_lines_and_word_vectors(spark):
    d = tempfile.mkdtemp(prefix="tw-num-")
    write(d, "a.txt", "1. Port Closure\n\n2. ## **Port Disruption**\n   continuation\n3. Error occurred\n")
    got = [(r["n"], r["label"]) for r in records.scan_numbered_lines(spark, d).orderBy("n").collect()]
    assert got == [(1, "Port Closure"), (2, "Port Disruption"), (3, "")]
    v = tempfile.mkdtemp(prefix="tw-vec-")
    write(v, "g.txt", "ship 0.5 -1.0 2\nport 1 1 1\n")
    vecs = {r["token"]: r["vector"] for r in records.scan_word_vectors(spark, v).collect()}
    assert vecs == {"ship": [0.5, -1.0, 2.0], "port": [1.0, 1.0, 1.0]}


def test_stream_upsert_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="tw-stream-")
    src = os.path.join(base, "src")
    batches = [[(1, 10, "a"), (2, 11, "b")], [(1, 12, "c"), (3, 9, "d")], [(2, 5, "late")]]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, "k long, ts long, v string").coalesce(1).write.parquet(os.path.join(src, f"p{i}"))
    schema = spark.read.parquet(os.path.join(src, "p0")).schema
    q = keyed.stream_upsert(spark, os.path.join(src, "*"), schema, os.path.join(base, "state"),
                            os.path.join(base, "ckpt"), "k", ["ts"], max_files_per_trigger=1)
    keyed.run_to_end(q)
    out = {r["k"]: r["v"] for r in keyed.upsert_state(spark, os.path.join(base, "state"), schema, "k").read().collect()}
    assert out == {1: "c", 2: "b", 3: "d"}


def test_id_blocks_of_large_files_are_read_by_many_tasks(spark):
    d = tempfile.mkdtemp(prefix="tw-blocks-")
    rng = random.Random(3)
    texts = []
    for f in range(2):
        head = "preamble " * 3000 if f else ""  # one file begins with its marker
        blocks = [f" {f}-{i}\nDisruption event: e{rng.randint(0, 99)}\nPort Affected: p{i}\nDate: d\nText: {'é w ' * rng.randint(0, 400)}\n\n" for i in range(900)]
        texts.append(head + "".join("id:" + b for b in blocks))
        write(d, f"{f}.txt", texts[-1])
    want = sorted(p for t in texts for p in t.split("id:")[1:])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        pieces = records.marked_pieces(spark, d, "id:")
        assert pieces.rdd.getNumPartitions() > 8
        got = pieces.collect()
        n = records.scan_id_blocks(spark, d).select("_id").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(r.piece for r in got) == want and n == 1800
    for f, text in enumerate(texts):
        mine = sorted((r.start, r.pos, r.piece) for r in got if r.file.endswith(f"{f}.txt"))
        assert [p for _, _, p in mine] == text.split("id:")[1:]


def test_blank_line_records_over_line_ends_and_parts(spark):
    d = tempfile.mkdtemp(prefix="tw-recs-")
    rng = random.Random(5)
    want = []
    for f, end in enumerate(["\n", "\r\n", None]):
        recs = [[f"k{i}: {'é x ' * rng.choice([0, 3, 200])}v", *(["more"] * rng.randint(0, 3))] for i in range(400)]
        recs[7] = [f"long {i} " + "y" * 500 for i in range(2000)]  # spans many parts
        want += ["\n".join(r) for r in recs]
        eol = lambda: end or rng.choice(["\n", "\r\n"])
        body = "".join("".join(line + eol() for line in r) + eol() * rng.randint(1, 3) for r in recs)
        with open(os.path.join(d, f"{f}.txt"), "w", encoding="utf-8", newline="") as out:
            out.write(eol() * (f % 2) + body.rstrip("\r\n") + (eol() if f else ""))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
    try:
        read = records.blank_line_records(spark, d)
        got = sorted(r.record for r in read.collect())
        parts = spark.read.text(d).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert parts > 30 and got == sorted(want)
