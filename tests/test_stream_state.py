"""Bucketed stream state: what an epoch writes, replays, restarts, late rows."""

import datetime
import glob
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import dedup
from tidewater.streaming import keyed
from tidewater.streaming.buckets import BucketState

ROW = "k long, ts long, v string"


def feed(spark, src, i, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, f"p{i:02d}"))


def pieces(state):
    return sorted(glob.glob(os.path.join(state, "data", "epoch=*", "_bucket=*")))


def size(folders):
    return sum(os.path.getsize(f) for d in folders for f in glob.glob(d + "/*.parquet"))


def test_an_epoch_writes_only_the_buckets_of_its_batch(spark):
    base = tempfile.mkdtemp(prefix="tw-state-")
    src, state = os.path.join(base, "src"), os.path.join(base, "state")
    schema = spark.createDataFrame([], ROW).schema
    run = lambda: keyed.run_to_end(keyed.stream_upsert(spark, os.path.join(src, "*"), schema, state, os.path.join(base, "ckpt"), "k", ["ts"], max_files_per_trigger=1, buckets=32))
    now = {k: (1, "x" * 50 + str(k)) for k in range(8000)}
    feed(spark, src, 0, [(k, *r) for k, r in now.items()], ROW)
    run()
    whole = size(pieces(state))
    for i, batch in enumerate([[(5, 2, "a"), (9000, 2, "new")], [(5, 1, "old"), (None, 1, "n")], [(6, 3, "b")]], 1):
        feed(spark, src, i, batch, ROW)
        run()  # a restart each time
        for k, ts, v in batch:
            if k not in now or now[k][0] < ts:
                now[k] = (ts, v)
        written = [d for d in pieces(state) if f"epoch={i:012d}" in d]
        assert 1 <= len(written) <= len(batch) and size(written) < whole / 8
        got = {r.k: (r.ts, r.v) for r in keyed.upsert_state(spark, state, schema, "k", 32).read().collect()}
        assert got == now
    kept = BucketState(spark, state, schema, "k", 32)
    assert len(kept.epochs()) == 2  # this state and the one before
    assert len(pieces(state)) == len(set(kept.manifest()) | set(kept.manifest(kept.epochs()[-1])))
    with pytest.raises(ValueError):
        BucketState(spark, state, schema, "k", 16).read()


def test_a_replayed_epoch_gives_the_same_state(spark):
    state = BucketState(spark, tempfile.mkdtemp(prefix="tw-state-"), spark.createDataFrame([], ROW).schema, "k", 4, pieces=2)
    for epoch in range(6):
        rows = spark.createDataFrame([(k, epoch, "v") for k in range(epoch * 10, epoch * 10 + 10)], ROW)
        for _ in range(2):  # the second run is the replay
            state.append(rows, epoch, state.touched(rows))
            assert sorted(r.k for r in state.read().collect()) == list(range(epoch * 10 + 10))
        if epoch:
            assert state.read(epoch).count() == epoch * 10
    assert max(sum(b == p for p, _ in state.manifest()) for b in range(4)) <= 2
    empty = spark.createDataFrame([], ROW)
    state.append(empty, 6, state.touched(empty))
    assert state.read().count() == 60


def test_the_first_record_stays(spark):
    base = tempfile.mkdtemp(prefix="tw-first-")
    src, schema = os.path.join(base, "src"), spark.createDataFrame([], ROW).schema
    for i, b in enumerate([[(1, 10, "a"), (1, 9, "b"), (2, 1, "c")], [(1, 0, "d"), (3, 5, "e"), (None, 1, "n")], [(None, 0, "m"), (3, 1, "f")]]):
        feed(spark, src, i, b, ROW)
    keyed.run_to_end(keyed.stream_upsert(spark, os.path.join(src, "*"), schema, os.path.join(base, "state"), os.path.join(base, "ckpt"), "k", ["ts"],
                                         max_files_per_trigger=1, wins="first", buckets=4))
    got = {r.k: r.v for r in keyed.upsert_state(spark, os.path.join(base, "state"), schema, "k", 4).read().collect()}
    assert got == {1: "b", 2: "c", 3: "e", None: "n"}


def test_late_rows_and_forgotten_keys_under_a_watermark(spark):
    base = tempfile.mkdtemp(prefix="tw-first-")
    src, sink = os.path.join(base, "src"), os.path.join(base, "sink")
    at = lambda m: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m)
    kind = "k long, at timestamp, v string"
    schema = spark.createDataFrame([], kind).schema
    batches = [[(1, at(0), "a"), (2, at(30), "b")], [(1, at(20), "again"), (3, at(100), "c"), (4, None, "no time")],
               [(1, at(50), "still known"), (3, at(110), "again")], [(6, at(300), "d"), (5, at(10), "late")], [(7, at(305), "e")], [(1, at(310), "forgotten, so new")]]
    for i, b in enumerate(batches):
        feed(spark, src, i, b, kind)
    keyed.run_to_end(keyed.stream_first(spark, os.path.join(src, "*"), schema, sink, os.path.join(base, "ckpt"), ["k"], "at", "60 minutes", max_files_per_trigger=1))
    got = sorted((r.k, r.v) for r in spark.read.schema(schema).parquet(sink).collect())
    assert got == [(1, "a"), (1, "forgotten, so new"), (2, "b"), (3, "c"), (6, "d"), (7, "e")]


def test_stream_dedup_adds_its_rows_and_equals_one_pass(spark):
    base = tempfile.mkdtemp(prefix="tw-dedup-")
    src, state = os.path.join(base, "src"), os.path.join(base, "state")
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 6))
    vecs = [(i, [float(x) for x in centres[rng.integers(12)] + rng.normal(scale=0.15, size=6)]) for i in range(90)]
    kind = "id long, vec array<double>"
    for i in range(3):
        feed(spark, src, i, vecs[30 * i:30 * i + 30] + (vecs[:4] if i else []), kind)  # some rows come again
    schema = spark.createDataFrame([], kind).schema
    keyed.run_to_end(keyed.stream_dedup(spark, os.path.join(src, "*"), schema, state, os.path.join(base, "ckpt"), "id", "vec", 0.9, order="id",
                                        max_files_per_trigger=1, buckets=4))
    got = [(r.id, r.is_unique) for r in keyed.dedup_state(spark, state, schema, "id", 4).read().orderBy("id").collect()]
    once = dedup.dedup_greedy(spark.createDataFrame(vecs, kind), "id", "vec", 0.9, order="id", keep_flag=True).orderBy("id").collect()
    assert got == [(r.id, r.is_unique) for r in once]
    assert len(pieces(state)) <= 12 and all(spark.read.parquet(d).where(F.col("id") < 30 * e).count() == 0
                                            for e in range(3) for d in pieces(state) if f"epoch={e:012d}" in d)
