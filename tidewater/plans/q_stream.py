"""Streaming queries (ST1, ST2): file streams drained with availableNow, state read back."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tidewater.plans.registry import query
from tidewater.plans.q_vectors import EMB_EDGES, greedy_sql
from tidewater.session import scratch_path
from tidewater.sources.tables import scan_table
from tidewater.streaming import keyed


def _split_files(df, path: str, col: str, parts: int):
    """Write ``df`` as ``parts`` folders of one file in ascending ranges of ``col`` (one job per range, in order)."""
    bounds = df.agg(F.min(col), F.max(col)).first()
    lo, hi = bounds[0], bounds[1]
    step = (hi - lo) / parts
    for i in range(parts):
        a = lo + step * i
        cond = (F.col(col) >= a) if i == 0 else (F.col(col) > a)
        if i < parts - 1:
            cond = cond & (F.col(col) <= lo + step * (i + 1))
        df.where(cond).coalesce(1).write.mode("overwrite").parquet(os.path.join(path, f"part{i:03d}"))


def _arrivals(spark, sf_dir, table: str, col: str, base: str, *columns: str):
    """A table as four files in ascending ranges of ``col``, so that each is a micro-batch: (file pattern, schema)."""
    src = os.path.join(base, "src")
    t = scan_table(spark, sf_dir, table)
    _split_files(t.select(*columns) if columns else t, src, col, 4)
    return os.path.join(src, "*"), spark.read.parquet(os.path.join(src, "part000")).schema


def _upserted(spark, sf_dir, wins: str):
    base = scratch_path(spark, "stream-upsert")
    src, schema = _arrivals(spark, sf_dir, "events", "event_id", base)
    state, order = os.path.join(base, "state"), ["ts", "event_id"] if wins == "last" else ["event_id"]
    keyed.run_to_end(keyed.stream_upsert(spark, src, schema, state, os.path.join(base, "ckpt"), "user_id", order,
                                         max_files_per_trigger=1, wins=wins, buckets=8))
    return keyed.upsert_state(spark, state, schema, "user_id", buckets=8).read().select("user_id", "event_id", "ts", "event_type", "value", "props")


@query("stream_upsert", sql="""
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def q_stream_upsert(spark, sf_dir):
    """ST1: events arrive as 4 files (one micro-batch each) and are upserted by user_id, the latest wins."""
    return _upserted(spark, sf_dir, "last")


@query("stream_insert_once", sql="""
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn = 1
""")
def q_stream_insert_once(spark, sf_dir):
    """ST1: the same arrivals, but the first record of a user stays and later ones change nothing."""
    return _upserted(spark, sf_dir, "first")


@query("stream_first", sql="SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events")
def q_stream_first(spark, sf_dir):
    """ST1, first wins under a watermark: events arrive as 4 files in time order; the users first seen on each day."""
    base = scratch_path(spark, "stream-first")
    days = scan_table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    src, sink = os.path.join(base, "src"), os.path.join(base, "first")
    _split_files(days, src, "at", 4)
    schema = spark.read.parquet(os.path.join(src, "part000")).withColumn("ts", F.col("ts").cast("timestamp")).schema
    keyed.run_to_end(keyed.stream_first(spark, os.path.join(src, "*"), schema, sink, os.path.join(base, "ckpt"), ["user_id", "day"], "ts",
                                        "1 day", max_files_per_trigger=1))
    return spark.read.schema(schema).parquet(sink).select("user_id", "day")


@query("stream_dedup", sql=greedy_sql(EMB_EDGES, "SELECT vec_id AS id FROM embeddings") + """
SELECT vec_id, list_contains((SELECT kept FROM g WHERE rn = (SELECT count(*) FROM embeddings)), vec_id) AS is_unique
FROM embeddings
""")
def q_stream_dedup(spark, sf_dir):
    """ST2: embeddings arrive in 4 vec_id-ordered files; each batch is checked against kept rows."""
    base = scratch_path(spark, "stream-dedup")
    src, schema = _arrivals(spark, sf_dir, "embeddings", "vec_id", base, "vec_id", "embedding")
    state = os.path.join(base, "state")
    keyed.run_to_end(keyed.stream_dedup(spark, src, schema, state, os.path.join(base, "ckpt"), "vec_id", "embedding", 0.4,
                                        order="vec_id", max_files_per_trigger=1, buckets=8))
    return keyed.dedup_state(spark, state, schema, "vec_id", buckets=8).read().select("vec_id", "is_unique")
