"""Structured Streaming forms of the polling loops (ST1, ST2).

``stream_upsert`` and ``stream_dedup`` run ``foreachBatch`` over a file stream: each micro-batch is merged into the state
with the batch operator (K1 upsert, D2 incremental dedup). The state lies in hash buckets (``buckets.BucketState``): an
upsert rewrites only the buckets that the batch touches, a dedup only adds its rows. A replayed batch reads the state before
its own epoch and overwrites its own output; the checkpoint location records progress. ``stream_first`` needs no state of
our own: Spark's watermark bounds what it remembers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructType

from tidewater.operators import dedup, upsert
from tidewater.streaming.buckets import BucketState


def _files(spark: SparkSession, source: str, schema, fmt: str, max_files_per_trigger: int | None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(source)


def _each_batch(rows: DataFrame, merge, checkpoint: str):
    def once(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()  # read for its buckets and again for the merge
        try:
            merge(batch, epoch)
        finally:
            batch.unpersist()

    return rows.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_state(spark: SparkSession, state_dir: str, schema: StructType, key: str, buckets: int = 64) -> BucketState:
    """The state that ``stream_upsert`` keeps; ``.read()`` gives its rows."""
    return BucketState(spark, state_dir, schema, key, buckets)


def stream_upsert(spark: SparkSession, source: str, schema, state_dir: str, checkpoint: str, key: str,
                  order: Sequence[str], fmt: str = "parquet", max_files_per_trigger: int | None = None,
                  wins: str = "last", buckets: int = 64):
    """ST1: arriving records kept current by key; returns the query.

    ``wins="last"``: the record with the greatest ``order`` stays, so replayed or late batches cannot roll a key back.
    ``wins="first"``: the record that arrived first stays, in one batch the one with the smallest ``order``; later ones change
    nothing. Records without a key are one key; ties in the whole order keep any one of the tied. Run with
    ``availableNow``: a backlog drains in micro-batches and the query stops.
    """
    if wins not in ("last", "first"):
        raise ValueError(f"wins is 'last' or 'first', not {wins!r}")
    state = upsert_state(spark, state_dir, schema, key, buckets)

    def merge(batch: DataFrame, epoch: int) -> None:
        touched = state.touched(batch)
        cur = state.read(epoch, touched)
        if wins == "last":
            new = upsert.latest_per_key(cur.unionByName(batch), key, list(order))
        else:
            first = upsert.first_per_key(batch, key, list(order))
            known = cur.select(F.col(key).alias("_known"))
            new = cur.unionByName(first.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti"))
        state.replace(new, epoch, touched)

    return _each_batch(_files(spark, source, schema, fmt, max_files_per_trigger), merge, checkpoint)


def stream_first(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, key: Sequence[str], event_time: str,
                 delay: str, fmt: str = "parquet", max_files_per_trigger: int | None = None):
    """ST1, first wins with bounded state: the first record of a key goes to the Parquet folder ``sink``; returns the query.

    Later records of the key are dropped at least as long as their event times lie within ``delay`` of it. The watermark is the
    greatest event time of earlier batches less ``delay``. Keys before it are forgotten when a batch ends, so the state holds
    the keys of about one ``delay``; records before the watermark of the batch before are late and dropped. Which of a key's records in one batch comes first is
    Spark's choice; records that must be told apart by an order belong in ``stream_upsert(wins="first")``. Records
    without an event time stay out.
    """
    rows = _files(spark, source, schema, fmt, max_files_per_trigger).where(F.col(event_time).isNotNull())
    once = rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key))
    return once.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint) \
        .outputMode("append").trigger(availableNow=True).start()


def dedup_state(spark: SparkSession, state_dir: str, schema: StructType, key: str, buckets: int = 64, pieces: int = 16) -> BucketState:
    """The state that ``stream_dedup`` keeps: every processed row with ``is_new`` and ``is_unique``; ``.read()`` gives its rows."""
    whole = StructType(list(schema.fields))
    for flag in ("is_new", "is_unique"):
        if flag not in whole.names:
            whole = whole.add(flag, BooleanType())
    return BucketState(spark, state_dir, whole, key, buckets, pieces)


def stream_dedup(spark: SparkSession, source: str, schema, state_dir: str, checkpoint: str, key: str,
                 vec: str, threshold: float = 0.9, order: str | None = None, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None, buckets: int = 64, pieces: int = 16):
    """ST2: arriving rows checked against the kept rows so far (D2); returns the query.

    Rows already judged never change, so an epoch writes its own rows only. A row whose key was processed before is
    passed over (rows without a key never are): the batch meets the keys of its own buckets, not the whole history. Of the history, only kept rows' vectors are read for
    the similarity join.
    """
    state = dedup_state(spark, state_dir, schema, key, buckets, pieces)

    def merge(batch: DataFrame, epoch: int) -> None:
        touched = state.touched(batch)
        known = state.read(epoch, touched).select(F.col(key).alias("_known"))
        fresh = batch.join(known, F.col(key) == F.col("_known"), "left_anti")
        seen = state.read(epoch).where("is_unique").select(vec)
        out = dedup.dedup_incremental(seen, fresh, key, vec, threshold, order=order)
        state.append(out, epoch, touched)

    return _each_batch(_files(spark, source, schema, fmt, max_files_per_trigger), merge, checkpoint)


def run_to_end(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
