"""Ordinals and bounded top-n per group, written so a hot group never lands in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW_BITS = 33  # monotonically_increasing_id = partition_id << 33 | row_in_partition


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                    salt_key: str | None = None, rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..n per group by ``order`` (which must be a total order).

    ``row_number() <= n`` lets the optimizer plan a partial WindowGroupLimit
    before the shuffle (visible in ``explain``): every map task forwards at most
    n rows per group, so a group holding a third of the table never reaches one
    task whole. ``salt_key`` is accepted for callers of the earlier two-stage form.
    """
    w = Window.partitionBy(*list(keys)).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def with_ordinal(df: DataFrame, order: Sequence[str | Column], name: str = "ordinal",
                 start: int = 1) -> DataFrame:
    """Consecutive global ordinal by ``order`` without a single-partition window.

    Range-sort, then number rows inside each partition and add the row counts
    of the earlier partitions (a frame with one row per partition, broadcast).
    The sorted frame is persisted so both passes see the same partitioning (a caller that has written the
    result may ``unpersist`` it, the result's ``sorted_rows``); ``order`` must be a total order (include a unique key) to be repeatable.
    """
    sorted_df = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    sorted_df = sorted_df.withColumn("_pid", F.shiftright("_mid", ROW_BITS)) \
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
    sorted_df = sorted_df.persist()
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
    offsets = offsets.select("_pid", F.coalesce("_off", F.lit(0)).alias("_off"))
    out = sorted_df.join(F.broadcast(offsets), "_pid") \
        .withColumn(name, F.col("_off") + F.col("_pos") + F.lit(start))
    out = out.drop("_mid", "_pid", "_pos", "_off")
    out.sorted_rows = sorted_df
    return out
