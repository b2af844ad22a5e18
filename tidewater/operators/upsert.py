"""Sinks and keyed writes (K1-K9) as DataFrame programs.

Tables are immutable DataFrames here: each operator returns the new table
state (plus counts where the reference reports them); ``write_table`` persists
it. With a table format that has MERGE the same plan maps onto ``MERGE INTO``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ranking import with_ordinal


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Last write wins inside one batch: the row with the greatest ``order`` per key.

    ``max_by`` is a partial aggregation, so a key that holds a third of the
    batch is reduced on the map side before the shuffle.
    """
    return _one_per_key(df, key, order, F.max_by)


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First write wins inside one batch: the row with the smallest ``order`` per key, as partial an aggregation as the other."""
    return _one_per_key(df, key, order, F.min_by)


def _one_per_key(df: DataFrame, key: str, order: Sequence[str], pick) -> DataFrame:
    others = [c for c in df.columns if c != key]
    rec = F.struct(*[F.col(c) for c in others])
    ordering = F.struct(*[F.col(c) for c in order])
    agg = df.groupBy(key).agg(pick(rec, ordering).alias("_r"))
    return agg.select(key, *[F.col("_r")[c].alias(c) for c in others])


def upsert_by_key(target: DataFrame, incoming: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """K1: insert or overwrite the incoming record's fields by key; other target fields survive.

    Incoming rows are first reduced to one per key (last by ``order``); then a
    full outer join on the key picks, per listed field, the incoming value where
    the key arrived. Fields only the target has keep their value; fields only
    the incoming batch has are added (null for untouched keys).
    """
    inc = latest_per_key(incoming, key, order).withColumn("_hit", F.lit(True))
    t_cols = [c for c in target.columns if c != key]
    i_cols = [c for c in incoming.columns if c != key]
    t = target.select(key, *[F.col(c).alias(f"_t_{c}") for c in t_cols])
    i = inc.select(key, "_hit", *[F.col(c).alias(f"_i_{c}") for c in i_cols])
    j = t.join(i, key, "full_outer")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    out = [F.col(key)]
    for c in t_cols:
        if c in i_cols:
            out.append(F.when(hit, F.col(f"_i_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        else:
            out.append(F.col(f"_t_{c}").alias(c))
    out += [F.col(f"_i_{c}").alias(c) for c in i_cols if c not in t_cols]
    return j.select(*out)


def conform(df: DataFrame, fields: Sequence[str], default: Column | str | None = "") -> DataFrame:
    """K2 helper: select ``fields`` in order; missing or null string fields default to ``default``."""
    out = []
    for f in fields:
        if f in df.columns:
            c = F.col(f)
            out.append((F.coalesce(c, F.lit(default)) if default is not None else c).alias(f))
        else:
            out.append(F.lit(default).cast("string").alias(f))
    return df.select(*out)


def append_rows(table: DataFrame | None, rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """K2: append without a key check; the new rows' missing or null ``fields`` default to ''.

    Rows already in the table are left as they are; columns that only the table has are null in the new rows.
    """
    new = conform(rows, fields)
    return new if table is None else table.unionByName(new, allowMissingColumns=True)


def update_fields_by_key(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """K3: set the listed fields for keys that exist; never inserts."""
    u_cols = [c for c in updates.columns if c != key]
    u = updates.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_u_{c}") for c in u_cols])
    j = target.join(u, key, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    out = []
    for c in target.columns:
        if c in u_cols:
            out.append(F.when(hit, F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    out += [F.when(hit, F.col(f"_u_{c}")).alias(c) for c in u_cols if c not in target.columns]
    return j.select(*out)


def bulk_update_others(target: DataFrame, assignment: DataFrame, names: DataFrame, key: str = "_id",
                       cluster: str = "cluster", name: str = "name",
                       field: str = "final_risk") -> tuple[DataFrame, DataFrame]:
    """K4: rows carry their cluster id; set ``field`` to that cluster's name.

    Returns (new table, one-row frame with ``modified_count`` = rows whose value changed).
    The name table has one row per cluster and is joined by cluster id.
    """
    upd = assignment.join(names.select(cluster, F.col(name).alias(field)), cluster).select(key, field)
    old = target.select(key, F.col(field).alias("_old"))
    modified = upd.join(old, key).agg(
        F.count_if(~F.col(field).eqNullSafe(F.col("_old"))).alias("modified_count"))
    return update_fields_by_key(target, upd, key), modified


def copy_column(df: DataFrame, src: str = "main_risk", dst: str = "final_risk") -> DataFrame:
    """K5: dst = src for all rows."""
    return df.withColumn(dst, F.col(src))


def delete_discovered(categories: DataFrame, key: str = "_id") -> DataFrame:
    """K6: keep categories whose id is an integer (seed rows), drop discovered ones."""
    return categories.where(F.col(key).cast("string").try_cast("int").isNotNull())


def seed_categories(spark, existing: DataFrame | None = None) -> DataFrame:
    """K7: idempotent upsert of the 13 seed categories into the catalogue."""
    from tidewater.schemas import SEED_CATEGORIES
    seed = spark.createDataFrame([(str(i), c, d, "seed") for i, c, d in SEED_CATEGORIES],
                                 "_id string, category string, description string, origin string")
    if existing is None:
        return seed
    return upsert_by_key(existing, seed.withColumn("_seq", F.lit(0)), "_id", ["_seq"]).drop("_seq")


def export_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """K8: table to a header CSV (spreadsheet stand-in) or Parquet."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def numbered_lines(df: DataFrame, text: str, order: Sequence[str], with_id: str | None = None) -> DataFrame:
    """K9 rows: ``"{n}. {text}\\n\\n"`` with n from 1 in order, or ``"id: {_id}\\n{text}\\n\\n"``."""
    o = with_ordinal(df, list(order), "n")
    if with_id:
        line = F.concat(F.lit("id: "), F.col(with_id).cast("string"), F.lit("\n"), F.col(text), F.lit("\n\n"))
    else:
        line = F.concat(F.col("n").cast("string"), F.lit(". "), F.col(text), F.lit("\n\n"))
    return o.select("n", line.alias("line"))


def write_numbered_text(df: DataFrame, path: str, text: str, order: Sequence[str],
                        with_id: str | None = None) -> None:
    """K9: write the numbered records as text, in order (range-partitioned by n, no single task)."""
    lines = numbered_lines(df, text, order, with_id)
    lines.repartitionByRange("n").sortWithinPartitions("n").select("line") \
        .write.mode("overwrite").text(path)
