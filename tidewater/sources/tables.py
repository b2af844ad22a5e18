"""Table scans. Parquet with column pruning and predicate pushdown by Catalyst."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def scan_table(spark: SparkSession, sf_dir: str, name: str, schema=None) -> DataFrame:
    """Full collection to a DataFrame (declared schema when given).

    How the files are cut into tasks is left to ``spark.sql.files.maxPartitionBytes``.
    """
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(table_path(sf_dir, name))


def scan_filtered(df: DataFrame, predicate: Column | None = None, fields: Sequence[str] | None = None,
                  limit: int | None = None, order_by: Sequence[str] | None = None) -> DataFrame:
    """Predicate, field list and limit.

    The predicate and the field list reach the Parquet scan (PushedFilters,
    ReadSchema). A limit is applied after an order so the rows are repeatable;
    the order is a per-partition top-k followed by a merge, not a full sort.
    """
    out = df
    if predicate is not None:
        out = out.where(predicate)
    if fields is not None:
        out = out.select(*fields)
    if limit is not None:
        if order_by:
            out = out.orderBy(*order_by)
        out = out.limit(limit)
    return out
