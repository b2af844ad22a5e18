"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path

CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    The written table cuts the lineage and survives the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, by adding underscores."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``store`` wrote and nothing will read again, and let Spark clean up after their jobs.

    Spark removes the shuffle files of finished jobs when the driver collects its garbage, which may be long after.
    """
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        tables[0].sparkSession.sparkContext._jvm.System.gc()


def row_key(*cols):
    """16 bytes that name a row by the given columns' contents; nulls differ from empty strings."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in cols]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts).cast("binary")))


def text_chunks(texts: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Texts as UTF-8 joined by NUL in pieces of about ``limit`` bytes: (first index, bytes, starts).

    ``starts`` has one more entry than there are texts; text k is ``data[starts[k]:starts[k+1]-1]``.
    A text longer than the limit is a piece of its own. None counts as empty.
    """
    first, parts, size = 0, [], 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8")
        if parts and size + len(b) > limit:
            yield first, *_joined(parts)
            first, parts, size = i, [], 0
        parts.append(b)
        size += len(b) + 1
    if parts:
        yield first, *_joined(parts)


def _joined(parts: list[bytes]) -> tuple[bytes, np.ndarray]:
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    return b"\x00".join(parts) + b"\x00", starts


def byte_runs(ok: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of true values that are at least ``least`` long."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], ok.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]
