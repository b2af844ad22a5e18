"""Keyed state in hash buckets, for streams whose state outgrows a batch (ST1, ST2).

Rows lie under ``data/epoch=<n>/<bucket column>=<b>``; ``manifest/epoch=<n>`` lists the pieces (bucket, epoch) that make up
the state after epoch n. An epoch writes only the buckets that its batch touches; the others stay where they are. The
manifest is written last, so an epoch without one never happened, and a replay overwrites its own folders. The state
before a running epoch is kept for its replay; pieces that no manifest lists any more are deleted.

Through the driver pass only manifests: at most ``buckets * pieces`` rows each, whatever the state's size, and never
more than three of them on disk.
"""

from __future__ import annotations

import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "bucket int, epoch long, buckets int"


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of the state by the file system that its path names; one that is gone already is fine."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class BucketState:
    """A keyed table that grows by epochs.

    ``buckets`` is fixed for the life of the state (another number is refused). Choose it so that one bucket of the full
    state is a comfortable task. Null keys share a bucket, and a bucket larger than a task is split by the rebalancing
    before the write. ``pieces`` bounds the pieces of one bucket in ``append``: one more, and they are written as one.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, buckets: int = 64, pieces: int = 16):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.buckets, self.pieces = buckets, pieces
        self.column = "_bucket"
        while self.column in {f.name.lower() for f in schema}:
            self.column += "_"

    def epochs(self) -> list[int]:
        """Epochs with a manifest, ascending. Only a missing folder means that there is none; other errors are raised."""
        try:
            files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{self.path}/manifest").select("path").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted({int(re.search(r"epoch=(\d+)", f.path)[1]) for f in files if f.path.endswith(".parquet")})

    def manifest(self, before: int | None = None) -> list[tuple[int, int]]:
        """The pieces (bucket, epoch) of the newest state, or of the newest one below epoch ``before``."""
        known = [e for e in self.epochs() if before is None or e < before]
        return self._pieces(known[-1]) if known else []

    def _pieces(self, epoch: int) -> list[tuple[int, int]]:
        rows = self.spark.read.schema(MANIFEST).parquet(self._at("manifest", epoch)).collect()
        if any(r.buckets != self.buckets for r in rows):
            raise ValueError(f"the state at {self.path} has {rows[0].buckets} buckets, not {self.buckets}")
        return sorted((r.bucket, r.epoch) for r in rows)

    def _at(self, kind: str, epoch: int, bucket: int | None = None) -> str:
        where = os.path.join(self.path, kind, f"epoch={epoch:012d}")
        return where if bucket is None else os.path.join(where, f"{self.column}={bucket}")

    def read(self, before: int | None = None, touched: set[int] | None = None) -> DataFrame:
        """The rows of the state, or of its ``touched`` buckets alone; without any, an empty table."""
        return self._rows([p for p in self.manifest(before) if touched is None or p[0] in touched])

    def _rows(self, pieces: list[tuple[int, int]]) -> DataFrame:
        if not pieces:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(self._at("data", e, b) for b, e in pieces))

    def number(self) -> F.Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def touched(self, batch: DataFrame) -> set[int]:
        """The buckets of a batch's keys, at most ``buckets`` numbers."""
        return {r.b for r in batch.select(self.number().alias("b")).distinct().collect()}

    def replace(self, rows: DataFrame, epoch: int, touched: set[int]) -> None:
        """The touched buckets now hold ``rows``, which are all of their rows."""
        kept = [p for p in self.manifest(epoch) if p[0] not in touched]
        self._commit(rows, epoch, kept, touched)

    def append(self, rows: DataFrame, epoch: int, touched: set[int]) -> None:
        """Add ``rows``; a bucket with ``pieces`` pieces is written anew as one, its old rows included."""
        old = self.manifest(epoch)
        full = {b for b in touched if sum(p[0] == b for p in old) >= self.pieces}
        if full:
            rows = rows.unionByName(self._rows([p for p in old if p[0] in full]))
        self._commit(rows, epoch, [p for p in old if p[0] not in full], touched)

    def _commit(self, rows: DataFrame, epoch: int, kept: list[tuple[int, int]], touched: set[int]) -> None:
        earlier = [e for e in self.epochs() if e < epoch]
        if touched:
            rows.select(*(F.col(f"`{f.name}`") for f in self.schema), self.number().alias(self.column)) \
                .hint("rebalance", F.col(self.column)).write.mode("overwrite").partitionBy(self.column).parquet(self._at("data", epoch))
        now = kept + [(b, epoch) for b in touched]
        self.spark.createDataFrame([(b, e, self.buckets) for b, e in now], MANIFEST).coalesce(1) \
            .write.mode("overwrite").parquet(self._at("manifest", epoch))
        if len(earlier) > 1:  # the last state before this epoch stays for its replay
            needed = set(now) | set(self._pieces(earlier[-1]))
            for e in earlier[:-1]:
                for b, at in set(self._pieces(e)) - needed:
                    _delete(self.spark, self._at("data", at, b))
                _delete(self.spark, self._at("manifest", e))
