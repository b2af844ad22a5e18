"""Exact removal of long repeats with a logarithmic family of sparse suffix arrays.

Every 400-byte window starts a suffix; windows are grouped under the suffix that a content rule picks among
the starts that each window holds (the least hash of 48 bytes, the leftmost on ties), so equal windows always
pick the same suffix. Consecutive windows with one pick form a segment, one entry of the array: the
fingerprint of the suffix's first 48 bytes (the sort key), a 128-bit digest of the segment's bytes, place and
length. Batches are sorted into tables of entries; a new batch is merge-scanned against the existing
levels for suffixes that occur again, then tables of equal size are merged, each level twice the one before.

Suffixes that occur once can't start a repeated window. The others are decided exactly, from large to small:
equal segments, then equal blocks of 32 windows, then single windows, each by counts of 128-bit digests
that are combined before the shuffle, so that a passage in a third of all documents is a few counters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.util import discard, row_key, store

LENGTH = 400
GRAM = 48
BLOCK = 32
BATCHES = 3
#: Windows that are handled at once; longer texts go in overlapping pieces.
PIECE = 1_000_000
PLACE = np.uint64((1 << 20) - 1)  # a piece's places fit into 20 bits

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2^64."""
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _grams(buf: np.ndarray, gram: int) -> np.ndarray:
    """Mixed 64-bit fingerprints of every ``gram`` consecutive bytes."""
    size = 1 << max(12, int(len(buf)).bit_length())
    power, inverse = _powers(max(size, 1 << 12))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[:len(buf)], dtype=np.uint64)))
    h = (sums[gram:] - sums[:-gram]) * inverse[:len(buf) - gram + 1]
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, from running minima in blocks of that width."""
    n = len(x) - width + 1
    pad = -len(x) % width
    rows = np.concatenate((x, np.full(pad, ~np.uint64(0)))).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def segments(buf: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, place of the picked suffix, its fingerprint) of the segments of a piece of bytes."""
    h = _grams(buf, gram)
    low = _least((h & ~PLACE) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    pick = (low & PLACE).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(pick[1:] != pick[:-1]) + 1))
    return first, np.diff(np.append(first, len(pick))), pick[first], h[pick[first]].view(np.int64)


def _digest(b: bytes) -> bytes:
    return hashlib.blake2b(b, digest_size=16).digest()


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


ENTRY = "key long, seg binary, did binary, start int, n int, off int, times int"
_ENTRY = pa.schema([("key", pa.int64()), ("seg", pa.binary()), ("did", pa.binary()), ("start", pa.int32()), ("n", pa.int32()),
                    ("off", pa.int32()), ("times", pa.int32())])


def entries(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Array entries of each whole text of (did, text), a digest once a document with how often it occurs there.

    Rows without a key are bytes [start, start + n) that a document's own repeats of whole segments cover.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = []
            for did, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = (text or "").encode("utf-8")
                seen: dict[bytes, list] = {}
                own: list[tuple[int, int]] = []
                for lo in range(0, len(data) - length + 1, PIECE):
                    buf = np.frombuffer(data, np.uint8)[lo:lo + PIECE + length - 1]
                    for s, n, at, key in zip(*(v.tolist() for v in segments(buf, length))):
                        seg = _digest(data[lo + s:lo + s + n + length - 1])
                        if (row := seen.get(seg)) is None:
                            seen[seg] = [key, seg, did, lo + s, n, at - s, 1]
                        else:
                            if row[6] == 1:
                                own.append((row[3], row[3] + n + length - 1))
                            row[6] += 1
                            own.append((lo + s, lo + s + n + length - 1))
                        if len(own) > 10_000:
                            own = _merged(own)
                rows += seen.values()
                rows += ([None, None, did, s, e - s, 0, 0] for s, e in _merged(own))
                if len(rows) > 20_000:
                    yield _rows(rows, _ENTRY)
                    rows = []
            yield _rows(rows, _ENTRY)

    return docs.select("did", "text").mapInArrow(build, ENTRY)


def _rows(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class IndexFamily:
    """Levels of sorted entry tables, each about twice the one below; every batch is scanned against them as it comes."""

    def __init__(self) -> None:
        self.levels: dict[int, DataFrame] = {}
        self.found: list[DataFrame] = []

    @staticmethod
    def _sorted(rows: DataFrame) -> DataFrame:
        spread = F.coalesce(F.col("key"), F.xxhash64("did"))  # rows without a key go along, dealt out by document
        return store(rows.repartition(spread).sortWithinPartitions("key", "seg"), "suffix-level")

    def add(self, batch: DataFrame) -> None:
        """Scan ``batch`` (entries) against itself and all levels, then merge tables of equal size; merged ones go."""
        batch = self._sorted(batch)
        keys = batch.where("key IS NOT NULL").groupBy("key").agg(F.sum("times").alias("n"))
        found = [keys.where("n > 1").select("key")]
        found += [keys.select("key").join(level.select("key").distinct(), "key", "left_semi") for level in self.levels.values()]
        self.found.append(store(reduce(DataFrame.unionByName, found).distinct(), "suffix-matches"))
        size = 0
        while size in self.levels:
            old, new = self.levels.pop(size), batch
            batch = self._sorted(old.unionByName(new))
            discard(old, new)
            size += 1
        self.levels[size] = batch

    def rows(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.levels.values())

    def repeated(self) -> DataFrame:
        """Entries of all levels whose suffix occurs more than once."""
        return self.rows().join(reduce(DataFrame.unionByName, self.found).distinct(), "key", "left_semi")


def _blocks(variants: DataFrame, length: int) -> DataFrame:
    """Each variant's windows in blocks of 32 that are aligned to the suffix: digest of what all windows of the block
    share, digest of the block's own bytes, place."""
    schema = pa.schema([("core", pa.binary()), ("full", pa.binary()), ("seg", pa.binary()), ("did", pa.binary()), ("start", pa.int32()),
                        ("n", pa.int32()), ("c", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                b, s, n, off = r["ctx"], r["start"], r["n"], r["off"]
                # window k has distance off - k to the suffix
                for j in range((off - n + 1) // BLOCK, off // BLOCK + 1):
                    first, last = max(0, off - (j * BLOCK + BLOCK - 1)), min(n - 1, off - j * BLOCK)
                    core = b[off - j * BLOCK:off - (j * BLOCK + BLOCK - 1) + length]
                    rows.append((_digest(core), _digest(b[first:last + length]), r["seg"], r["did"], s + first, last - first + 1, r["c"]))
            yield _rows(rows, schema)

    return variants.select("ctx", "seg", "did", "start", "n", "off", "c").mapInArrow(
        cut, "core binary, full binary, seg binary, did binary, start int, n int, c long")


def _windows(blocks: DataFrame, length: int) -> DataFrame:
    schema = pa.schema([("w", pa.binary()), ("did", pa.binary()), ("start", pa.int32()), ("c", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                at = r["start"] - r["origin"]
                rows += ((_digest(r["ctx"][k:k + length]), r["did"], r["origin"] + k, r["c"]) for k in range(at, at + r["n"]))
            yield _rows(rows, schema)

    return blocks.select("ctx", "origin", "did", "start", "n", "c").mapInArrow(cut, "w binary, did binary, start int, c long")


def _with_bytes(variants: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """The variants with their bytes, from one pass over the texts that hold them."""
    places = variants.groupBy("did").agg(F.collect_list(F.struct("seg", "start", "n", "off", "c")).alias("v"))
    rows = docs.select("did", "text").join(places, "did")
    schema = pa.schema([("seg", pa.binary()), ("did", pa.binary()), ("start", pa.int32()), ("n", pa.int32()), ("off", pa.int32()),
                        ("c", pa.int64()), ("ctx", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                data = r["text"].encode("utf-8")
                out += ((v["seg"], r["did"], v["start"], v["n"], v["off"], v["c"], data[v["start"]:v["start"] + v["n"] + length - 1]) for v in r["v"])
                if len(out) > 5_000:
                    yield _rows(out, schema)
                    out = []
            yield _rows(out, schema)

    # rows that repeat a document whole are one document here
    return rows.mapInArrow(cut, "seg binary, did binary, start int, n int, off int, c long, ctx binary").dropDuplicates(["seg"])


def _classes(rows: DataFrame, group: str, own: str, *place: str) -> DataFrame:
    """One row for each distinct (group, own): how often it occurs (c), how many variants its group has, where one is."""
    each = rows.groupBy(group, own).agg(F.sum("c").alias("c"), F.min(F.struct(*place)).alias("p"))
    many = each.groupBy(group).agg(F.count(F.lit(1)).alias("variants"))
    return each.join(many, group).select(group, own, "c", "variants", "p.*")


def covered(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES) -> DataFrame:
    """(did, start, n): byte ranges of (did, text) that strings of ``length`` bytes cover which also start elsewhere."""
    family = IndexFamily()
    for b in range(batches):
        family.add(entries(docs.where(F.pmod(F.xxhash64("did"), F.lit(batches)) == b), length))
    own = store(family.rows().where("key IS NULL").select("did", "start", "n"), "suffix-own")
    repeated = store(family.repeated().withColumn("c", F.col("times").cast("long")), "suffix-repeats")
    discard(*family.levels.values(), *family.found)
    whole = store(_classes(repeated, "key", "seg", "did", "start", "n", "off"), "suffix-variants")
    parts = [own,
             repeated.join(whole.where("c > 1").select("seg"), "seg", "left_semi").select("did", "start", (F.col("n") + length - 1).alias("n"))]
    # segments that share a suffix but differ: held against each other in blocks, then window by window
    open_ = store(_with_bytes(whole.where("variants > 1").select("seg", "did", "start", "n", "off", "c"), docs, length), "suffix-bytes")
    blocks = store(_blocks(open_, length), "suffix-blocks")
    halves = store(_classes(blocks, "core", "full", "did", "start", "n", "seg"), "suffix-block-variants")
    once = blocks.where("c = 1")
    parts.append(once.join(halves.where("c > 1").select("full"), "full", "left_semi").select("did", "start", (F.col("n") + length - 1).alias("n")))
    rest = halves.where("variants > 1").join(open_.select("seg", "ctx", F.col("start").alias("origin")), "seg")
    windows = store(_windows(rest, length), "suffix-windows")
    twice = windows.groupBy("w").agg(F.sum("c").alias("times")).where("times > 1").select("w")
    parts.append(windows.where("c = 1").join(twice, "w", "left_semi").select("did", "start", F.lit(length).alias("n")))
    found = store(reduce(DataFrame.unionByName, parts), "suffix-covered")
    discard(own, repeated, whole, open_, blocks, halves, windows)
    return found


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end of the removed byte ranges).

    Null and empty texts have no bytes. Rows that repeat, the id included, are separate documents, so their
    long passages repeat. Other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("did", row_key("_id", "text"))
    kind = rows.schema["_id"].dataType.simpleString()
    places = covered(rows, length).groupBy("did").agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    joined = rows.join(places, "did", "left").select("_id", "text", "spans")
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, counts, shas, spans = [], [], [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.encode("utf-8")
                gone = _merged([(x["start"], x["start"] + x["n"]) for x in found or ()])
                sha, at = hashlib.sha256(), 0
                for s, e in gone:
                    sha.update(data[at:s])
                    at = e
                sha.update(data[at:])
                sizes.append(len(data))
                removed.append(sum(e - s for s, e in gone))
                counts.append(len(gone))
                shas.append(sha.hexdigest())
                spans.append([{"start": s, "end": e} for s, e in gone])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(shas, pa.string()), pa.array(spans, span)], ["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    out = joined.mapInArrow(cut, f"_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>")
    return out.withColumnRenamed("_id", id_col)
