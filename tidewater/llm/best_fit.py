"""Best-fit packing of token sequences in bulk-synchronous rounds.

Documents are cut into pieces of at most 4096 tokens. The pieces are sorted by ranges of their length; pieces
of one length are numbered across the ranges, so a run (length, first rank, count) stands for any number of
them, and a run (free, first sequence, count) for gaps of equal size. A round opens as many sequences as
the unplaced pieces need at least, then sweeps: the runs of both kinds are sorted by size within bands of
sizes, and in each band the longest pieces first take their successor, the smallest gap that holds them. Pieces
that choose the same gap are served by rank: each gap takes as many as fit, the next ranks go to the
next gap of its run. What a gap has left is a smaller gap. Bands widen from sweep to sweep until every
piece has met every gap; rounds repeat until all pieces are placed. At last each piece finds its place by length and rank.

There are at most 4096 lengths and 4096 gap sizes, so a sweep's input doesn't grow with the corpus.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.util import discard, store

SIZE = 4096
END_ID = 1
#: Widths of the bands of sizes, from sweep to sweep; the last holds all sizes.
BANDS = (64, 512, SIZE + 1)
#: Words whose ids a Python worker remembers; beyond, it forgets all before the next text.
CACHE = 1_000_000
#: Ranks that one row of a plan is split into before it is dealt out.
CHUNK = 1 << 16
#: Rows of the range sort for each of its partitions at most.
RANGE_ROWS = 1_000_000

_RUN = "kind string, size int, first long, n long, seq long, per long, at int"


#: Latin letters in their composed forms, then ASCII punctuation without the apostrophe: the tokenizer takes these apart in one way.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


@functools.cache
def _tokenizer(path: str):
    """The tokenizer, its model, how it writes letters that aren't ASCII, and its word cache, once for each Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    letters = {ord(c): t.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c.isalpha()}
    return t, t.model, letters, {}


def _word_ids(word: bytes, tokenizer, model, letters: dict[int, str], known: dict[bytes, bytes]) -> bytes:
    """The ids of one word. Only its letters in lower case go through the model where they make up a plain word."""
    s = word.decode("utf-8")
    m = _PLAIN.fullmatch(s)
    if m is None:
        return np.array(tokenizer.encode(s, add_special_tokens=False).ids, "<u4").tobytes()
    low, rest = m[1].lower(), m[2].encode()
    stem = low.encode()
    if (ids := known.get(stem)) is None:
        found = [x.id for x in model.tokenize(low.translate(letters))]
        ids = known[stem] = struct.pack(f"<{len(found)}I", *found)
    if not rest:
        return ids
    if (after := known.get(rest)) is None:
        after = known[rest] = np.array(tokenizer.encode(m[2], add_special_tokens=False).ids, "<u4").tobytes()
    return ids + after


def token_ids(texts: list[str | None], path: str) -> Iterator[np.ndarray]:
    """The ids of each text, followed by the end id.

    White space separates words in this tokenizer and yields no ids, so a text is encoded word by word; words
    met before come from the cache.
    """
    *parts, known = _tokenizer(path)
    end = END_ID.to_bytes(4, "little")
    for text in texts:
        words = (text or "").encode("utf-8").split()
        if len(known) > CACHE:
            known.clear()
        for w in {w for w in words if w not in known}:
            known[w] = _word_ids(w, *parts, known)
        yield np.frombuffer(b"".join([known[w] for w in words]) + end, "<u4")


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """Per piece of at most ``size`` tokens: id, piece, start, length, ids_crc32."""
    columns = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = columns.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(token_ids(batch.column(1).to_pylist(), path)):
                for k, at in enumerate(range(0, len(ids), size)):
                    part = ids[at:at + size]
                    row.append(i), piece.append(k), start.append(at), length.append(len(part)), crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(v, pa.int64()) for v in (start, length, crc))],
                ["id", "piece", "start", "length", "ids_crc32"])

    return columns.mapInArrow(cut, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def ranked(cut: DataFrame) -> DataFrame:
    """The pieces sorted by ranges of their length, with ``part`` and ``local``, their number among the part's of that length."""
    n = max(cut.count() // RANGE_ROWS + 1, cut.rdd.getNumPartitions())
    dealt = cut.withColumn("tie", F.xxhash64("id", "start", "ids_crc32", F.monotonically_increasing_id()))
    dealt = dealt.repartitionByRange(n, F.col("length").desc(), "tie").sortWithinPartitions(F.col("length").desc(), "tie").drop("tie")
    dealt = dealt.withColumn("part", F.spark_partition_id())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            length = batch.column("length").to_numpy()
            new = np.concatenate(([True], length[1:] != length[:-1])) if len(length) else np.zeros(0, bool)
            place = np.arange(len(length))
            local = place - np.maximum.accumulate(np.where(new, place, 0))
            if len(length) and length[0] == last:
                local += np.where(np.cumsum(new) == 1, seen, 0)
            if len(length):
                last, seen = length[-1], int(local[-1]) + 1
            yield batch.append_column("local", pa.array(local, pa.int64()))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
    return dealt.mapInArrow(number, f"{kinds}, local long")


def sweep(rows: pd.DataFrame, size: int = SIZE) -> pd.DataFrame:
    """Places the document runs of a band in its gap runs, longest first, each in the smallest gap that holds it.

    Returns what is left of both kinds, and the placements: ``n`` pieces from rank ``first`` on go to the
    sequences from ``seq`` on, ``per`` to each, from token ``at`` on.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    docs, out = [], []
    for kind, length, first, n, seq in rows[["kind", "size", "first", "n", "seq"]].itertuples(index=False):
        if kind == "doc":
            docs.append((int(length), int(first), int(n)))
        else:
            gaps.setdefault(int(length), []).append((int(seq), int(n)))
    sizes = sorted(gaps)

    def give(free: int, seq: int, n: int) -> None:
        if free and n:
            if free not in gaps:
                insort(sizes, free)
                gaps[free] = []
            gaps[free].append((seq, n))

    for length, first, left in sorted(docs, key=lambda d: (-d[0], d[1])):
        while left and (i := bisect_left(sizes, length)) < len(sizes):
            free = sizes[i]
            seq, n = gaps[free].pop()
            if not gaps[free]:
                del gaps[free], sizes[i]
            per = min(free // length, left)
            used = min(n, left // per)
            out.append(("place", length, first, used * per, seq, per, size - free))
            give(free - per * length, seq, used)
            give(free, seq + used, n - used)
            first, left = first + used * per, left - used * per
        if left:
            out.append(("doc", length, first, left, None, None, None))
    out += [("gap", free, None, n, seq, None, None) for free, runs in gaps.items() for seq, n in runs]
    kinds = {"kind": "object", "size": "int32", "first": "Int64", "n": "int64", "seq": "Int64", "per": "Int64", "at": "Int32"}
    return pd.DataFrame(out, columns=list(kinds)).astype(kinds)


def packed(runs: DataFrame, size: int = SIZE, bands: tuple[int, ...] = BANDS) -> DataFrame:
    """(length, first, n, seq, per, at): places for the runs (length, first, n)."""
    spark = runs.sparkSession
    state = store(runs.select(F.lit("doc").alias("kind"), F.col("length").cast("int").alias("size"), "first", "n",
                              *(F.lit(None).cast(t).alias(c) for c, t in (("seq", "long"), ("per", "long"), ("at", "int")))), "runs")
    placed, opened = None, 0
    while True:
        # three sums over at most 4096 lengths
        need = state.where("kind = 'doc'").agg(F.sum(F.col("size") * F.col("n")).alias("tokens"), F.sum(F.when(F.col("size") > size // 2, F.col("n"))).alias("alone")).first()
        if not need.tokens:
            break
        new = max(-(-need.tokens // size), need.alone or 0)
        gap = spark.createDataFrame([("gap", size, None, new, opened, None, None)], _RUN)
        opened += new
        state = state.unionByName(gap)
        for width in bands:
            swept = state.groupBy(F.floor(F.col("size") / width)).applyInPandas(lambda pdf: sweep(pdf, size), _RUN)
            swept = store(swept, "sweep")
            one = swept.where("kind = 'place'")
            placed = one if placed is None else placed.unionByName(one)
            state = swept.where("kind <> 'place'")
    if placed is None:
        placed = state.where("kind = 'place'")
    return store(placed.select(F.col("size").cast("long").alias("length"), "first", "n", "seq", "per", "at"), "places")


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    ``path`` names the tokenizer's file, which must lie at that place on every executor. Null, empty and blank texts
    have the end id alone. Rows that repeat an id are documents of their own; equal lengths take their places in the
    order of the range sort. A text is encoded whole, in memory in proportion to its length. Other columns
    are not read; an empty table gives no rows.
    """
    cut = store(pieces(docs, path, id_col, text_col, size), "pieces")
    rows = store(ranked(cut), "ranked")
    discard(cut)
    counts = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = store(counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long"))), "starts")
    places = packed(starts.groupBy("length").agg(F.lit(0).cast("long").alias("first"), F.sum("n").alias("n")), size)
    # long runs are dealt out before they become one row a piece
    chunks = places.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK)))).repartition("length", "first", "chunk")
    low = F.col("chunk") * CHUNK
    each = chunks.withColumn("i", F.explode(F.sequence(low, F.least(low + CHUNK, F.col("n")) - 1)))
    target = each.select("length", (F.col("first") + F.col("i")).alias("rank"), (F.col("seq") + F.floor(F.col("i") / F.col("per"))).alias("sequence_id"),
                         (F.col("at") + F.pmod(F.col("i"), F.col("per")) * F.col("length")).cast("long").alias("offset"))
    # the plan's rows are few before they are dealt out and as many as pieces after: never a side to broadcast
    target = target.hint("merge")
    numbered = rows.join(starts.select("length", "part", "first"), ["length", "part"]).withColumn("rank", F.col("first") + F.col("local"))
    return numbered.join(target, ["length", "rank"]).select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
