"""MinHash near-duplicates verified by odd sketches.

Words are lower-cased (A-Z) runs of characters other than space and \\x09-\\x0D; a document's set holds its
distinct 4-word shingles (with fewer words, the whole sequence). Each set gets 512 MinHash samples. The
first 128 make 32 bands of 4 for candidate buckets; all are folded into a bitmap of 2048 parities, the odd
sketch: the population count of two sketches' XOR estimates a high similarity. Candidates that pass the
estimate are confirmed on their full sets.

Documents with equal sets are one class from the start. In each bucket all classes are held against
one of them. What that leaves apart is held against all of the bucket in bounded blocks: sketches
choose the pairs, the full sets confirm them where they meet, and a block gives a spanning forest of its links,
fewer than it has rows. Two sets at 0.8 share no band with probability (1 - 0.8^4)^32, less than 5e-8. Shingles are
64-bit hashes: two of n different shingles agree with probability n^2 / 2^65.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.graph import components
from tidewater.llm.util import store

SHINGLE = 4
SAMPLES, BANDS, ROWS = 512, 32, 4
BITS = 2048
#: Links have 100 * intersection >= LINK * union.
LINK = 80
#: Sketches whose estimate is below this are no candidates: at a true 0.8 that is 5 standard deviations.
FLOOR = 0.70
#: Classes, and shingles, that one side of a block holds about at most; rows of buckets up to SMALL classes share blocks.
BLOCK, BLOCK_SHINGLES, SMALL = 512, 1 << 19, 64

_rng = np.random.RandomState(20240229)
_A = _rng.randint(0, 2**31, SAMPLES, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.randint(0, 2**32, SAMPLES, dtype=np.int64).astype(np.uint32)
_PLACE = _rng.randint(1, 2**63, SHINGLE, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ROW = _rng.randint(1, 2**63, (BANDS, ROWS), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _rng.randint(1, 2**63, SAMPLES, dtype=np.int64).astype(np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; null and blank texts have none."""
    words = (text or "").encode("utf-8").lower().split()
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))] if words else [], np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    n = len(h) - SHINGLE + 1
    g = h[:n] * _PLACE[0]
    for k in range(1, SHINGLE):
        g = g + h[k:k + n] * _PLACE[k]
    return np.unique(_mix(g))


def set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def minhash(s: np.ndarray) -> np.ndarray:
    """The smallest of each sample's 32-bit hashes over a set that isn't empty."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    low = np.full(SAMPLES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(x), 512):
        low = np.minimum(low, (_A[:, None] * x[None, at:at + 512] + _B[:, None]).min(axis=1))
    return low.astype(np.uint64)


def bands(sig: np.ndarray) -> np.ndarray:
    """A 64-bit bucket for each band; the band's number goes into it."""
    return _mix((sig[:BANDS * ROWS].reshape(BANDS, ROWS) * _ROW).sum(axis=1, dtype=np.uint64)).view(np.int64)


def odd_sketch(sig: np.ndarray) -> np.ndarray:
    """The parities as long integers: each sample flips one bit that its place and value choose."""
    bit = _mix(sig + _SALT) % np.uint64(BITS)
    return np.packbits((np.bincount(bit.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).view(np.int64)


def most_differing(floor: float) -> int:
    """The largest XOR population count whose similarity estimate 1 + n/4k ln(1 - 2z/n) reaches ``floor``."""
    return math.floor(BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - floor) / BITS)))


def linked(a: np.ndarray, b: np.ndarray, percent: int = LINK) -> bool:
    """100 * intersection >= percent * union, on full sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, text_key, n_shingles, set_key, odd, bands (null where the set is empty)."""
    columns = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _text_key(F.col(text_col)).alias("text_key"))
    kind = columns.schema["id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, key, odd, band = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text)
                sig = minhash(s) if len(s) else None
                n.append(len(s))
                key.append(None if sig is None else set_key(s))
                odd.append(None if sig is None else odd_sketch(sig).tolist())
                band.append(None if sig is None else bands(sig).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(odd, pa.list_(pa.int64())),
                 pa.array(band, pa.list_(pa.int64()))], ["id", "text_key", "n_shingles", "set_key", "odd", "bands"])

    return columns.mapInArrow(sketch, f"id {kind}, text_key binary, n_shingles long, set_key binary, odd array<long>, bands array<long>")


def _differing(a: str, b: str) -> Column:
    return sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(1, BITS // 64)),
               F.bit_count(F.get(a, F.lit(0)).bitwiseXOR(F.get(b, F.lit(0)))))


def _alike(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose odd sketches agree well enough."""
    odd = classes.select("set_key", "odd")
    rows = (pairs.join(odd.select(F.col("set_key").alias("a"), F.col("odd").alias("oa")), "a")
            .join(odd.select(F.col("set_key").alias("b"), F.col("odd").alias("ob")), "b"))
    return rows.where(_differing("oa", "ob") <= most_differing(FLOOR)).select("a", "b")


def confirm(pairs: DataFrame, texts: DataFrame, percent: int = LINK) -> DataFrame:
    """The pairs (a, b) whose full sets are linked; ``texts`` has (set_key, text) of all nodes."""
    rows = (pairs.join(texts.select(F.col("set_key").alias("b"), F.col("text").alias("tb")), "b")
            .join(texts.select(F.col("set_key").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist()):
                if last is None or ta != last:
                    last, left = ta, shingles(ta)
                keep.append(linked(left, shingles(tb), percent))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(check, "a binary, b binary")


def _with_texts(nodes: DataFrame, classes: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """(set_key, text) of the nodes: the text that each class chose, read once however often it repeats."""
    wanted = nodes.join(classes.select("set_key", "text_key"), "set_key")
    text = docs.select(F.col(text_col).alias("text")).withColumn("text_key", _text_key(F.col("text")))
    return text.join(wanted, "text_key").select("set_key", "text").dropDuplicates(["set_key"])


class _Sets:
    """The full sets of a block's classes, and how many shingles each shares with a given one."""

    def __init__(self, texts: list[str]):
        self.sets = [shingles(t) for t in texts]
        values = np.concatenate(self.sets)
        owners = np.repeat(np.arange(len(self.sets)), [len(s) for s in self.sets])
        order = np.argsort(values, kind="stable")
        self.values, self.owners = values[order], owners[order]

    def shared(self, s: np.ndarray, which: np.ndarray) -> np.ndarray:
        """For each of the chosen classes the size of its intersection with ``s``."""
        if len(which) <= 4:
            return np.array([len(np.intersect1d(s, self.sets[k], assume_unique=True)) for k in which], np.int64)
        low, high = (np.searchsorted(self.values, s, side) for side in ("left", "right"))
        n = high - low
        at = np.arange(n.sum()) + np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n)
        return np.bincount(self.owners[at], minlength=len(self.sets))[which]


def forest(p: pd.DataFrame, q: pd.DataFrame) -> list[tuple[bytes, bytes]]:
    """Links between the classes of p and q (set_key, label, size, odd, text) that join components not yet joined.

    Sketches choose the pairs, full sets confirm them; at most one link fewer is given than there are components.
    """
    limit, out = most_differing(FLOOR), []
    op, oq = (np.array(v["odd"].tolist(), np.int64).view(np.uint64) for v in (p, q))
    names = {k: i for i, k in enumerate(dict.fromkeys([*p["label"], *q["label"]]))}
    lp, lq = (np.array([names[k] for k in v["label"]]) for v in (p, q))
    sp, sq = p["size"].to_numpy(), q["size"].to_numpy()
    kp, kq, tp = p["set_key"].tolist(), q["set_key"].tolist(), p["text"].tolist()
    sets = None
    for r in range(len(p)):
        may = np.flatnonzero((lq != lp[r]) & (100 * sq >= LINK * sp[r]) & (100 * sp[r] >= LINK * sq))
        near = may[np.bitwise_count(op[r] ^ oq[may]).sum(axis=1) <= limit] if len(may) else may
        if not len(near):
            continue
        sets = sets or _Sets(q["text"].tolist())
        own = shingles(tp[r])
        both = sets.shared(own, near)
        for c in near[100 * both >= LINK * (len(own) + sq[near] - both)]:
            if lp[r] != lq[c]:
                out.append((kp[r], kq[c]))
                gone, stays = lq[c], lp[r]
                lp[lp == gone], lq[lq == gone] = stays, stays
    return out


def _apart(members: DataFrame, labels: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between components that still meet in a bucket.

    Classes outside a bucket's largest component are held against all of the bucket: large buckets in blocks of
    bounded rows and shingles, many small ones together.
    """
    named = members.join(labels, members.set_key == labels.node, "left").select(
        "bucket", "set_key", F.coalesce("label", "set_key").alias("label")).join(classes.select("set_key", "size", "odd"), "set_key")
    sizes = named.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("held"))
    mixed = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("most"), F.sum("n").alias("n"), F.max("n").alias("top"),
                                        F.sum("held").alias("held"), F.max_by("held", F.struct("n", "label")).alias("held_top"))
    mixed = mixed.where((F.col("n") > F.col("top")) & (F.col("n") > 2))
    rows = store(named.join(mixed, "bucket"), "mixed")
    small = (F.col("n") <= SMALL) & (F.col("held") <= BLOCK_SHINGLES)
    few = rows.where(small)
    total = few.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("held")).first()
    cells = max(1, total.n // BLOCK, (total.held or 0) // BLOCK_SHINGLES)
    few = few.withColumn("cell", F.pmod(F.xxhash64("bucket"), F.lit(cells))).withColumns({"i": F.lit(-1), "j": F.lit(-1), "side": F.lit(2)})

    large = rows.where(~small)
    cut = lambda n, held: F.greatest(F.ceil(n / BLOCK), F.ceil(held / BLOCK_SHINGLES)).cast("int")
    place = lambda n: F.pmod(F.xxhash64("set_key"), n).cast("int")
    nx = cut(F.col("n") - F.col("top"), F.col("held") - F.col("held_top"))
    ny = cut(F.col("n"), F.col("held"))
    left = large.where(F.col("label") != F.col("most")).withColumn("i", place(nx)).withColumn("j", F.explode(F.sequence(F.lit(0), ny - 1))).withColumn("side", F.lit(0))
    right = large.withColumn("j", place(ny)).withColumn("i", F.explode(F.sequence(F.lit(0), nx - 1))).withColumn("side", F.lit(1))
    shape = ["bucket", "cell", "i", "j", "side", "set_key", "label", "size", "odd", "most"]
    blocks = few.select(*shape)
    for part in (left, right):
        blocks = blocks.unionByName(part.withColumn("cell", F.col("bucket")).select(*shape))

    def confirmed(block: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, rows in block.groupby("bucket"):
            p = rows[(rows["side"] == 0) | (rows["side"] == 2) & (rows["label"] != rows["most"])]
            q = rows[rows["side"] != 0]
            if len(p) and len(q):
                out += forest(p, q)
        return pd.DataFrame(out, columns=["a", "b"])

    return blocks.join(texts, "set_key").groupBy("cell", "i", "j").applyInPandas(confirmed, "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_shingles, component_id (the smallest id reachable over links), kept.

    Null, empty and blank texts have an empty set and are linked with nothing. Rows that repeat an id are
    rows of one class if their sets are equal, else of their own. A null id takes the smallest id of its
    component, and is kept where the component has none; equal smallest ids are all kept. A text's whole set is
    held in one task's memory. Other columns are not read; an empty table gives no rows.
    """
    marked = store(sketches(docs, id_col, text_col), "sketches")
    classes = store(marked.where("n_shingles > 0").groupBy("set_key").agg(F.min("id").alias("id"), F.min("text_key").alias("text_key"), F.first("n_shingles").alias("size"),
                                                                          F.first("odd").alias("odd"), F.first("bands").alias("bands")), "classes")
    members = classes.select("set_key", F.explode("bands").alias("bucket"))
    order = F.xxhash64("set_key")
    pivots = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min_by("set_key", order).alias("pivot")).where("n > 1")
    members = store(members.join(pivots, "bucket").select("bucket", "set_key", "pivot", "n"), "buckets")
    pair = (F.least("set_key", "pivot").alias("a"), F.greatest("set_key", "pivot").alias("b"))
    stars = store(_alike(members.where(F.col("set_key") != F.col("pivot")).select(*pair).distinct(), classes), "stars")
    # whatever may be compared lies in a bucket whose classes are many or alike
    nodes = stars.select(F.col("a").alias("set_key")).union(stars.select("b")).union(members.where("n > 2").select("set_key")).distinct()
    texts = store(_with_texts(nodes, classes, docs, text_col), "texts")
    links = store(confirm(stars, texts), "links")
    labels = components(links)
    more = store(_apart(members.where("n > 2").select("bucket", "set_key"), labels, classes, texts), "links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    ids = classes.join(labels, classes.set_key == labels.node, "left").select("set_key", "id", F.coalesce("label", "set_key").alias("label"))
    low = ids.groupBy("label").agg(F.min("id").alias("low"))
    named = ids.join(low, "label").select("set_key", "low")
    out = marked.select("id", "n_shingles", "set_key").join(named, "set_key", "left")
    group = F.when(F.col("n_shingles") > 0, F.col("low")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", group.alias("component_id"),
                      F.coalesce(F.col("id") == group, group.isNull()).alias("kept"))
