"""Clustering with automatic choice of k (M2-M7).

Fits are MLlib KMeans jobs (distributed); the sweep's per-k metrics form a
frame of at most a few dozen rows, the only thing collected to the driver.
Silhouette: ``silhouette_exact`` is the mean Euclidean silhouette (the
reference library's definition) computed over bounded block pairs, quadratic in the rows;
``silhouette_estimate`` is the same mean over a sample of rows, each held against all rows, with a
confidence bound, linear in the rows; ``silhouette_sq`` is MLlib's ClusteringEvaluator (squared Euclidean, linear time).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.report import sample_rows
from tidewater.session import cut_lineage


class InvalidMethodError(ValueError):
    """``method`` names no rule for the number of clusters."""


class NoElbowError(ValueError):
    """The inertia curve has no elbow where one is needed."""


def _features(df: DataFrame, vec: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(vec)))


def kmeans(df: DataFrame, vec: str, k: int, seed: int = 42, max_iter: int = 20):
    """M2: MLlib k-means; returns (model, rows with ``cluster``)."""
    feats = _features(df, vec)
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster").fit(feats)
    return model, model.transform(feats).drop("features")


# ----------------------------------------------------------------------------- M4
#: Blocks of a small table, so that its work is shared, and right-hand rows that a block is held against at once.
FEW_BLOCKS, STRIP_ROWS = 16, 512

SIL_SCHEMA = "grp long, key long, asg int, other long, dsum double, cnt long"


def _block_sums(batches):
    """Per block (grp, b), of rows sorted by (grp, b, side): each left row's sum of distances to the right rows of each cluster of each assignment.

    The left rows (side 0) are held, the right ones stream past them, so memory doesn't grow with the rows.
    """
    here, left, keys, points, square, slots, sums, counts = None, [], None, None, None, {}, None, None

    def ended():
        for (a, c), s in slots.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), here[0])), pa.array(keys), pa.array(np.full(len(keys), a, np.int32)),
                                              pa.array(np.full(len(keys), c)), pa.array(sums[:, s]), pa.array(np.full(len(keys), counts[s]))],
                                             ["grp", "key", "asg", "other", "dsum", "cnt"])

    for batch in batches:
        grp, b, side = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("grp", "b", "side"))
        cuts = np.flatnonzero((grp[1:] != grp[:-1]) | (b[1:] != b[:-1]) | (side[1:] != side[:-1])) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(grp)]):
            if lo == hi:
                continue
            part = batch.slice(lo, hi - lo)
            v = np.asarray(part.column("v").flatten()).reshape(hi - lo, -1).astype(np.float64)
            if (int(grp[lo]), int(b[lo])) != here:
                if here:
                    yield from ended()
                here, left, keys, slots, counts = (int(grp[lo]), int(b[lo])), [], None, {}, []
            if side[lo] == 0:
                left.append((part.column("key"), v))
                continue
            if keys is None:
                keys = pa.chunked_array([k for k, _ in left], pa.int64()).combine_chunks()
                points = np.concatenate([p for _, p in left]) if left else np.zeros((0, v.shape[1]))
                square, sums = (points * points).sum(1)[:, None], np.zeros((len(points), 0))
            cls = np.asarray(part.column("cls").flatten()).reshape(hi - lo, -1)
            for s in range(0, len(v), STRIP_ROWS):
                p, c = v[s:s + STRIP_ROWS], cls[s:s + STRIP_ROWS]
                for a in range(c.shape[1]):
                    for x in np.unique(c[:, a]):
                        slots.setdefault((a, int(x)), len(slots))
                if len(slots) > len(counts):
                    counts += [0] * (len(slots) - len(counts))
                    sums = np.pad(sums, ((0, 0), (0, len(slots) - sums.shape[1])))
                member = np.zeros((len(p), len(slots)))
                for (a, x), at in slots.items():
                    member[c[:, a] == x, at] = 1.0
                for at, k in enumerate(member.sum(axis=0).astype(int).tolist()):
                    counts[at] += k
                sums += np.sqrt(np.maximum(square + (p * p).sum(1)[None, :] - 2 * points @ p.T, 0.0)) @ member
    if here:
        yield from ended()


def _distance_sums(rows: DataFrame, block_rows: int) -> DataFrame:
    """(grp, key, asg, other, dsum, cnt) of rows (grp, key, v, cls): each row's distances to the cluster ``other`` of assignment cls[asg], of its own grp.

    The rows of a block are held by one task while all rows pass it in order; each row goes to every block once.
    """
    sizes = rows.groupBy(F.col("grp").alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    sizes = cut_lineage(sizes.select("_g", F.greatest(F.ceil(F.col("_n") / block_rows), F.least(F.lit(FEW_BLOCKS), F.ceil(F.col("_n") / STRIP_ROWS))).cast("int").alias("_nb")))
    tasks = min(4096, int(sizes.agg(F.sum("_nb")).first()[0] or 1))
    g = rows.join(F.broadcast(sizes), F.col("grp") == F.col("_g"))
    shape = ["grp", "b", "side", "key", "v", "cls"]
    own = g.withColumns({"b": F.pmod(F.xxhash64("key"), F.col("_nb")).cast("int"), "side": F.lit(0)}).select(*shape)
    every = g.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))).withColumn("side", F.lit(1)).select(*shape)
    dealt = own.unionByName(every).repartition(tasks, "grp", "b").sortWithinPartitions("grp", "b", "side")
    sums = dealt.mapInArrow(_block_sums, SIL_SCHEMA)
    return sums.groupBy("grp", "key", "asg", "other").agg(F.sum("dsum").alias("dsum"), F.sum("cnt").alias("cnt"))


def _vector(df: DataFrame, vec: str):
    v = F.col(vec)
    return v if df.schema[vec].dataType.simpleString() == "array<float>" else v.cast("array<double>")


def silhouette_per_row(df: DataFrame, key: str, vec: str, cluster: str, block_rows: int = 8192,
                       group: str | None = None) -> DataFrame:
    """Per-row Euclidean silhouette s(i) = (b - a) / max(a, b); 0 for singleton clusters.

    Rows go to blocks; each block is one stream of distances that keeps per-cluster
    sums (O(n^2) work, bounded memory per task, n^2 / block_rows rows shuffled).
    Self distances are zero, so a(i) divides by (own cluster size - 1).
    With ``group``, silhouettes are computed independently per group (e.g. per k), which comes first in the result.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), _vector(df, vec).alias("v"),
                     F.col(cluster).cast("long").alias("cl"),
                     (F.col(group) if group else F.lit(0)).cast("long").alias("grp"))
    per = _distance_sums(rows.select("grp", "key", "v", F.array("cl").alias("cls")), block_rows)
    per = per.join(rows.select("grp", "key", "cl"), ["grp", "key"])
    return _widths(per, "grp", "key").select(*([F.col("grp").alias(group)] if group else []), "key", "silhouette")


def silhouettes_per_row(df: DataFrame, key: str, vec: str, clusters: dict[int, Column], name: str, block_rows: int = 8192) -> DataFrame:
    """(name, key, silhouette): ``silhouette_per_row`` of several assignments of the same rows, by their numbers; each distance is taken once."""
    numbers = list(clusters)
    rows = df.select(F.col(key).cast("long").alias("key"), _vector(df, vec).alias("v"),
                     F.array(*(clusters[k].cast("long") for k in numbers)).alias("cls"), F.lit(0).cast("long").alias("grp"))
    per = _distance_sums(rows, block_rows).join(rows.select("key", "cls"), "key").withColumn("cl", F.get("cls", "asg"))
    number = F.get(F.array(*(F.lit(k).cast("long") for k in numbers)), "asg")
    return _widths(per, "asg", "key").select(number.alias(name), "key", "silhouette")


def _widths(per: DataFrame, *row: str) -> DataFrame:
    """(row columns, silhouette) from distance sums and counts (row, cl, other, dsum, cnt) of each row to each cluster, itself counted."""
    own = F.when(F.col("other") == F.col("cl"), F.try_divide(F.col("dsum"), F.col("cnt") - 1))
    oth = F.when(F.col("other") != F.col("cl"), F.col("dsum") / F.col("cnt"))
    s = per.groupBy(*row).agg(F.max(F.when(F.col("other") == F.col("cl"), F.col("cnt"))).alias("own_n"),
                              F.max(own).alias("a"), F.min(oth).alias("b"))
    sil = F.when((F.col("own_n") <= 1) | F.col("b").isNull(), F.lit(0.0)) \
        .otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return s.select(*row, sil.alias("silhouette"))


def silhouette_exact(df: DataFrame, key: str, vec: str, cluster: str, block_rows: int = 8192) -> float:
    """M4: mean Euclidean silhouette over all rows."""
    return silhouette_per_row(df, key, vec, cluster, block_rows).agg(F.avg("silhouette")).first()[0]


class Estimate(NamedTuple):
    """A mean, the half width that holds with the asked confidence (0 where all rows were taken), and the rows it rests on."""
    mean: float
    margin: float
    sampled: int
    rows: int


def silhouette_of_sample(df: DataFrame, key: str, vec: str, cluster: str, sample: int = 2048, seed: int = 42) -> DataFrame:
    """(row, silhouette) of at most ``sample`` rows (A10), each held against all rows: sample x rows distances, one pass.

    The sample (``sample`` vectors at most, whatever the input's size) goes to every task; a task sends back one sum for
    each sampled row and cluster it saw. Rows may repeat; rows without a vector or cluster are left out.
    """
    rows = df.select(F.col(key).alias("key"), F.col(vec).cast("array<double>").alias("v"), F.col(cluster).cast("long").alias("cl")) \
        .where(F.col("v").isNotNull() & F.col("cl").isNotNull())
    taken = sample_rows(rows, sample, seed, "key").select("v", "cl").collect()
    shape = "row long, other long, dsum double, cnt long"
    if not taken:
        return df.sparkSession.createDataFrame([], "row long, silhouette double")
    points = np.array([r.v for r in taken], dtype=np.float64)
    square = (points * points).sum(1)[:, None]

    def sent(sums):
        for c, (d, n) in sums.items():
            yield pd.DataFrame({"row": np.arange(len(points)), "other": c, "dsum": d, "cnt": n})

    def measure(batches):
        sums: dict[int, list] = {}
        for pdf in batches:
            for s in range(0, len(pdf), 1024):
                part = pdf.iloc[s:s + 1024]
                b, to = np.vstack(part["v"].to_numpy()).astype(np.float64), part["cl"].to_numpy(np.int64)
                d = np.sqrt(np.maximum(square + (b * b).sum(1)[None, :] - 2 * points @ b.T, 0.0))
                for c in np.unique(to):
                    acc = sums.setdefault(int(c), [np.zeros(len(points)), 0])
                    acc[0] += d[:, to == c].sum(1)
                    acc[1] += int((to == c).sum())
            if len(sums) > 256:
                yield from sent(sums)
                sums = {}
        yield from sent(sums)

    per = rows.select("v", "cl").mapInPandas(measure, shape).groupBy("row", "other").agg(F.sum("dsum").alias("dsum"), F.sum("cnt").alias("cnt"))
    own = df.sparkSession.createDataFrame([(i, r.cl) for i, r in enumerate(taken)], "row long, cl long")
    return _widths(per.join(own, "row"), "row")


def silhouette_estimate(df: DataFrame, key: str, vec: str, cluster: str, sample: int = 2048, seed: int = 42, confidence: float = 0.95) -> Estimate:
    """M4 in linear time: the mean silhouette of a sample of rows, each exact against all rows.

    Silhouettes lie in [-1, 1], so with the given confidence the mean over all rows is within ``margin`` (Hoeffding's
    inequality with Serfling's factor for samples without replacement). Equals ``silhouette_exact`` where the table has
    no more than ``sample`` rows. Without rows: mean 0.
    """
    n = df.where(F.col(vec).isNotNull() & F.col(cluster).isNotNull()).count()
    mean, m = silhouette_of_sample(df, key, vec, cluster, sample, seed).agg(F.avg("silhouette"), F.count(F.lit(1))).first()
    margin = 0.0 if m >= n else 2 * math.sqrt((1 - (m - 1) / n) * math.log(2 / (1 - confidence)) / (2 * m))
    return Estimate(float(mean or 0.0), margin, m, n)


def silhouette_sq(predictions: DataFrame, vec: str, cluster: str = "cluster") -> float:
    """MLlib's silhouette (squared Euclidean), linear time."""
    ev = ClusteringEvaluator(featuresCol="features", predictionCol=cluster, distanceMeasure="squaredEuclidean")
    return ev.evaluate(_features(predictions, vec))


# ----------------------------------------------------------------------------- M3
def k_sweep(df: DataFrame, key: str, vec: str, k_range: Sequence[int] = range(2, 10), seed: int = 42,
            silhouette: str = "estimate", sample: int = 2048) -> tuple[DataFrame, dict]:
    """M3: per k, k-means inertia and silhouette (forced to 0 for k = 2, as in the reference).

    ``silhouette``: ``estimate`` (linear, from ``sample`` rows, exact up to that many), ``exact`` (quadratic) or ``sq``
    (MLlib's squared form). Returns (metrics frame (k, inertia, silhouette, margin of it), {k: (model, predictions)}).
    The vectors are written once, so every fit reads the same rows.
    """
    if silhouette not in ("estimate", "exact", "sq"):
        raise ValueError(f"silhouette is estimate, exact or sq, not {silhouette!r}")
    spark = df.sparkSession
    data = cut_lineage(df.select(key, vec))
    rows, fits = [], {}
    for k in k_range:
        model, pred = kmeans(data, vec, k, seed)
        sil, margin = 0.0, 0.0
        if k != 2 and silhouette == "estimate":
            sil, margin = silhouette_estimate(pred, key, vec, "cluster", sample, seed)[:2]
        elif k != 2:
            sil = float(silhouette_exact(pred, key, vec, "cluster") if silhouette == "exact" else silhouette_sq(pred, vec))
        rows.append((int(k), float(model.summary.trainingCost), sil, margin))
        fits[k] = (model, pred)
    return spark.createDataFrame(rows, "k long, inertia double, silhouette double, margin double"), fits


def inertia_given(df: DataFrame, vec: str, *cluster: str) -> DataFrame:
    """Inertia of a given assignment, (cluster columns, inertia): sum ||x||^2 - ||sum x||^2 / n per cluster.

    The vector sums are a partial aggregation; no dimension becomes a row.
    """
    x = F.col(vec).cast("array<double>")
    d = df.select(*cluster, array_to_vector(x).alias("_v"), F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v).alias("_sq"))
    sums = d.groupBy(*cluster).agg(Summarizer.sum(F.col("_v")).alias("_s"), F.sum("_sq").alias("_sq"), F.count(F.lit(1)).alias("_n"))
    square = F.aggregate(vector_to_array("_s"), F.lit(0.0), lambda s, v: s + v * v)
    return sums.select(*cluster, (F.col("_sq") - square / F.col("_n")).alias("inertia"))


# ----------------------------------------------------------------------------- M5 / M6
def knee(metrics: DataFrame, x: str = "k", y: str = "inertia", S: float = 1.0) -> DataFrame:
    """M5: elbow of a convex decreasing curve (Kneedle, offline, first knee), as window SQL.

    One row (knee) — null when there is none. The frame holds one row per k.
    """
    w = Window.orderBy("x")
    allw = Window.partitionBy()
    d = metrics.select(F.col(x).alias("x"), F.col(y).cast("double").alias("y"))
    d = d.withColumn("i", F.row_number().over(w) - 1).withColumn("n", F.count(F.lit(1)).over(allw))
    d = d.withColumn("xn", (F.col("x") - F.min("x").over(allw)) / (F.max("x").over(allw) - F.min("x").over(allw)))
    d = d.withColumn("yn", (F.col("y") - F.min("y").over(allw)) / (F.max("y").over(allw) - F.min("y").over(allw)))
    d = d.withColumn("yd", (F.max("yn").over(allw) - F.col("yn")) - F.col("xn"))
    prev = F.coalesce(F.lag("yd").over(w), F.col("yd"))
    nxt = F.coalesce(F.lead("yd").over(w), F.col("yd"))
    d = d.withColumn("is_max", (F.col("yd") >= prev) & (F.col("yd") >= nxt)) \
        .withColumn("is_min", (F.col("yd") <= prev) & (F.col("yd") <= nxt)) \
        .withColumn("next_yd", F.lead("yd").over(w))
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("last_max", F.max(F.when(F.col("is_max"), F.col("i"))).over(run)) \
        .withColumn("last_min", F.max(F.when(F.col("is_min"), F.col("i"))).over(run))
    tmx = d.where("is_max").select(F.col("i").alias("last_max"), F.col("x").alias("knee_x"),
                                   (F.col("yd") - F.lit(S) / (F.col("n") - 1)).alias("tmx"))
    d = d.join(tmx, "last_max", "left")
    thr = F.when(F.coalesce(F.col("last_min"), F.lit(-1)) >= F.col("last_max"), F.lit(0.0)).otherwise(F.col("tmx"))
    hits = d.where(F.col("last_max").isNotNull() & (F.col("xn") < 1.0) & F.col("next_yd").isNotNull()
                   & (F.col("next_yd") < thr))
    first = hits.agg(F.min_by("knee_x", "i").alias("knee"))
    return first


def choose_k(metrics: DataFrame, method: str = "silhouette") -> DataFrame:
    """M6: one row (elbow_k, best_silhouette_k, optimal_k).

    elbow = knee of inertia; silhouette = first k with the highest score;
    both = their mean rounded half-even. Unknown method -> InvalidMethodError.
    """
    if method not in ("elbow", "silhouette", "both"):
        raise InvalidMethodError(f"k is chosen by elbow, silhouette or both, not by {method!r}")
    el = knee(metrics).select(F.col("knee").alias("elbow_k"))
    best = metrics.agg(F.min_by("k", F.struct(-F.col("silhouette"), F.col("k"))).alias("best_silhouette_k"))
    # two one-row frames folded into one row
    both = el.select(F.col("elbow_k").cast("long"), F.lit(None).cast("long").alias("best_silhouette_k")) \
        .unionByName(best.select(F.lit(None).cast("long").alias("elbow_k"),
                                 F.col("best_silhouette_k").cast("long"))) \
        .agg(F.max("elbow_k").alias("elbow_k"), F.max("best_silhouette_k").alias("best_silhouette_k"))
    opt = {"elbow": F.col("elbow_k"), "silhouette": F.col("best_silhouette_k"),
           "both": F.bround((F.col("elbow_k") + F.col("best_silhouette_k")) / 2.0, 0).cast("long")}[method]
    return both.withColumn("optimal_k", opt)


def chosen_k(metrics: DataFrame, method: str) -> int:
    """Driver-side value of choose_k (one row); raises when the elbow is required but absent."""
    r = choose_k(metrics, method).first()
    if r["optimal_k"] is None:
        raise NoElbowError("no elbow found in the inertia curve; use method='silhouette'")
    return int(r["optimal_k"])
