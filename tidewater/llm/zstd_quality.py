"""Quality classifier by compression: a zstandard dictionary of good text and one of bad text.

A text that the good dictionary shortens more than the bad one is likely good. The difference of
the two compressed sizes over their sum, and the compression ratio itself, go through a logistic
calibration into a score between 0 and 1. Repetition shows in the size without a dictionary.

The labelled sample is the only thing that passes the driver; it is bounded by ``max_docs`` rows a
class and ``max_chars`` characters a row (documented parameters of ``fit``). Scores come from whole
texts of any length.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVEL = 3
THRESHOLD = 0.3
#: Bytes added to sizes, so that a passage which one dictionary happens to hold doesn't decide a short text.
SHORT = 300


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the calibration: score = sigmoid(weights . features)."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL)
    d = zstandard.ZstdCompressionDict(dictionary)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d)


class _Scorer:
    def __init__(self, model: QualityModel):
        self.good, self.bad, self.plain = _compressor(model.good), _compressor(model.bad), _compressor(b"")
        self.weights = np.array(model.weights)

    def features(self, text: str | None) -> tuple[float, ...]:
        """1, the normalised size difference, the ratio under both dictionaries, and the log ratio without one."""
        data = (text or "").encode("utf-8")
        if not data:
            return 1.0, 0.0, 1.0, 0.0
        g, b, p = (len(c.compress(data)) for c in (self.good, self.bad, self.plain))
        n = len(data) + SHORT
        return 1.0, 10.0 * (b - g) / (b + g + SHORT), (b + g) / (2.0 * n), math.log((p + 0.5 * SHORT) / n)

    def score(self, text: str | None) -> float:
        z = float(np.dot(self.weights, self.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples themselves as raw content where there are too few to train on."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", label_col: str = "quality", id_col: str = "doc_id",
        max_docs: int = 3000, max_chars: int = 16_000, dict_bytes: int = 64 << 10) -> QualityModel:
    """Train on at most ``max_docs`` labelled ids a class, chosen by the ids' hash before any text is read.

    Rows with a null or empty text, a label that isn't 0 or 1, or more than ``max_chars``
    characters are no training rows. Every second sampled text feeds a dictionary, the others
    calibrate. Without rows of both classes the score is the smoothed share of good rows.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1))
    ids = [known.where(F.col("y") == y).orderBy(F.xxhash64("_id"), "_id").limit(max_docs) for y in (0, 1)]
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("t")).where((F.length("t") > 0) & (F.length("t") <= max_chars))
    # at most 2 * max_docs ids are broadcast
    rows = texts.join(F.broadcast(ids[0].unionByName(ids[1])), "_id").select("y", "t").limit(2 * max_docs).collect()
    sample = {y: sorted({r.t for r in rows if r.y == y}, key=lambda t: hashlib.md5(t.encode("utf-8")).digest()) for y in (0, 1)}
    if not sample[0] or not sample[1]:
        share = (len(sample[1]) + 1) / (len(sample[0]) + len(sample[1]) + 2)
        return QualityModel(b"", b"", (math.log(share / (1 - share)), 0.0, 0.0, 0.0))
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    dicts = {y: _dictionary([t.encode("utf-8") for t in v[::2]], dict_bytes) for y, v in sample.items()}
    scorer = _Scorer(QualityModel(dicts[1], dicts[0], (0.0,) * 4))
    held = {y: v[1::2] or v for y, v in sample.items()}
    x = np.array([scorer.features(t) for y in (0, 1) for t in held[y]])
    y = np.repeat([0.0, 1.0], [len(held[0]), len(held[1])])
    w = list(_calibrate(x, y))
    # the sample is balanced by the bound; the intercept goes back to the labelled rows' class shares
    w[0] += math.log(counts[1] / counts[0]) - math.log(len(held[1]) / len(held[0]))
    return QualityModel(dicts[1], dicts[0], tuple(w))


def score(model: QualityModel, text: Column) -> Column:
    """Score of every whole text, null and empty ones included (they score as an empty text)."""

    @F.pandas_udf("double")
    def zstd_score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = _Scorer(model)
        for part in parts:
            yield pd.Series([scorer.score(t) for t in part], dtype="float64")

    return zstd_score(text)


def held_out(doc_id: Column) -> Column:
    """The fold that labels are never learned from: crc32 of the id as text, mod 5, is 0. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit_on_fold(docs: DataFrame, labels: DataFrame, **params) -> QualityModel:
    """Fit on the labelled documents outside the held-out fold."""
    return fit(docs, labels.where(~held_out(F.col("doc_id"))), **params)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **params) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Rows that repeat give repeated rows with equal scores; an empty table gives no rows; other
    columns of ``docs`` are not read.
    """
    model = fit_on_fold(docs, labels, **params)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
