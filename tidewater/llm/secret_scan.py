"""Secret scan: fixed formats, and tokens that a Markov model of random strings explains better than one of
ordinary identifiers.

Two first-order character models are trained from labelled samples: values that stand in a secret's
format (label 1) and every other run of identifier characters in the corpus (label 0). A token is a
secret if the log-likelihood ratio of the two models exceeds ``min_llr``. Training counts character
pairs over all documents; the counts (at most two tables of 67 x 67) are all that reaches the driver.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.util import byte_runs, text_chunks

# The formats of the base kinds and the least length of what they hold.
ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16

ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(ALPHABET)
CODE = np.full(256, SIZE, np.uint8)
CODE[np.frombuffer(ALPHABET, np.uint8)] = np.arange(SIZE)
TOKEN = CODE < SIZE
HEX = np.isin(np.arange(256), np.frombuffer(b"0123456789abcdef", np.uint8))

MIN_TOKEN = 16
#: One random token among about e^12 = 160,000 ordinary ones is expected before looking at it.
MIN_LLR = 12.0


@dataclass(frozen=True)
class MarkovRatio:
    """log P(next | char, random) - log P(next | char, ordinary), one row for each character."""

    table: tuple[tuple[float, ...], ...]

    def array(self) -> np.ndarray:
        return np.array(self.table)


def _base(data: bytes, buf: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, value start, value end) in bytes; no match crosses a NUL."""
    found = []
    for m in ASSIGN.finditer(data):
        if m.end(1) - m.start(1) >= ASSIGN_CHARS:
            found.append((m.start(), 0, m.end(), m.start(1), m.end(1)))
    for m in ACCESS.finditer(data):
        if m.end() - m.start() >= ACCESS_CHARS:
            found.append((m.start(), 1, m.end(), m.start(), m.end()))
    for s, e in zip(*byte_runs(HEX[buf], HEX_CHARS)):
        found.append((int(s), 2, int(e), int(s), int(e)))
    return found


def _pair_counts(code: np.ndarray) -> np.ndarray:
    a, b = code[:-1].astype(np.int32), code[1:]
    return np.bincount(a * (SIZE + 1) + b, minlength=(SIZE + 1) ** 2)


def sample_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(label, a, b, n): character pairs in labelled samples of every whole text, counted before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, (SIZE + 1) ** 2), np.int64)
        for batch in batches:
            for _, data, _ in text_chunks(batch.column(0).to_pylist()):
                buf = np.frombuffer(data, np.uint8)
                code = CODE[buf]
                secret = np.zeros(len(code), bool)
                for _, _, _, s, e in _base(data, buf):
                    secret[s:e] = True
                total[0] += _pair_counts(np.where(secret, SIZE, code))
                total[1] += _pair_counts(np.where(secret, code, SIZE))
        label, pair = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"label": label.astype(np.int32), "a": (pair // (SIZE + 1)).astype(np.int32),
                                          "b": (pair % (SIZE + 1)).astype(np.int32), "n": total[label, pair]})

    rows = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "label int, a int, b int, n long")
    return rows.where((F.col("a") < SIZE) & (F.col("b") < SIZE)).groupBy("label", "a", "b").agg(F.sum("n").alias("n"))


def fit(counts: DataFrame, prior: float = 1.0) -> MarkovRatio:
    """The ratio of both models from pair counts; ``prior`` is added to each pair, so no counts give ratio 0."""
    n = np.full((2, SIZE, SIZE), prior)
    for r in counts.collect():  # at most 2 x 67 x 67 rows
        n[r.label, r.a, r.b] += r.n
    log = np.log(n / n.sum(axis=2, keepdims=True))
    return MarkovRatio(tuple(tuple(float(v) for v in row) for row in log[1] - log[0]))


def llr(model: MarkovRatio, token: str) -> float:
    """Log-likelihood ratio of one token (characters outside the alphabet count nothing)."""
    return float(_running(model.array(), CODE[np.frombuffer(token.encode("utf-8"), np.uint8)])[-1]) if len(token) > 1 else 0.0


def _running(table: np.ndarray, code: np.ndarray) -> np.ndarray:
    wide = np.zeros((SIZE + 1, SIZE + 1))
    wide[:SIZE, :SIZE] = table
    return np.cumsum(wide[code[:-1], code[1:]])


def _scan(data: bytes, starts: np.ndarray, wide: np.ndarray, min_llr: float) -> list[list[tuple[int, int, int]]]:
    """For each text of the chunk its (start, kind, end) in code points, sorted."""
    buf = np.frombuffer(data, np.uint8)
    base = _base(data, buf)
    found = [x[:3] for x in base]
    s, e = byte_runs(TOKEN[buf], MIN_TOKEN)
    if len(s):
        # joined runs of tokens: sums over each token's own pairs
        taken = np.zeros(len(buf) + 1, np.int32)
        for a, _, b, *_ in base:
            taken[a] += 1
            taken[b] -= 1
        taken = np.concatenate(([0], np.cumsum(np.cumsum(taken) > 0)))
        free = taken[e] == taken[s]
        for a, b in zip(s[free].tolist(), e[free].tolist()):
            code = CODE[buf[a:b]]
            if wide[code[:-1], code[1:]].sum() >= min_llr:
                found.append((a, 3, b))
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(starts) - 1)]
    if not found:
        return out
    found.sort()
    place = np.searchsorted(starts, [f[0] for f in found], side="right") - 1
    doc, points = -1, None
    for (a, kind, b), k in zip(found, place.tolist()):
        if k != doc:
            doc, first = k, int(starts[k])
            points = np.concatenate(([0], np.cumsum((buf[first:starts[k + 1]] & 0xC0) != 0x80)))
        out[k].append((int(points[a - first]), kind, int(points[b - first])))
    return out


def spans(model: MarkovRatio, text: Column, min_llr: float = MIN_LLR) -> Column:
    """Array of (kind, start, end) of every whole text, by start and then kind; null gives an empty array."""

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def secret_spans(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        wide = np.zeros((SIZE + 1, SIZE + 1))
        wide[:SIZE, :SIZE] = model.array()
        for part in parts:
            out: list = []
            for _, data, starts in text_chunks(part.tolist()):
                out += [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in v] for v in _scan(data, starts, wide, min_llr)]
            yield pd.Series(out, dtype=object)

    return secret_spans(text)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_llr: float = MIN_LLR) -> DataFrame:
    """Per document: id, n_assign, n_access, n_hex, base_sha256, n_markov, spans.

    Null and empty texts have no spans; repeated rows repeat; other columns are not read.
    """
    model = fit(sample_counts(docs, text_col))

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, n_markov long, spans string")
    def secret_digest(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        wide = np.zeros((SIZE + 1, SIZE + 1))
        wide[:SIZE, :SIZE] = model.array()
        for part in parts:
            rows = []
            for _, data, starts in text_chunks(part.tolist()):
                for v in _scan(data, starts, wide, min_llr):
                    n = [sum(k == i for _, k, _ in v) for i in range(4)]
                    base = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in v if k < 3)
                    rows.append((*n[:3], hashlib.sha256(base.encode()).hexdigest(), n[3],
                                 ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in v)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "n_markov", "spans"])

    return docs.select(F.col(id_col), secret_digest(F.col(text_col)).alias("_d")).select(id_col, "_d.*")
