"""LDA topics over a vocabulary of any size (M15): MLlib's online variational Bayes without a table of all words anywhere.

A word's weights in the topics are c (first weights + learnt) + d after any step, where c and d are two numbers and the first
weights are made from the word alone. So only what is learnt of the words met so far is a table; a step joins
the words of its documents to it, task by task, and the driver holds numbers per topic.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.util import discard, store
from tidewater.operators.ranking import top_n_per_group

#: MLlib's defaults: the share of documents of a step, the learning rate's decay and offset, the shape of random first values.
BATCH, DECAY, OFFSET, SHAPE = 0.05, 0.51, 1024.0, 100.0
#: Words of a task's documents, about, and documents that are fitted at once.
TASK_WORDS, TASK_DOCS = 1 << 20, 128


def digamma(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    low = sum(1.0 / (x + i) for i in range(8))
    x = x + 8
    r = 1 / (x * x)
    return np.log(x) - 0.5 / x - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r / 132)))) - low


def trigamma(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    low = sum(1.0 / (x + i) ** 2 for i in range(8))
    x = x + 8
    r = 1 / (x * x)
    return 1 / x + r / 2 + r / x * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r / 30))) + low


def _random_gamma(h: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Values of mean 1 and shape SHAPE made from the numbers ``h``, k of each (Wilson and Hilferty's form of the gamma distribution)."""
    def uniform(which: int) -> np.ndarray:
        x = h.astype(np.int64).view(np.uint64)[:, None] + np.arange(2 * k, dtype=np.uint64)[None, which::2] * np.uint64(0x9E3779B97F4A7C15)
        x = x + np.uint64((seed * 0xD1342543DE82EF95) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
        return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)

    z = np.sqrt(-2 * np.log(uniform(0))) * np.cos(2 * np.pi * uniform(1))
    return (1 - 1 / (9 * SHAPE) + z / (3 * math.sqrt(SHAPE))) ** 3


def fit_documents(beta: np.ndarray, gamma: np.ndarray, alpha: np.ndarray, starts: np.ndarray, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(topic weights of each document, what the words learn): documents are the runs of (word, count) that begin at ``starts``, none empty."""
    found, theta = gamma.T.copy(), lambda g: np.exp(digamma(g) - digamma(g.sum(axis=0)))  # topic by topic: sums run over long rows
    doc = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(words)))
    live, first, of, b, n = np.arange(len(starts)), starts, doc, np.ascontiguousarray(beta.T[:, words]), counts
    while len(live):
        e = theta(found[:, live])
        share = n / ((b * e[:, of]).sum(axis=0) + 1e-100)
        new = e * np.add.reduceat(b * share, first, axis=1) + alpha[:, None]
        more = np.abs(new - found[:, live]).mean(axis=0) > 1e-3
        found[:, live] = new
        if not more.all():
            keep = more[of]
            of, b, n = (np.cumsum(more) - 1)[of[keep]], b[:, keep], n[keep]
            live = live[more]
            first = np.searchsorted(of, np.arange(len(live)))
    found = found.T
    e = theta(found.T).T
    share = counts / ((beta[words] * e[doc]).sum(axis=1) + 1e-100)
    learnt = np.zeros_like(beta)
    np.add.at(learnt, words, e[doc] * share[:, None])
    return found, learnt * beta


def _times(step: int, seed: int) -> Column:
    """How often a step takes a document: a Poisson number of mean BATCH, made from the document's number (a sample with replacement)."""
    u = F.pmod(F.xxhash64("doc", F.lit(step), F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    p = [math.exp(-BATCH) * BATCH ** i / math.factorial(i) for i in range(10)]
    return sum(((u >= sum(p[:i + 1])).cast("int") for i in range(9)), F.lit(0))


def topic_words(docs: DataFrame, tokens: str, k: int, words: int, seed: int, max_iter: int) -> DataFrame:
    """(topic, rank from 0, term): the ``words`` heaviest words of each topic after ``max_iter`` steps over rows with an array of words."""
    spark = docs.sparkSession
    rows = store(docs.select(F.monotonically_increasing_id().alias("doc"), F.coalesce(F.col(tokens), F.array().cast("array<string>")).alias("words")), "lda-documents")
    size, total = rows.agg(F.count(F.lit(1)), F.sum(F.size("words"))).first()
    vocabulary = store(rows.select(F.explode("words").alias("word")).distinct(), "lda-words")
    sums = [f"s{j}" for j in range(k)]
    numbers = ", ".join(f"{s} double" for s in sums)
    table = lambda names, word, values: pa.Table.from_arrays([word, *(pa.array(np.ascontiguousarray(v)) for v in values.T)], names)

    def first_sums(batches):
        for batch in batches:
            yield table(["word", *sums], pa.nulls(1, pa.string()), _random_gamma(batch.column("h").to_numpy(), k, seed).sum(axis=0)[None, :]).to_batches()[0]

    hashed = vocabulary.select("word", F.xxhash64("word").alias("h"))
    base = np.array(hashed.mapInArrow(first_sums, f"word string, {numbers}").agg(F.count(F.lit(1)), *(F.sum(s) for s in sums)).first()[1:], float)
    n_words = vocabulary.count()
    learnt, c, d, alpha, eta = spark.createDataFrame([], f"word string, {numbers}"), 1.0, 0.0, np.full(k, 1.0 / k), 1.0 / k
    gained = np.zeros(k)
    tasks = max(spark.sparkContext.defaultParallelism, -(-int(total or 0) // int(TASK_WORDS / BATCH)))

    for step in range(1, max_iter + 1):
        norm = digamma(c * (base + gained) + d * n_words)

        def fit(left: pa.Table, right: pa.Table) -> pa.Table:
            known = right.column("word").combine_chunks()
            got = np.nan_to_num(np.column_stack([right.column(s).to_numpy() for s in sums]).astype(np.float64).reshape(len(right), k))
            beta = np.exp(digamma(c * (_random_gamma(right.column("h").to_numpy(), k, seed) + got) + d) - norm)
            out, log_theta, count = np.zeros_like(beta), np.zeros(k), 0
            for s in range(0, left.num_rows, TASK_DOCS):
                part = left.slice(s, TASK_DOCS)
                lists = part.column("words").combine_chunks()
                at = lists.flatten().dictionary_encode()
                place = at.dictionary.cast(pa.string())
                place = pc.index_in(place, value_set=known).to_numpy(zero_copy_only=False).astype(np.int64)[at.indices.to_numpy()]
                row = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                pairs, n = np.unique(row * len(beta) + place, return_counts=True)
                row, place = pairs // len(beta), pairs % len(beta)
                starts = np.flatnonzero(np.diff(row, prepend=-1))
                gamma = _random_gamma(part.column("id").to_numpy()[row[starts]], k, seed + step)
                gamma, stat = fit_documents(beta, gamma, alpha, starts, place, n.astype(np.float64))
                log_theta += (digamma(gamma) - digamma(gamma.sum(axis=1))[:, None]).sum(axis=0)
                count += len(starts)
                out += stat
            return pa.concat_tables([table(["word", "n", *sums], known, np.column_stack([np.zeros(len(out)), out])),
                                     table(["word", "n", *sums], pa.nulls(1, pa.string()), np.concatenate(([count], log_theta))[None, :])])

        copies = rows.where(F.size("words") > 0).withColumn("_copy", F.explode(F.sequence(F.lit(0), _times(step, seed)))).where("_copy > 0")
        batch = copies.select(F.xxhash64("doc", "_copy").alias("id"), "words").withColumn("part", F.pmod("id", F.lit(tasks)).cast("int"))
        own = batch.select(F.col("part").alias("at"), F.explode("words").alias("word")).distinct().join(learnt, "word", "left").withColumn("h", F.xxhash64("word"))
        fitted = batch.repartition(tasks, "part").groupBy("part").cogroup(own.repartition(tasks, "at").groupBy("at")).applyInArrow(fit, f"word string, n double, {numbers}")
        stats = store(fitted.groupBy("word").agg(F.sum("n").alias("n"), *(F.sum(s).alias(s) for s in sums)), "lda-step")
        mean = stats.where("word IS NULL").first()
        if mean is None:  # no document was drawn
            continue
        rate = (OFFSET + step) ** -DECAY
        c, d = c * (1 - rate), d * (1 - rate) + rate * eta
        scale = rate * size / math.ceil(BATCH * size) / c
        new = stats.where("word IS NOT NULL").select("word", *((F.col(s) * scale).alias(s) for s in sums))
        merged = store(learnt.unionByName(new).groupBy("word").agg(*(F.sum(s).alias(s) for s in sums)), "lda-learnt")
        gained = np.array(merged.agg(*(F.sum(s) for s in sums)).first(), float)
        discard(stats, *([learnt] if hasattr(learnt, "stored_at") else []))
        learnt = merged
        alpha = _next_alpha(alpha, np.array([mean[s] for s in sums]) / mean["n"], mean["n"], rate)

    def heaviest(batches):
        best: list[list] = [[] for _ in range(k)]
        for batch in batches:
            got = np.nan_to_num(np.column_stack([batch.column(s).to_numpy(zero_copy_only=False) for s in sums]).astype(np.float64).reshape(batch.num_rows, k))
            weight, names = _random_gamma(batch.column("h").to_numpy(), k, seed) + got, batch.column("word")
            for j in range(k):
                at = np.flatnonzero(weight[:, j] >= np.partition(weight[:, j], -words)[-words]) if batch.num_rows > words else np.arange(batch.num_rows)
                best[j] = heapq.nsmallest(words, [*best[j], *((-weight[i, j], names[int(i)].as_py()) for i in at)])
        found = [(j, -x, name) for j in range(k) for x, name in best[j]]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*found) if found else [[]] * 3, (pa.int32(), pa.float64(), pa.string()))], ["topic", "weight", "term"])

    # c and d are the same for all words, so they don't change the order
    most = hashed.join(learnt, "word", "left").mapInArrow(heaviest, "topic int, weight double, term string")
    top = top_n_per_group(most, ["topic"], [F.col("weight").desc(), F.col("term")], words)
    return top.select("topic", (F.col("rank") - 1).alias("rank"), "term").orderBy("topic", "rank")


def _next_alpha(alpha: np.ndarray, log_p: np.ndarray, n: float, rate: float) -> np.ndarray:
    """A Newton step on the documents' topic prior, as MLlib's; none where it would leave the positive numbers."""
    gradient = n * (digamma(alpha.sum()) - digamma(alpha) + log_p)
    c, q = n * trigamma(alpha.sum()), -n * trigamma(alpha)
    b = (gradient / q).sum() / (1 / c + (1 / q).sum())
    new = alpha - rate * (gradient - b) / q
    return new if (new > 0).all() else alpha
