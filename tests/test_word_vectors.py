import heapq
import random
from collections import Counter

import numpy as np
import pytest

from tidewater.operators import scoring, word_vectors as W


@pytest.mark.parametrize("words", [1, 2, 3, 40, 700])
def test_tree_from_counts_is_a_huffman_tree(words):
    rng = random.Random(words)
    counts = sorted((int(rng.paretovariate(0.7)) for _ in range(words)), reverse=True)
    tree = W.huffman_runs(list(Counter(counts).items()))
    ends, nodes, bits = W.huffman_paths(np.arange(words), tree)
    starts = np.append(0, ends[:-1])
    heap, best = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        best += both
        heapq.heappush(heap, both)
    assert sum(n * (e - s) for n, s, e in zip(counts, starts, ends)) == best
    assert len({tuple(bits[s:e][::-1]) for s, e in zip(starts, ends)}) == words  # from the root down
    assert len(set(nodes.tolist())) == words - 1 and tree[3] == 2 * words - 2
    some = np.arange(0, words, 7)
    assert W.huffman_paths(some, tree)[1].tolist() == [x for i in some for x in nodes[starts[i]:ends[i]]]


def test_a_share_learns_which_words_go_together():
    rng = np.random.default_rng(2)
    sentences = [rng.integers(0, 20, 60) + 20 * (i % 2) for i in range(400)]  # words 0 to 19 and 20 to 39 never meet
    v = W.train(np.arange(40), sentences, W.huffman_runs([(600, 40)]), 16, 5, 42, 0)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = v @ v.T
    assert near[:20, :20].mean() > near[:20, 20:].mean() + 0.3
    assert (W.train(np.arange(40), sentences, W.huffman_runs([(600, 40)]), 16, 5, 42, 0) == W.train(np.arange(40), sentences, W.huffman_runs([(600, 40)]), 16, 5, 42, 0)).all()


@pytest.mark.parametrize("min_count", [1, 2])
def test_vectors_of_a_corpus_in_small_shares(spark, min_count, monkeypatch):
    monkeypatch.setattr(W, "SENTENCE", 7)
    rng = random.Random(4)
    docs = [(i, [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(rng.randrange(0, 40))]) for i in range(50)] + [(60, []), (61, None), (62, ["alone"])]
    df = spark.createDataFrame(docs, "d long, t array<string>")
    words, means = W.word_vectors(df, "d", "t", vector_size=8, min_count=min_count, partitions=2, share=100)
    counts = Counter(w for _, t in docs for w in t or [])
    got = {r.word: (r.n, np.array(r.vector)) for r in words.collect()}
    assert {w: n for w, (n, _) in got.items()} == {w: n for w, n in counts.items() if n >= min_count}
    assert all(len(v) == 8 and np.isfinite(v).all() and v.any() for _, v in got.values())
    want = {d: sum(got[w][1] for w in t if w in got) / len(t) for d, t in docs if any(w in got for w in t or [])}
    found = {r.doc: r.vector for r in means.collect()}
    assert set(found) == set(want)
    for d, v in want.items():
        np.testing.assert_allclose(found[d], v, atol=1e-6)


def test_no_table_of_words_passes_the_driver(spark, monkeypatch):
    """MLlib's fit held all words and their vectors there; now only how many words have each count is collected."""
    from pyspark.sql.classic.dataframe import DataFrame
    rng = random.Random(6)
    rows = [(i, " ".join(f"x{rng.randrange(10**6)}" for _ in range(30)) + " the ship") for i in range(100)] + [(100, None), (101, "")]
    taken = []
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: (taken.append((self.columns, len(got := collect(self)))), got)[1])
    df = spark.createDataFrame(rows, "id long, t string")
    kept = {r.id for r in scoring.dedup_word2vec(df, "id", "t", 0.9, vector_size=8, partitions=2).collect()}
    assert {0, 100, 101} <= kept <= set(range(102))
    assert "Word2Vec" not in vars(scoring)
    histogram = [n for columns, n in taken if columns == ["n", "words"]]
    assert histogram and histogram[0] < 10
    assert all(n < 200 for _, n in taken)


def test_rows_with_repeated_and_null_keys_come_back_whole(spark):
    rows = [(1, "a ship lost cargo", "x"), (1, "a ship lost cargo", "y"), (None, "a ship lost cargo", "z"), (None, None, "v"), (2, "", None)]
    df = spark.createDataFrame(rows, "id long, t string, more string").coalesce(1)
    kept = scoring.dedup_word2vec(df, "id", "t", 0.9, vector_size=8, partitions=2)
    assert kept.columns == df.columns
    # of three equal texts the first in the order by key stays, nulls first
    assert sorted((r.more or "" for r in kept.collect())) == ["", "v", "z"]
