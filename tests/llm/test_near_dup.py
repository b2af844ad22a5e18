import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidewater.llm import odd_sketch as o
from tidewater.llm.graph import components


def brute(rows):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    low = list(range(len(rows)))

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            n = len(sets[x] & sets[y])
            if n and 100 * n >= 80 * len(sets[x] | sets[y]):
                low[root(x)] = root(y)
    comp = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            comp[root(x)] = min(comp.get(root(x), i), i)
    return [(i, len(sets[x]), comp.get(root(x)) if sets[x] else i) for x, (i, _) in enumerate(rows)]


def corpus():
    rng = random.Random(11)
    vocab = [f"w{k}" for k in range(3000)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    rows = [None, "", " \t\n", "one", "ONE ", "one two three", "One two\x0bthree", "a b c d", "A b c\nd", "a b c d e", "É x y z", "é x y z"]
    for _ in range(12):
        base = text(rng.randrange(20, 200))
        for _ in range(rng.randrange(1, 6)):
            w = list(base)
            for _ in range(rng.randrange(0, 8)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append(" ".join(w))
    walk = text(100)  # a chain: neighbours are linked, the ends are not
    for k in range(25):
        walk = list(walk)
        walk[k * 4 % 100] = f"new{k}"
        rows.append(" ".join(walk))
    dense = text(120)  # many near copies around one text
    for _ in range(150):
        w = list(dense)
        for _ in range(2):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append(" ".join(w))
    rows += ["same text again and again here"] * 6 + [" ".join(text(30_000))]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_components_equal_brute_force(spark):
    rows = corpus() + [(None, "one"), (3, "another text with that id"), (500, "x"), (500, "x")]
    df = spark.createDataFrame([(i, t, 7, "k") for i, t in rows], "doc_id long, text string, n_shingles int, set_key string")
    got = o.near_duplicates(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = got.collect()
    key = lambda v: tuple(-1 if x is None else x for x in v)
    assert sorted(key(r[:3]) for r in got) == sorted(key(r) for r in brute(rows))
    assert all(r.kept == (r.doc_id == r.component_id if r.doc_id is not None else r.component_id is None) for r in got)
    assert o.near_duplicates(df.limit(0)).count() == 0


def test_large_buckets_in_blocks_lose_no_link(spark, monkeypatch):
    rng = random.Random(2)
    vocab = [f"v{k}" for k in range(500)]
    base = [rng.choice(vocab) for _ in range(60)]
    rows = []
    for i in range(220):
        w = list(base)
        for _ in range(3):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(o, "BLOCK", 50)
    got = o.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r[:3]) for r in got) == sorted(brute(rows))


def test_rows_without_ids_and_a_common_line(spark):
    rng = random.Random(6)
    vocab = [f"c{k}" for k in range(4000)]
    line = [rng.choice(vocab) for _ in range(64)]  # all share it, at a similarity below 0.8
    rows = [(None, " ".join([*line, *(rng.choice(vocab) for _ in range(rng.randrange(8, 12)))])) for _ in range(250)]
    rows += [(i if i % 2 else None, r[1] + " end") for i, r in enumerate(rows[:40])]
    got = o.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    key = lambda v: tuple(-1 if x is None else x for x in v)
    assert sorted(key(r[:3]) for r in got) == sorted(key(r) for r in brute(rows))


def test_a_block_gives_a_forest():
    rng = random.Random(4)
    base = [f"t{k}" for k in range(80)]
    texts = [" ".join(base[:k] + ["other"] + base[k + 1:]) for k in range(60)] + [" ".join(rng.sample(base, 80)) for _ in range(5)]
    sets = [o.shingles(t) for t in texts]
    frame = pd.DataFrame({"set_key": [o.set_key(x) for x in sets], "size": [len(x) for x in sets], "odd": [o.odd_sketch(o.minhash(x)) for x in sets], "text": texts})
    frame["label"] = frame["set_key"]
    linked = [(a, b) for a in range(65) for b in range(a) if o.linked(sets[a], sets[b])]
    got = o.forest(frame, frame)
    assert len(linked) > 1000 and len(got) == 59
    joined = {frame["set_key"][0]}
    for _ in got:
        joined |= {k for pair in got if joined & {*pair} for k in pair}
    assert len(joined) == 60
    frame["label"] = b"one"
    assert o.forest(frame, frame) == []


def test_sketch_estimates_similarity():
    rng = np.random.RandomState(3)
    for share in (0.7, 0.8, 0.9, 0.95):
        z, limit = [], o.most_differing(o.FLOOR)
        for _ in range(30):
            both, a, b = (rng.randint(1, 2**62, n).astype(np.uint64) for n in (int(1000 * share), int(500 * (1 - share)), int(500 * (1 - share))))
            x, y = (o.odd_sketch(o.minhash(np.unique(np.concatenate((both, v))))).view(np.uint64) for v in (a, b))
            z.append(int(np.bitwise_count(x ^ y).sum()))
        guess = 1 + o.BITS / (4 * o.SAMPLES) * np.log(1 - 2 * np.mean(z) / o.BITS)
        assert abs(guess - share) < 0.03 and (share < 0.8 or max(z) <= limit)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
