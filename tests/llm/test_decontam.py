import hashlib
import random
import re

from tidewater.llm import decontam as d


def tok(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(text, items):
    w = tok(text)
    hit, found = set(), set()
    for i, t in items:
        b = tok(t)
        if not b:
            continue
        for k in range(max(1, len(b) - 12)):
            g = b[k:k + 13]
            for s in range(len(w) - len(g) + 1):
                if w[s:s + len(g)] == g:
                    hit |= set(range(s, s + len(g)))
                    found |= {str(i)} - {"None"}
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def corpus():
    rng = random.Random(4)
    vocab = ["the", "of", "and", "a"] * 30 + [f"w{k}" for k in range(60)] + ["École", "東京"]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(k, " ".join(text(rng.randrange(3, 30)))) for k in range(12)]
    items += [(20, None), (21, ""), (22, "?!"), (23, "the"), (24, "the the the"), (25, items[0][1]), (None, "of and")]
    docs = ["", None, "!!", "The", "the  THE, the", "the " * 60, items[0][1], items[0][1].upper()]
    for _ in range(40):
        w = text(rng.randrange(0, 200))
        for _ in range(rng.randrange(0, 3)):
            b = tok(rng.choice(items)[1])
            at, cut = rng.randrange(len(w) + 1), rng.randrange(5, 30)
            w[at:at] = b[:cut]
        docs.append("... ".join(w) + rng.choice(["", "!"]))
    return list(enumerate(docs)), items


def test_equals_brute_force(spark):
    docs, items = corpus()
    rows = docs + [(None, "the of"), (3, "of the of"), (6, docs[6][1])]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, n_hit int, key string")
    it = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, term string")
    out = d.contamination(df, it).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, (tuple(r) for r in out))) == sorted(key((i, *brute(t, items))) for i, t in rows)
    assert d.contamination(df.limit(0), it).count() == 0
    none = d.contamination(df, it.limit(0)).collect()
    assert len(none) == len(rows) and not any(r.n_hit or r.contaminated for r in none)


def test_without_broadcast_the_same(spark, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(d, "BROADCAST_ROWS", 0)
    df, it = spark.createDataFrame(docs[:15], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(str(tuple(r)) for r in d.contamination(df, it).collect()) == sorted(str((i, *brute(t, items))) for i, t in docs[:15])


def test_proximity_equals_brute_force(spark):
    docs, _ = corpus()
    df = spark.createDataFrame(docs, "key long, text string")
    pairs = spark.createDataFrame([(0, "w1", "w2"), (1, "the", "w3"), (2, "w1", "w1")], "pair int, term_a string, term_b string")
    terms = spark.createDataFrame([("w1",), ("w2",), ("w3",), ("the",)], "term string")
    index = d.postings(df, terms)
    for within in (0, 1, 7):
        got = sorted(tuple(r) for r in d.proximity_matches(index, pairs, within).select("pair", "key", "at_a", "at_b").collect())
        want = []
        for k, t in docs:
            w = tok(t)
            for p, a, b in ((0, "w1", "w2"), (1, "the", "w3"), (2, "w1", "w1")):
                want += [(p, k, x, y) for x, u in enumerate(w) if u == a for y, v in enumerate(w) if v == b and abs(x - y) <= within]
        assert got == sorted(want)


def test_items_without_an_id_hit(spark):
    docs = spark.createDataFrame([(1, "x n1 n2 n3 n4 y"), (2, "clean")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "n1 n2 n3 n4")], "item_id long, text string")
    out = {r.doc_id: r for r in d.contamination(docs, items).collect()}
    assert (out[1].n_hit, out[1].n_items, out[1].contaminated, out[2].contaminated) == (4, 0, True, False)
