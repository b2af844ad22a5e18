import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from tidewater.llm import periodic_runs as pr


def plain_runs(words):
    """All runs by comparing the words at every distance; the smallest period of an interval is its period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = sorted(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))[:1]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(best[0] if best else (None,) * 3), 1000 * best[0][1] // best[0][2] if best else None,
            sha("".join("%d,%d,%d\n" % r for r in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


def made(rng):
    """Words with loops of loops, broken loops, repeated passages and noise."""
    out = []
    while len(out) < rng.randint(0, 260):
        kind = rng.random()
        if kind < 0.25 or not out:
            out += [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(1, 20))]
        elif kind < 0.75:
            period = [f"{'abcd'[rng.randint(0, 3)]}" if rng.random() < 0.7 else f"w{rng.randint(0, 9)}" for _ in range(rng.randint(1, 12))]
            if rng.random() < 0.3:
                period = period * rng.randint(2, 5) + [f"x{rng.randint(0, 2)}"]
            loop = period * rng.randint(2, 9)
            out += loop[:len(loop) - rng.randint(0, len(period))]
        else:
            a = rng.randint(0, len(out) - 1)
            out += out[a:a + rng.randint(1, 60)]
    return out


def test_runs_equal_all_distances():
    rng = random.Random(7)
    hit = 0
    for _ in range(600):
        words = [w.encode() for w in made(rng)]
        want = plain_runs(words)
        hit += bool(want)
        assert pr.runs_of(words) == want, words
    assert hit > 250


@pytest.mark.parametrize("text", [
    "a " * 5000, "a b " * 1000 + "a", ("x " * 30 + "y ") * 40, ("x " * 23 + "y ") * 2, "q " * 23, "q " * 24,
    "a b c d e f g h " * 3, "a b c d e f g h i " * 3, "a b c d e f g h i " * 2 + "a b c d e f g h",
])
def test_borders_of_the_rule(text):
    words = text.encode().split()
    assert pr.runs_of(words) == plain_runs(words)


def test_grammar_derives_the_words_and_no_pair_repeats():
    rng = random.Random(3)
    for _ in range(200):
        ids = [rng.randint(0, 3) for _ in range(rng.randint(2, 200))]
        rules, start = pr.re_pair(ids, 4)
        out = list(start)
        while any(s >= 4 for s in out):
            out = [x for s in out for x in (rules[s - 4] if s >= 4 else (s,))]
        assert out == ids
        spots = {}
        for i, pair in enumerate(zip(start, start[1:])):
            spots.setdefault(pair, []).append(i)
        assert all(v[-1] - v[0] < 2 for v in spots.values())


def test_table_equals_plain_rows(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(made(rng)), "x", "clash") for i in range(300)]
    rows += [(i, " ".join(f"n{rng.randint(0, 5000)}" for _ in range(rng.randint(1, 400))), "x", None) for i in range(300, 400)]
    rows += [(None, None, None, None), (None, "a " * 40, "x", "y"), (7, "a b " * 30, "x", "y"), (7, "a b " * 30, "x", "y"), (8, "", "x", "y"),
             (9, " \n\t", "x", "y"), (10, "   a " * 20 + "\x0b\x0c", None, None), (12, "loop of words here " * 30_000, "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs string, id string")
    out = pr.periodic_runs(docs)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {str(tuple(r)) for r in out.collect()}
    short = [r for r in rows if len(r[1] or "") < 100_000]
    assert out.count() == len(rows) and {str(plain_row(r[0], r[1])) for r in short} <= got
    long = out.where("doc_id = 12").orderBy("length").collect()[-1]
    assert (long.n_runs, long.start, long.length) == (1, 0, 120_000)
    assert sum(r.n_runs > 0 for r in out.where("doc_id >= 300").collect()) >= 3  # the periodic tails
    assert pr.periodic_runs(docs.limit(0)).count() == 0
