import hashlib
import random

import numpy as np
import pytest

from tidewater.llm import suffix_index as x


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d, b in enumerate(data):
        for s in range(len(b) - length + 1):
            seen.setdefault(b[s:s + length], []).append((d, s))
    gone = [np.zeros(len(b), bool) for b in data]
    for v in seen.values():
        if len(v) > 1:
            for d, s in v:
                gone[d][s:s + length] = True
    out = []
    for b, g in zip(data, gone):
        edge = np.flatnonzero(np.diff(np.concatenate(([0], g.astype(np.int8), [0]))))
        kept = bytes(np.frombuffer(b, np.uint8)[~g]) if b else b""
        out.append((len(b), int(g.sum()), len(edge) // 2, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(length, seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdefgh éß\n") for _ in range(n))
    passages = [text(rng.randrange(length // 2, 3 * length)) for _ in range(6)]
    docs = ["", None, "short", "a" * (3 * length), "ab" * length, "x" * length, "x" * (length - 1), text(20 * length)]
    for _ in range(25):
        parts = [text(rng.randrange(0, 2 * length))]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            at = rng.randrange(len(p))
            parts += [p[at:] if rng.random() < 0.5 else p[:at] if rng.random() < 0.5 else p, text(rng.randrange(0, length))]
        docs.append("".join(parts))
    docs += [docs[10], docs[10], docs[11] + "tail", docs[12][:2 * length] + "Q" + docs[12][2 * length:], passages[0] * 3]
    return docs


@pytest.mark.parametrize("length,seed", [(400, 1), (100, 2)])
def test_equals_brute_force(spark, length, seed):
    docs = corpus(length, seed)
    rows = [(i if i != 4 else None, t, 1, "k") for i, t in enumerate(docs)] + [(9, docs[9], 1, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, did string")
    got = x.repeats(df, length=length).collect()
    want = brute([t for _, t, *_ in rows], length)
    assert sorted((str(r.doc_id), *tuple(r)[1:5]) for r in got) == sorted((str(i), *w) for (i, *_), w in zip(rows, want))
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)


def test_pieces_and_empty(spark, monkeypatch):
    monkeypatch.setattr(x, "PIECE", 700)
    docs = corpus(400, 3)[6:20]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    rows = {i: [] for i in range(len(docs))}
    for i, t in enumerate(docs):  # pieces change segments, never what a window picks
        data = np.frombuffer((t or "").encode(), np.uint8)
        if len(data) >= 400:
            a = np.concatenate([np.repeat(p + lo, n) for lo in range(0, len(data) - 399, 700) for _, n, p, _ in [x.segments(data[lo:lo + 700 + 399])]])
            _, n, p, _ = x.segments(data)
            assert (a == np.repeat(p, n)).all()
    assert x.repeats(df.limit(0)).count() == 0


def test_levels_merge_geometrically(spark):
    rng = random.Random(6)
    docs = spark.createDataFrame([(bytes([i]) * 16, "".join(rng.choice("abcdef") for _ in range(900))) for i in range(8)], "did binary, text string")
    family = x.IndexFamily()
    shapes = []
    for i in range(7):
        family.add(x.entries(docs.where(docs.did == bytearray(bytes([i]) * 16))))
        shapes.append(sorted(family.levels))
    assert shapes == [[0], [1], [0, 1], [2], [0, 2], [1, 2], [0, 1, 2]]
    assert family.repeated().count() == 0
    family.add(x.entries(docs.where(docs.did == bytearray(bytes([3]) * 16))))
    assert family.repeated().select("did").distinct().count() == 1 and family.repeated().count() > 1
