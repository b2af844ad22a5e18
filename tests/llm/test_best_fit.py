import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

from tidewater.llm import best_fit as bf

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole(texts):
    """The ids of whole texts by the library alone."""
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


def plain_best_fit(lengths, size):
    """Sequences that best fit, longest first, one piece at a time, takes."""
    free, n = [], 0
    for x in sorted(lengths, reverse=True):
        fits = [i for i, f in enumerate(free) if f >= x]
        if fits:
            i = min(fits, key=lambda i: free[i])
            free[i] -= x
        else:
            free.append(size - x)
            n += 1
    return n


def check(rows, size):
    """Sequences without gaps or overlaps, none over the size."""
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for spans in seqs.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    return len(seqs)


WORDS = ["Straße", "naïve", "ΣΑΣ", "İx", "it's", "don't", "a--b", "１２", "x y", "é", "́z", "a\x1cb", "日本語", "<|endoftext|>", "q<|startoftext|>r", "café", "#!?", " k", "1234", "\U0001f600", "a​b"]


def test_ids_word_by_word_equal_whole_texts():
    rng = random.Random(5)
    texts = ["".join(rng.choice(WORDS) + rng.choice([" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c ", "　", ""]) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    texts += [None, "", " \n ", "'s", "a 's", "word " * 9000]
    letters = [chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x180)]]
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    for _ in range(6000):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(0, 9))) + "".join(rng.choice(marks) for _ in range(rng.choice([0, 0, 1, 2, 4])))
        texts.append(w + rng.choice(["", "", "", "x", "'ll", "́", "4"]))
    for text, want, got in zip(texts, whole(texts), bf.token_ids(texts, PATH)):
        assert want == got.tolist(), text


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(bf, "CACHE", 3)
    texts = ["a b c d e f", "a b", "g h i", "c"]
    assert [x.tolist() for x in bf.token_ids(texts, PATH)] == whole(texts)
    assert len(bf._tokenizer(PATH)[-1]) <= 6


def test_sweep_takes_the_smallest_gap_that_holds():
    rows = pd.DataFrame([("doc", 5, 0, 3, None), ("doc", 2, 0, 4, None), ("gap", 6, None, 1, 0), ("gap", 11, None, 2, 10)], columns=["kind", "size", "first", "n", "seq"])
    out = bf.sweep(rows, 12)
    places = [tuple(r) for r in out[out.kind == "place"][["size", "first", "n", "seq", "per", "at"]].itertuples(index=False)]
    assert places[0] == (5, 0, 1, 0, 1, 6) and places[1] == (5, 1, 2, 10, 2, 1)
    assert places[2] == (2, 0, 4, 11, 4, 1)
    assert sorted(map(tuple, out[out.kind == "gap"][["size", "n", "seq"]].values)) == [(1, 1, 0), (1, 1, 10), (3, 1, 11)]


def test_as_few_sequences_as_best_fit(spark):
    rng = random.Random(9)
    for size, lengths in [
        (100, [rng.randint(1, 100) for _ in range(900)]),
        (100, [34] * 500 + [rng.randint(1, 30) for _ in range(300)]),
        (64, [33] * 200 + [31] * 190 + [1] * 40),
        (50, [1] * 701 + [50] * 30 + [26] * 31),
    ]:
        runs = pd.Series(lengths).value_counts()
        df = spark.createDataFrame([(int(k), 0, int(v)) for k, v in runs.items()], "length long, first long, n long")
        places = bf.packed(df, size, (8, size + 1)).collect()
        seqs, ranks = defaultdict(list), defaultdict(set)
        for p in places:
            for i in range(p.n):
                seqs[p.seq + i // p.per].append((p.at + i % p.per * p.length, p.length))
                assert p.first + i not in ranks[p.length]
                ranks[p.length].add(p.first + i)
        assert {k: set(range(v)) for k, v in runs.items()} == dict(ranks)
        for spans in seqs.values():
            spans.sort()
            assert [s for s, _ in spans] == np.cumsum([0, *(n for _, n in spans[:-1])]).tolist() and sum(n for _, n in spans) <= size
        assert len(seqs) <= max(plain_best_fit(lengths, size), -(-sum(lengths) // size)) * 1.02 + 1


def test_documents_are_packed_whole(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(f"{rng.choice('abcdef')}{rng.randint(0, 99)}" for _ in range(rng.randint(0, 300))), i, 0) for i in range(300)]
    rows += [(None, None, 1, 2), (None, "same text", 1, 2), (5, "same text", 1, 2), (5, "same text", 1, 2), (6, "", 1, 2), (7, "long text " * 7000, 1, 2)]
    rows += [(8, "a " * 4095, 0, 0), (9, "a " * 4096, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, rank int")
    out = bf.pack(docs, PATH)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert [t for _, t in out.dtypes] == ["bigint", "int"] + ["bigint"] * 5
    got = out.collect()
    want = []
    for (i, *_), ids in zip(rows, whole([r[1] for r in rows])):
        for k in range(0, len(ids), 4096):
            part = ids[k:k + 4096]
            want.append((i, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    key = lambda rows: sorted(rows, key=str)
    assert key([tuple(r)[:5] for r in got]) == key(want)
    n = check(got, 4096)
    lengths = [w[3] for w in want]
    assert n <= plain_best_fit(lengths, 4096) and n - -(-sum(lengths) // 4096) <= 1
    assert bf.pack(docs.limit(0), PATH).count() == 0
