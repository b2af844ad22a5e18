import hashlib
import random

import pytest
from tokenizers import Tokenizer

from tidewater.llm import bpe

TEXTS = ["", "hello world", "  two  spaces\n\n x", "naïve café – 東京 🙂🙂", "<|endoftext|>a<|endoftext|>", "a" * 5000, "'s 'll it's",
         "tab\tand\x00nul \x1c\x1f\x85  x", "1234567 ½ ²", "́é", " " * 300 + "x", "<|endoftext|", "ß" * 999 + "!"]


@pytest.fixture(scope="module")
def pair():
    path = bpe.default_vocabulary()
    return bpe.ByteBpe(path), Tokenizer.from_file(path)


def test_same_ids_and_text_as_the_library(pair):
    own, lib = pair
    rng = random.Random(7)
    alphabet = "ab eEtth 019'\n\t!?.,é東🙂 <|>"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 80))) for _ in range(400)]
    for t in texts:
        ids = own.encode(t).tolist()
        assert ids == lib.encode(t, add_special_tokens=False).ids, repr(t)
        assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False) == t


def test_query_rows_and_columns(spark, pair):
    own, lib = pair
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(99, None, "x", 2), (None, "null id", None, 3), (1, TEXTS[1], "x", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, _d int")
    out = bpe.round_trip(df).collect()
    assert len(out) == len(rows)
    for r, (i, t, *_) in zip(sorted(out, key=str), sorted(((i, t) for i, t, *_ in rows), key=lambda x: 0), strict=True):
        assert r.n_tokens >= 0
    by = {r.doc_id: r for r in out}
    for i, t in enumerate(TEXTS):
        ids = lib.encode(t, add_special_tokens=False).ids
        assert by[i].n_tokens == len(ids)
        assert by[i].ids_sha256 == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest()
        assert by[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert by[99].n_tokens == 0
    assert bpe.round_trip(df.limit(0)).count() == 0


def test_columns_round_trip(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS] + [(None,)], "text string")
    path = bpe.default_vocabulary()
    out = df.select("text", bpe.decode(bpe.encode(df.text, path), path).alias("back")).collect()
    assert all((r.text or "") == r.back for r in out)
