"""Byte-level BPE: encoding by a queue of merge ranks over a doubly linked symbol list, and decoding.

The vocabulary is a ``tokenizers`` JSON file named by a parameter; it is read on the executors and
never copied. Texts are cut by the file's special tokens and the byte-level word pattern; each word
is merged on its own and short words are remembered, up to a fixed number.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the word pattern of byte-level BPE vocabularies (a published constant).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CACHED_WORDS = 400_000
CACHED_CHARS = 24


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown}
    for k, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + k)
    return letters


class ByteBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], _byte_letters()
        byte_of = {c: b for b, c in letters.items()}
        self.byte_id = [vocab[letters[b]] for b in range(256)]
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for k, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault(vocab[a] << 24 | vocab[b], k)
            self.merged.append(vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of: dict[int, bytes] = {i: bytes(byte_of[c] for c in s) for s, i in vocab.items()}
        self.bytes_of |= {i: s.encode("utf-8") for s, i in self.special.items()}
        alternatives = "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.cut = re.compile(f"({alternatives})") if alternatives else None
        self.words = regex.compile(WORDS).findall
        self.cache = _Words(self)

    def merge(self, data: bytes) -> list[int]:
        """Symbols of one word: pop the best-ranked pair, skip it if stale, join it, queue its new neighbours."""
        sym = [self.byte_id[b] for b in data]
        n = len(sym)
        if n < 2:
            return sym
        rank, merged = self.rank.get, self.merged
        heap = []
        left = sym[0]
        for i in range(1, n):
            right = sym[i]
            r = rank(left << 24 | right)
            if r is not None:
                heap.append(r << 40 | i - 1)
            left = right
        if not heap:
            return sym
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            e = heappop(heap)
            r, i = e >> 40, e & 0xFFFFFFFFFF
            if sym[i] < 0 or (j := after[i]) >= n or rank(sym[i] << 24 | sym[j]) != r:
                continue  # stale: one of the two symbols has been joined since
            new = sym[i] = merged[r]
            sym[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(new << 24 | sym[k])) is not None:
                    heappush(heap, r << 40 | i)
            if (p := before[i]) >= 0 and (r := rank(sym[p] << 24 | new)) is not None:
                heappush(heap, r << 40 | p)
        return [s for s in sym if s >= 0]

    def encode_bytes(self, text: str) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers."""
        get, words = self.cache.__getitem__, self.words
        if self.cut is None or not any(s in text for s in self.special):
            return b"".join(map(get, words(text)))
        parts = (self.special[p].to_bytes(4, "little") if p in self.special else b"".join(map(get, words(p)))
                 for p in self.cut.split(text))
        return b"".join(parts)

    def encode(self, text: str | None) -> array:
        return _ids(self.encode_bytes(text or ""))

    def decode(self, ids) -> str:
        """Vocabulary strings of the ids, joined; ids outside the vocabulary add nothing."""
        get = self.bytes_of.get
        return b"".join(get(i, b"") for i in ids).decode("utf-8", errors="replace")


class _Words(dict):
    """Word -> its ids as bytes; forgets everything at a fixed size, so its memory is bounded."""

    def __init__(self, bpe: ByteBpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, word: str) -> bytes:
        out = array("I", self.bpe.merge(word.encode("utf-8"))).tobytes()
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = out
        return out


def _ids(data: bytes) -> array:
    out = array("I")
    out.frombytes(data)
    return out


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode(text: Column, path: str) -> Column:
    """Ids of each whole text; a null text gives no ids."""

    @F.pandas_udf("array<int>")
    def bpe_encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = load(path)
        for part in parts:
            yield pd.Series([bpe.encode(t).tolist() for t in part], dtype=object)

    return bpe_encode(text)


def decode(ids: Column, path: str) -> Column:
    """Text of each id list; null gives an empty text."""

    @F.pandas_udf("string")
    def bpe_decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = load(path)
        for part in parts:
            yield pd.Series([bpe.decode([] if v is None else v) for v in part], dtype=object)

    return bpe_decode(ids)


def round_trip(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_tokens, ids_sha256, decoded_sha256; encoded, then decoded from the ids.

    Null and empty texts have no tokens. Repeated rows repeat; other columns are not read.
    """
    path = path or default_vocabulary()

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def bpe_digest(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe, sha = load(path), hashlib.sha256
        for part in parts:
            rows = []
            for t in part:
                data = bpe.encode_bytes(t or "")
                back = bpe.decode(_ids(data))
                rows.append((len(data) // 4, sha(data).hexdigest(), sha(back.encode("utf-8")).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    out = docs.select(F.col(id_col), bpe_digest(F.col(text_col)).alias("_d"))
    return out.select(id_col, "_d.n_tokens", "_d.ids_sha256", "_d.decoded_sha256")
