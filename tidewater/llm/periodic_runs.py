"""Periodic runs of words, found on a grammar of the text.

A text's word ids are compressed by Re-Pair: the most frequent pair of neighbours becomes a rule until no
pair repeats. A run lies within one smallest node of the derivation and crosses that node's boundary,
so each rule's boundary is searched once, on one of its occurrences; what it finds holds at all
positions that derive the rule. The start sequence is a balanced tree of such nodes. Intervals of one period
merge to maximal ones.

Only stretches whose 8-word windows all repeat in the text are compressed: in a run of at least 24 words and
three periods each of them recurs one period further or nearer, so no run leaves such a stretch.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run has at least this many words and this many periods.
LEAST, TIMES = 24, 3
#: Words of the windows that repeat all over a run, and of those that place a candidate period.
WINDOW, SEED = 8, 4

_BASE = 0x9E3779B97F4A7C15


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than space and \\x09-\\x0D, as UTF-8."""
    return (text or "").encode("utf-8").split()


def looped(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, or for ids whose CRC-32 ends in 0 the words with a periodic tail as the contract sets it."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a:a + p]
    return words[:a] + (period * ((n - a) // p + 1))[:n - a]


def _rolled(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of ``width`` elements, a power of two."""
    size, mult = 1, _BASE
    while size < width:
        h = h[:-size] * np.uint64(mult) + h[size:]
        size, mult = 2 * size, (mult * mult + 2) % 2**64
    return h


def _repeated(h: np.ndarray) -> np.ndarray:
    """True where a value occurs more than once."""
    s = np.sort(h)
    twice = s[1:][s[1:] == s[:-1]]
    return np.isin(h, twice) if len(twice) else np.zeros(len(h), bool)


def stretches(words: list[bytes]) -> list[tuple[int, int]]:
    """Start and end of all stretches in which a run may lie."""
    n = len(words)
    if n < LEAST:
        return []
    h = _rolled(np.fromiter(map(hash, words), np.int64, n).view(np.uint64), WINDOW)
    again = _repeated(h)
    if not again.any():
        return []
    edges = np.flatnonzero(np.diff(np.concatenate(([0], again.view(np.int8), [0]))))
    return [(int(s), int(e) + WINDOW - 1) for s, e in zip(edges[::2], edges[1::2]) if e - s > LEAST - WINDOW]


def re_pair(ids: list[int], n_terminals: int) -> tuple[list[tuple[int, int]], list[int]]:
    """(rules, start sequence): symbol ``n_terminals + k`` derives the pair ``rules[k]``."""
    n, shift = len(ids), n_terminals + len(ids) + 1
    sym, nxt, prv = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[int, list[int]] = {}
    for i in range(n - 1):
        places.setdefault(sym[i] * shift + sym[i + 1], []).append(i)
    heap = [(-len(v), k) for k, v in places.items() if len(v) > 1]
    heapify(heap)
    rules: list[tuple[int, int]] = []
    while heap:
        count, pair = heappop(heap)
        at = places.pop(pair, None)
        if at is None:
            continue
        left, right = divmod(pair, shift)
        here = [i for i in sorted(set(at)) if sym[i] == left and nxt[i] < n and sym[nxt[i]] == right]
        live, used = [], -1
        for i in here:
            if i != used:
                live.append(i)
                used = nxt[i]
        if len(live) < 2 or len(live) < -count and heap and -heap[0][0] > len(live):
            places[pair] = here
            if len(live) > 1:
                heappush(heap, (-len(live), pair))
            continue
        new = n_terminals + len(rules)
        rules.append((left, right))
        touched = set()
        for i in live:
            j = nxt[i]
            after, before = nxt[j], prv[i]
            sym[i], sym[j], nxt[i] = new, -1, after
            if after < n:
                prv[after] = i
                places.setdefault(k := new * shift + sym[after], []).append(i)
                touched.add(k)
            if before >= 0:
                places.setdefault(k := sym[before] * shift + new, []).append(before)
                touched.add(k)
        for k in touched:
            if len(places[k]) > 1:
                heappush(heap, (-len(places[k]), k))
    start, i = [], 0
    while i < n:
        start.append(sym[i])
        i = nxt[i]
    return rules, start


def _forward(t: np.ndarray, i: int, j: int, end: int) -> int:
    """How many k from 0 on have t[i+k] == t[j+k] with j + k < end; i < j."""
    done, step, most = 0, 32, end - j
    while done < most:
        m = min(step, most - done)
        bad = t[i + done:i + done + m] != t[j + done:j + done + m]
        at = int(bad.argmax())
        if bad[at]:
            return done + at
        done, step = done + m, step * 4
    return done


def _backward(t: np.ndarray, i: int, j: int, start: int) -> int:
    """How many k from 1 on have t[i-k] == t[j-k] with i - k >= start; i < j."""
    done, step, most = 0, 32, i - start
    while done < most:
        m = min(step, most - done)
        bad = (t[i - done - m:i - done] != t[j - done - m:j - done])[::-1]
        at = int(bad.argmax())
        if bad[at]:
            return done + at
        done, step = done + m, step * 4
    return done


class _Stretch:
    """Word ids with what the search around a boundary needs: equal seeds and hashes of any window."""

    def __init__(self, t: np.ndarray):
        self.t, n = t, len(t)
        seeds = _rolled(t.astype(np.uint64) + np.uint64(1), SEED)
        self.order = np.argsort(seeds, kind="stable")
        ranked = seeds[self.order]
        first = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        begins = np.flatnonzero(first)
        group = np.cumsum(first) - 1
        self.low, self.high = np.empty(n, np.int64), np.empty(n, np.int64)
        self.low[:], self.high[:] = 0, 0
        self.low[self.order] = begins[group]
        self.high[self.order] = np.append(begins[1:], len(seeds))[group]
        self.shared = np.zeros(n + SEED, bool)
        self.shared[:len(seeds)] = (self.high - self.low)[:len(seeds)] > 1
        self.power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, np.uint64(_BASE)))))
        # prefix sums of value * base^place; windows are compared after scaling by the other's place
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum((t.astype(np.uint64) + np.uint64(1)) * self.power[:n])))

    def equal(self, a: np.ndarray, b: np.ndarray, width: np.ndarray) -> np.ndarray:
        """True where the windows at a < b are likely equal (certainly true if they are)."""
        return (self.sums[a + width] - self.sums[a]) * self.power[b - a] == self.sums[b + width] - self.sums[b]

    def may_cross(self, b: np.ndarray) -> np.ndarray:
        """Those boundaries beside which a seed lies that repeats."""
        return b[self.shared[b] | (self.shared[np.maximum(b - SEED, 0)] & (b >= SEED))]

    def crossing(self, x: int, b: int, y: int) -> list[tuple[int, int, int]]:
        """(start, end, period) of the runs in [x, y) that cross b, maximal in [x, y); their longer part holds 1.5 periods."""
        t, found, most = self.t, [], (y - x) // TIMES
        if self.shared[b]:
            q = self.order[self.low[b]:self.high[b]] - b
            q = q[(q > 0) & (q <= most)]
            width = np.maximum(LEAST // 2, (3 * q + 1) // 2) - q
            q, width = (v[b + q + width <= y] for v in (q, width))
            q = q[self.equal(np.full(len(q), b), b + q, width)]
            while len(q):
                p = int(q[0])
                ahead = _forward(t, b, b + p, y)
                s, e = b - _backward(t, b, b + p, x), b + ahead + p
                q = q[1:]
                if s < b < e and e - s >= max(LEAST, TIMES * p):
                    found.append((s, e, p))
                    q = q[(q % p != 0) | (q > e - b)]
        if b - SEED >= x and self.shared[b - SEED]:
            q = (b - SEED) - self.order[self.low[b - SEED]:self.high[b - SEED]][::-1]
            q = q[(q > 0) & (q <= most)]
            width = np.maximum(LEAST // 2, (3 * q + 1) // 2) - q
            q, width = (v[b - q - width >= x] for v in (q, width))
            q = q[self.equal(b - q - width, b - width, width)]
            while len(q):
                p = int(q[0])
                s = b - p - _backward(t, b - p, b, x)
                e = b + _forward(t, b - p, b, y)
                q = q[1:]
                if s < b < e and e - s >= max(LEAST, TIMES * p):
                    found.append((s, e, p))
                    q = q[(q % p != 0) | (q > b - s)]
        return found


def _merged(found: list[tuple[np.ndarray, np.ndarray, int]]) -> list[tuple[int, int, int]]:
    """(start, length, period) of maximal runs from intervals that may be parts of them."""
    by_period: dict[int, list] = {}
    for s, e, p in found:
        by_period.setdefault(p, []).append((s, e))
    runs: dict[tuple[int, int], int] = {}
    for p in sorted(by_period):
        s = np.concatenate([v[0] for v in by_period[p]])
        e = np.concatenate([v[1] for v in by_period[p]])
        order = np.lexsort((e, s))
        s, e = s[order], np.maximum.accumulate(e[order])
        head = np.concatenate(([True], s[1:] > e[:-1] - p))
        for a, z in zip(s[head], e[np.append(np.flatnonzero(head)[1:], len(s)) - 1]):
            runs.setdefault((int(a), int(z)), p)
    return sorted((a, z - a, p) for (a, z), p in runs.items())


def grammar_runs(t: np.ndarray, n_terminals: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of ids below ``n_terminals``."""
    rules, start = re_pair(t.tolist(), n_terminals)
    size = [1] * n_terminals
    for left, right in rules:
        size.append(size[left] + size[right])
    text, found = _Stretch(t), []
    lengths = np.array([size[s] for s in start], np.int64)
    begins = np.concatenate(([0], np.cumsum(lengths)))
    # the start sequence as a balanced tree
    wanted = set(text.may_cross(begins[1:-1]).tolist())
    nodes = [(0, len(start))]
    while nodes:
        i, j = nodes.pop()
        if j - i < 2 or begins[j] - begins[i] < LEAST:
            continue
        mid = (i + j) // 2
        if (b := int(begins[mid])) in wanted:
            found += [(np.array([s]), np.array([e]), p) for s, e, p in text.crossing(int(begins[i]), b, int(begins[j]))]
        nodes += [(i, mid), (mid, j)]
    # the rules, from the last to the first: all positions that derive a rule are known when its turn comes
    derived: dict[int, list[np.ndarray]] = {}
    for s in set(start):
        if size[s] >= LEAST:
            derived[s] = []
    for s, at in zip(start, begins.tolist()):
        if size[s] >= LEAST:
            derived[s].append(np.array([at], np.int64))
    for k in range(len(rules) - 1, -1, -1):
        symbol = n_terminals + k
        if symbol not in derived:
            continue
        at = np.concatenate(derived.pop(symbol))
        left, right = rules[k]
        x, y = int(at[0]), int(at[0]) + size[symbol]
        for s, e, p in text.crossing(x, x + size[left], y):
            found.append((at + (s - x), at + (e - x), p))
        for child, shift in ((left, 0), (right, size[left])):
            if size[child] >= LEAST:
                derived.setdefault(child, []).append(at + shift)
    return _merged(found)


def runs_of(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of the words, by start, then period."""
    out = []
    for s, e in stretches(words):
        ids: dict[bytes, int] = {}
        t = np.fromiter((ids.setdefault(w, len(ids)) for w in words[s:e]), np.int64, e - s)
        out += [(s + a, n, p) for a, n, p in grammar_runs(t, len(ids))]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for s, n, p in runs:
        keep[s + p:s + n] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", loop_ids: bool = True) -> DataFrame:
    """Per document: id, n_runs, start, length, period, exponent_milli of its most repeated run, runs_sha256, collapsed_sha256.

    ``loop_ids``: texts whose id has a CRC-32 that ends in 0 get the contract's periodic tail first; a null id never
    does. Null, empty and blank texts have no words and no runs. Of runs with equal exponents the one that starts
    first, then that of the smaller period is shown. Rows that repeat an id are judged by their own text.
    A text is searched whole, in memory in proportion to its words. Other columns are not read; an empty table
    gives no rows.
    """
    columns = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = columns.schema["id"].dataType.simpleString()
    names = ["start", "length", "period", "exponent_milli"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                if loop_ids:
                    words = looped(words, doc_id)
                runs = runs_of(words)
                best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
                rows.append((len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
                             hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs)).hexdigest()))
            cols = list(zip(*rows)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:5]), *(pa.array(c, pa.string()) for c in cols[5:])],
                ["id", "n_runs", *names, "runs_sha256", "collapsed_sha256"])

    schema = f"id {kind}, n_runs long, {', '.join(f'{c} long' for c in names)}, runs_sha256 string, collapsed_sha256 string"
    return columns.mapInArrow(search, schema).withColumnRenamed("id", id_col)
